"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by the scoring workers.

Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end token a text; a text's first token follows a
begin mark. Words are known by their XXH64, word pairs by a mix of the two.

Counting: distinct pairs with counts of a few million tokens at a time, dealt to shards by their first word. The pairs of
a first word that is more than a thousandth of some part's tokens (at most some thousands, found in a pass before) are
dealt by both words, so no shard grows with one word. A shard writes its sorted pair hashes (those met once, and the
others with their counts) as a file in the shared folder and sends each word's statistics on; these are added up and
written as sorted arrays too. All sizes follow the corpus; shards stay of one size, only their number grows.

Probability: (c(u v) - D(c)) / c(u) plus the context's discounted mass times the continuation probability of v, itself
discounted and interpolated with the uniform one over the V training words and one unknown. D for one, two, more.

Nulls count as empty text (one end token); repeated rows and null ids are scored (and learnt from) row by row; without
training rows every probability is 1; a very long text is scored whole, in a batch of its own; equal texts have equal
scores; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import shutil
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import SharedFiles, chunks, cut, id_bucket, partitions_for, release, small_batches, table, texts
from skein.llm.encoder import Memo

#: Tokens counted together before their pairs are sent.
BATCH_TOKENS = 2_000_000

#: Words held by one worker; beyond it a memo starts anew.
MEMO = 150_000


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


#: Shards up to which each sends its statistics straight to the buckets of words.
DIRECT = 128

#: Files that one task has mapped at a time.
MAPS = 8_192

#: Hashes of the marks; no word has a blank in it.
BEGIN, END = word_hash(b" begin"), word_hash(b" end")


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two hashes."""
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hash arrays of texts' tokens, the end token included."""

    def __init__(self):
        self.memo = Memo(word_hash)

    def tokens(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if len(self.memo) > MEMO:
            self.memo.clear()
        out = np.empty(len(words) + 1, dtype=np.uint64)
        out[:-1] = np.fromiter(map(self.memo.__getitem__, words), dtype=np.uint64, count=len(words))
        out[-1] = END
        return out


def pairs_of(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (first, second) of the token arrays, ordered, and for each token its pair's position."""
    seconds = np.concatenate(docs)
    firsts = np.empty_like(seconds)
    firsts[1:] = seconds[:-1]
    firsts[np.cumsum([0, *map(len, docs[:-1])])] = BEGIN
    words, at = np.unique(np.concatenate([firsts, seconds]), return_inverse=True)
    code = at[: len(firsts)] * np.int64(len(words)) + at[len(firsts) :]
    code, where = np.unique(code, return_inverse=True)
    return words[code // len(words)], words[code % len(words)], where


def shard_of(first: np.ndarray, second: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    salt = np.where(np.isin(first, heavy), second, np.uint64(0)) if len(heavy) else np.zeros_like(first)
    return (mix(first, salt) % np.uint64(shards)).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers one after the other, each in its narrowest width."""
    head, data = [len(arrays)], []
    for a in arrays:
        most = int(a.max()) if len(a) else 0
        width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
        head += [len(a), width]
        data.append(a.astype(f"<u{width}", copy=False).tobytes().ljust(-(-len(a) * width // 8) * 8, b"\0"))
    return np.array(head, dtype=np.int64).tobytes() + b"".join(data)


def unpack(data) -> list[np.ndarray]:
    """The arrays of pack(), without copies; `data` is bytes or a mapped file."""
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    shapes = np.frombuffer(data, dtype=np.int64, count=2 * n, offset=8).reshape(n, 2).tolist()
    out, at = [], 8 + 16 * n
    for length, width in shapes:
        out.append(np.frombuffer(data, dtype=f"<u{width}", count=length, offset=at))
        at += -(-length * width // 8) * 8
    return out


def heavy_words(df: DataFrame) -> tuple[int, np.ndarray]:
    """How many tokens `df` has, and the hashes of words that are many of them.

    A word above a thousandth of all tokens is above a thousandth of some part's; each part names those words of its own
    (fewer than a thousand). Kept are words whose named counts pass a 2,000th of all, so fewer than 2,000.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 0):
            words: Counter[bytes] = Counter()
            for t in texts(chunk.column(0)):
                words.update(t.encode().lower().split())
            total = words.total() + chunk.num_rows
            many = [(word_hash(w), n) for w, n in words.items() if n > total / 1000] + [(END, chunk.num_rows)]
            h = np.array([x for x, _ in many], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([None, *h.tolist()], pa.int64()), pa.array([total, *(n for _, n in many)], pa.int64())], names=["h", "n"])

    named = df.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    named = cut(named)
    total = named.filter("h is null").select("n").first()
    total = total[0] if total else 0
    heavy = [r["h"] for r in named.filter(F.col("h").isNotNull() & (F.col("n") > total / 2000)).select("h").collect()]
    return total, np.array([BEGIN, *np.array(heavy, dtype=np.int64).view(np.uint64).tolist()], dtype=np.uint64)


def pair_counter(heavy: np.ndarray, shards: int):
    """Rows (shard, pairs), the latter packed: first words, how many pairs each has, second words, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, docs, size = Hasher(), [], 0

        def flush() -> pa.RecordBatch:
            first, second, where = pairs_of(docs)
            n = np.bincount(where).astype(np.uint32)
            shard = shard_of(first, second, heavy, shards)
            order = np.argsort(shard, kind="stable")
            first, second, n, shard = first[order], second[order], n[order], shard[order]
            ids, at = np.unique(shard, return_index=True)
            out = []
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(shard)], strict=True):
                u, run_length = np.unique(first[a:b], return_counts=True)
                out.append(pack(u, run_length, second[a:b], n[a:b]))
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(out, pa.binary())], names=["shard", "pairs"])

        for chunk in chunks(batches, 0):
            for t in texts(chunk.column(0)):
                docs.append(hasher.tokens(t))
                size += len(docs[-1])
                if size >= BATCH_TOKENS:
                    yield flush()
                    docs, size = [], 0
        if docs:
            yield flush()

    return run


#: What is kept of a word: its count, that of pairs it begins, how many of these occur once, twice and more often, and
#: how many distinct pairs it ends.
STATS = ["c", "t", "n1", "n2", "n3", "cont"]


def by_bucket(word: np.ndarray, stats: list[np.ndarray], log: int) -> tuple[list[int], list[bytes]]:
    """Sorted words and their statistics, packed apart by the first `log` bits of the words."""
    ids, at = np.unique((word >> np.uint64(64 - log)).astype(np.int64), return_index=True)
    ends = [*at[1:].tolist(), len(word)]
    return ids.tolist(), [pack(word[a:b], *(x[a:b] for x in stats)) for a, b in zip(at.tolist(), ends, strict=True)]


def summed(packed: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The words of several packed parts, sorted, and the sums of their statistics."""
    parts = [unpack(x) for x in packed]
    word, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    sums = []
    for k in range(1, len(STATS) + 1):
        sums.append(np.zeros(len(word), dtype=np.int64))
        np.add.at(sums[-1], at, np.concatenate([p[k] for p in parts]).astype(np.int64))
    return word, sums


def shard_writer(files: SharedFiles, log: int, block: int):
    """Writes a shard's file; gives (bucket, block, stats): its words' statistics by the first `log` bits, and how many
    pairs occur 1 to 4 times (bucket -1), with the number of the block of shards that it is of."""

    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        parts = [unpack(x) for x in group.column("pairs").to_pylist()]
        first = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        second, n = np.concatenate([p[2] for p in parts]), np.concatenate([p[3].astype(np.uint32) for p in parts])
        del parts, group
        order = np.lexsort((second, first))
        first, second, n = first[order], second[order], n[order]
        at = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        first, second, n = first[at], second[at], np.add.reduceat(n.astype(np.int64), at)
        del order, at
        key, once = mix(first, second), n == 1
        more = key[~once]
        order = np.argsort(more)
        files.write(f"pairs-{shard}", pack(np.sort(key[once]), more[order], n[~once][order]))
        del key, more, order
        word, where = np.unique(np.concatenate([first, second]), return_inverse=True)
        i, j = where[: len(first)], where[len(first) :]
        add = lambda k, x=None: np.bincount(k, weights=x, minlength=len(word)).astype(np.int64)
        ids, out = by_bucket(word, [add(j, n), add(i, n), add(i[once]), add(i[n == 2]), add(i[n > 2]), add(j)], log)
        met = pack(np.array([int((n == k).sum()) for k in (1, 2, 3, 4)]))
        blocks = pa.array([shard // block] * (len(ids) + 1), pa.int64())
        return pa.Table.from_arrays([pa.array([-1, *ids], pa.int64()), blocks, pa.array([met, *out], pa.binary())], names=["bucket", "block", "stats"])

    return run


def combiner(log: int):
    """Adds up the statistics of a block of shards for the words of one wide bucket; gives them by `log` bits."""

    def run(group: pa.Table) -> pa.Table:
        packed = group.column("stats").to_pylist()
        if group.column("bucket")[0].as_py() < 0:
            ids, out = [-1], [pack(np.sum([unpack(x)[0].astype(np.int64) for x in packed], axis=0))]
        else:
            ids, out = by_bucket(*summed(packed), log)
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array([0] * len(ids), pa.int64()), pa.array(out, pa.binary())], names=["bucket", "block", "stats"])

    return run


def word_writer(files: SharedFiles):
    """Writes a bucket's words in order of their hashes; gives (kind, m): sums over its words, or of bucket -1."""

    def run(group: pa.Table) -> pa.Table:
        bucket, packed = group.column("bucket")[0].as_py(), group.column("stats").to_pylist()
        if bucket < 0:
            m = np.sum([unpack(x)[0].astype(np.int64) for x in packed], axis=0).tolist()
        else:
            word, rows = summed(packed)
            files.write(f"words-{bucket}", pack(word, *rows))
            cont = rows[-1]
            m = [int((cont == k).sum()) for k in (1, 2, 3, 4)] + [int((cont > 2).sum()), int(cont.sum()), int((rows[0] > 0).sum()), int(rows[0].sum())]
        return pa.table({"kind": pa.array([int(bucket < 0)], pa.int64()), "m": pa.array([m], pa.list_(pa.int64()))})

    return run


def discounts(n: list[int]) -> np.ndarray:
    """Discounts by count 0, 1, 2, 3 and more, from how many things occur 1, 2, 3 and 4 times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.75
        out.append(min(max(d, 0.05), k - 0.05))
    return np.array(out)


class KneserNey:
    """The model's numbers and files. Sent to workers, which map the files."""

    def __init__(self, files: SharedFiles, shards: int, buckets_log: int, heavy: np.ndarray, tokens: int, vocabulary: int, types: int, pair: np.ndarray, word: np.ndarray, mass: float):
        self.files, self.shards, self.buckets_log, self.heavy = files, shards, buckets_log, heavy
        self.tokens, self.vocabulary, self.types = tokens, vocabulary, types
        self.pair, self.word, self.mass = pair, word, mass  # discounts of pairs and of continuations, mass of the latter

    def delete(self) -> None:
        self.files.delete()


class MappedModel:
    """Look-ups in a model's mapped files, a sorted batch of hashes at a time."""

    def __init__(self, model: KneserNey):
        self.model, self.maps = model, {}
        self.scratch = None if model.files._posix() is not None else tempfile.mkdtemp(prefix="skein-lm-")

    def close(self) -> None:
        self.maps.clear()
        if self.scratch:
            shutil.rmtree(self.scratch, ignore_errors=True)

    def parts(self, name: str) -> list[np.ndarray] | None:
        if name not in self.maps:
            if len(self.maps) >= MAPS:
                self.maps.clear()
            try:
                self.maps[name] = unpack(np.memmap(self.model.files.local(name, self.scratch), dtype=np.uint8, mode="r"))
            except FileNotFoundError:  # nothing fell into it
                self.maps[name] = None
        return self.maps[name]

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key, shard = mix(first, second), shard_of(first, second, self.model.heavy, self.model.shards)
        order = np.lexsort((key, shard))
        out = np.zeros(len(key), dtype=np.int64)
        ids, at = np.unique(shard[order], return_index=True)
        for s, a, b in zip(ids.tolist(), at.tolist(), [*at[1:].tolist(), len(key)], strict=True):
            found = self.parts(f"pairs-{s}")
            if found is None:
                continue
            where = order[a:b]
            q = key[where]
            single, more, counts = found
            out[where[place(single, q) >= 0]] = 1
            i = place(more, q)
            out[where[i >= 0]] = counts[i[i >= 0]]
        return out

    def words(self, h: np.ndarray) -> np.ndarray:
        """Rows of STATS of sorted distinct hashes; zeros of unknown ones."""
        out = np.zeros((len(STATS), len(h)), dtype=np.int64)
        ids, at = np.unique(h >> np.uint64(64 - self.model.buckets_log), return_index=True)
        for s, a, b in zip(ids.tolist(), at.tolist(), [*at[1:].tolist(), len(h)], strict=True):
            found = self.parts(f"words-{s}")
            if found is None:
                continue
            i = place(found[0], h[a:b])
            hit = np.flatnonzero(i >= 0)
            for k in range(len(STATS)):
                out[k, a + hit] = found[k + 1][i[hit]]
        return out

    def score(self, docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base score and score of token arrays."""
        m = self.model
        first, second, where = pairs_of(docs)
        h, at = np.unique(np.concatenate([first, second]), return_inverse=True)
        i, j = at[: len(first)], at[len(first) :]
        c, t, n1, n2, n3, cont = self.words(h).astype(np.float64)
        types = max(m.types, 1)
        kept = np.maximum(cont - m.word[np.minimum(cont, 3).astype(int)], 0) / types
        continuation = kept + (m.mass if m.types else 1.0) / (m.vocabulary + 1)
        total = np.maximum(t, 1)
        backoff = np.where(t > 0, (m.pair[1] * n1 + m.pair[2] * n2 + m.pair[3] * n3) / total, 1.0)
        n = self.pair_counts(first, second)
        p = np.maximum(n - m.pair[np.minimum(n, 3)], 0) / total[i] + backoff[i] * continuation[j]
        base = np.log10((c[j] + 1) / (m.tokens + m.vocabulary + 1))
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        starts = np.cumsum(np.r_[0, lengths[:-1]])
        add = lambda x: np.add.reduceat(x[where], starts)
        return lengths, add((c[j] > 0).astype(np.int64)), add(base), add(np.log10(p))


def place(keys: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Positions of `q` in the sorted `keys`, -1 where it is not."""
    if not len(keys):
        return np.full(len(q), -1)
    i = np.searchsorted(keys, q)
    i[i == len(keys)] = 0
    return np.where(keys[i] == q, i, -1)


def train(df: DataFrame, *, text_col: str = "text") -> KneserNey:
    """A model of every text of `df`; its files stay in the shared folder until delete()."""
    spark = df.sparkSession
    rows = small_batches(df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    tokens, heavy = heavy_words(rows)
    shards = partitions_for(spark, tokens * 8, 24 << 20)
    buckets_log = max(3, math.ceil(math.log2(shards)))
    files = SharedFiles.create(spark, "kneser-ney")
    counted = rows.mapInArrow(pair_counter(heavy, shards), "shard long, pairs binary").repartition(shards, "shard")
    schema = "bucket long, block long, stats binary"
    # With many shards, blocks of them are added up for wide buckets first: rows then grow as shards ** 1.5, not their square.
    two = shards > DIRECT
    wide, block = (-(-buckets_log // 2), math.isqrt(shards)) if two else (buckets_log, shards)
    stats = counted.groupBy("shard").applyInArrow(shard_writer(files, wide, block), schema)
    if two:
        stats = stats.repartition(shards, "bucket", "block").groupBy("bucket", "block").applyInArrow(combiner(buckets_log), schema)
    sums = stats.repartition(1 << buckets_log, "bucket").groupBy("bucket").applyInArrow(word_writer(files), "kind long, m array<long>")
    each = [F.sum(F.get("m", F.lit(k))).alias(f"m{k}") for k in range(8)]
    sums = sums.groupBy("kind").agg(*each).select("kind", F.array(*[F.coalesce(f"m{k}", F.lit(0)) for k in range(8)]).alias("m")).collect()  # two rows
    release(spark)
    met = next((r.m for r in sums if r.kind), [0] * 8)[:4]
    m = next((r.m for r in sums if not r.kind), [0] * 8)
    pair, word = discounts(met), discounts(m[:4])
    mass = (word[1] * m[0] + word[2] * m[1] + word[3] * m[4]) / max(m[5], 1)
    return KneserNey(files, shards, buckets_log, heavy, tokens=m[7], vocabulary=m[6], types=m[5], pair=pair, word=word, mass=float(mass))


def scored(df: DataFrame, model: KneserNey, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10 probabilities of the text) and perplexity (a token) of every row."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # numbers, file names and fewer than 1,000 heavy words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped, hasher = MappedModel(sent.value), Hasher()
        try:
            for chunk in chunks(batches, 1, 4 << 20):
                n, known, base, score = mapped.score([hasher.tokens(t) for t in texts(chunk.column(1))])
                yield pa.RecordBatch.from_arrays([chunk.column(0), *map(pa.array, (n, known, base, score))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
        finally:
            mapped.close()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = small_batches(rows).mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))  # n_tokens: 1 at least


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = train(documents.filter(id_bucket("doc_id", 7) != 2))
    try:
        found = scored(documents, model)
        held = (id_bucket("doc_id", 7) == 2).alias("held_out")
        return cut(found.select("doc_id", held, "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"))
    finally:
        model.delete()
