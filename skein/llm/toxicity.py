"""Toxicity scores from two class-conditional Kneser-Ney models of the letters of words.

A word (Unicode white space cut, lower-cased) is spelt with start marks before it and an end mark behind it. A shared
model of both classes' words is interpolated Kneser-Ney: counts of whole contexts of `order - 1` letters, continuation
counts of the shorter ones, down to the uniform one. A class's probability of a letter after a context is its own
discounted counts, with the shared model taking the discounted mass and that of `weight` further letters: rare
expressions are smoothed through the shared counts, and weigh nothing unless one class has them far more than the other.

A word's evidence is the difference of its log-likelihoods under the two models. A text's evidence is that difference
over the `passage` words that speak most for the toxic class, divided by their number, so it does not depend on how
many ordinary words surround them (the mean over all words parts the classes far worse; the README has figures). The
score maps the evidence to 0..1 through a logistic curve, fitted on a quarter of the labelled rows with models of the
other three, and set to the classes' shares among all labels; the models that are kept are of all rows. Models and curve
are fitted on at most `max_rows` labelled rows of each class (those of the least hashed ids), whole texts; that bounds
what the driver gathers and workers are sent.

Null text counts as empty; a text without words has evidence 0; one of fewer words than `passage` is filled up with
words of no evidence; a very long text is read whole, its words a batch at a time. Labels other than 0 and 1 and null
labels teach nothing; of several labels of one id the largest counts; without labelled rows of both classes every score
is the share of toxic rows (0.5 without any). Repeated rows and null ids keep a row each; an empty table gives none;
other columns are not looked at, but the result's column takes the place of one of its name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.llm.common import cut, give_back, id_bucket, release, small_batches, table, texts, with_results

#: Code points that mark a word's start and end.
START, END = 2, 3

#: Words whose evidence one worker holds, and the longest of them; beyond it the memo starts anew.
MEMO, MEMO_LETTERS = 150_000, 40

#: Letters that are looked up in one go, and words whose grams are counted in one go.
LETTERS, WORDS = 1 << 18, 1 << 15


def words_of(text: str) -> list[str]:
    return text.lower().split()


def spelt(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the words, each after order - 1 start marks and before an end mark; the positions of the letters and
    end marks among them, and the word each of these is of."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(lengths + order)
    symbols = np.full(ends[-1] if len(words) else 0, START, dtype=np.uint32)
    symbols[ends - 1] = END
    word = np.repeat(np.arange(len(words)), lengths + 1)
    at = np.arange(len(word)) + (word + 1) * (order - 1)
    symbols[at[symbols[at] != END]] = letters
    return symbols, at, word


def keys_of(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of symbols, given by columns."""
    h = np.zeros(len(columns[0]) if columns else 0, dtype=np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def keys(rows: np.ndarray) -> np.ndarray:
    return keys_of(list(rows.T)) if rows.shape[1] else np.zeros(len(rows), dtype=np.uint64)


def discounted(rows: np.ndarray, n: np.ndarray, lower: np.ndarray, discount: float) -> np.ndarray:
    """Probability of each row's last symbol after the others, from counts `n` and the lower order's probabilities."""
    _, context = np.unique(keys(rows[:, :-1]), return_inverse=True)
    total, kinds = np.bincount(context, n), np.bincount(context)
    return np.maximum(n - discount, 0) / total[context] + (discount * kinds / total)[context] * lower


def shared_model(grams: np.ndarray, n: np.ndarray, discount: float) -> np.ndarray:
    """Interpolated Kneser-Ney probability of each of the distinct `grams` (a row of symbols each, met n times)."""
    order = grams.shape[1]
    lower, known = None, None
    uniform = 1 / (len(np.unique(grams[:, -1])) + 1)
    for k in range(1, order + 1):
        rows, counts = grams, n
        if k < order:  # in how many distinct grams of one symbol more a gram is the end
            longer = grams[:, order - k - 1 :]
            longer = longer[np.unique(keys(longer), return_index=True)[1]]
            _, first, counts = np.unique(keys(longer[:, 1:]), return_index=True, return_counts=True)
            rows = longer[first, 1:]
        below = np.full(len(rows), uniform) if k == 1 else lower[np.searchsorted(known, keys(rows[:, 1:]))]
        lower = discounted(rows, counts, below, discount)
        known = keys(rows)
        order_of = np.argsort(known)
        if k < order:
            lower, known = lower[order_of], known[order_of]
    return lower


class Tables:
    """log P(letter | context, toxic) - log P(letter | context, ordinary): of each gram that was counted, and of any
    other letter after each context that was (there the shared model's probability cancels). Sorted by hash."""

    def __init__(self, grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, *, discount: float, weight: float):
        if not len(grams):
            self.gram = self.context = np.zeros(0, dtype=np.uint64)
            self.of_gram = self.of_other = np.zeros(0, dtype=np.float32)
            return
        shared = shared_model(grams, toxic + ordinary, discount)
        context_keys, context = np.unique(keys(grams[:, :-1]), return_inverse=True)
        logs, others = [], []
        for n in (toxic, ordinary):
            total = np.bincount(context, n)
            kept = np.maximum(n - discount, 0)
            spare = total - np.bincount(context, kept) + weight
            logs.append(np.log((kept + spare[context] * shared) / (total + weight)[context]))
            others.append(np.log(spare / (total + weight)))
        gram_keys = keys(grams)
        order = np.argsort(gram_keys)
        self.gram, self.of_gram = gram_keys[order], (logs[0] - logs[1])[order].astype(np.float32)
        self.context, self.of_other = context_keys, (others[0] - others[1]).astype(np.float32)

    def words(self, words: list[str], order: int) -> np.ndarray:
        """The evidence of each word."""
        symbols, at, word = spelt(words, order)
        columns = [symbols[at - k] for k in range(order - 1, -1, -1)]
        of_gram, known = found(self.gram, self.of_gram, keys_of(columns))
        of_other, _ = found(self.context, self.of_other, keys_of(columns[:-1]) if order > 1 else np.zeros(len(at), dtype=np.uint64))
        return np.bincount(word, np.where(known, of_gram, of_other), minlength=len(words))


def found(sorted_keys: np.ndarray, values: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the queried keys (0 of unknown ones), and which are known."""
    if not len(sorted_keys):
        return np.zeros(len(query)), np.zeros(len(query), dtype=bool)
    i = np.minimum(np.searchsorted(sorted_keys, query), len(sorted_keys) - 1)
    hit = sorted_keys[i] == query
    return np.where(hit, values[i], 0.0), hit


class Scorer:
    """evidence(texts) -> evidence of each text."""

    def __init__(self, tables: Tables, order: int, passage: int, memo: int = MEMO):
        self.tables, self.order, self.passage, self.limit = tables, order, passage, memo
        self.memo: dict[str, float] = {}

    def learn(self, words: list[str]) -> dict[str, float]:
        out, some, size = {}, [], 0
        for w in words:
            some.append(w)
            size += len(w) + 1
            if size >= LETTERS:
                out.update(zip(some, self.tables.words(some, self.order).tolist(), strict=True))
                some, size = [], 0
        if some:
            out.update(zip(some, self.tables.words(some, self.order).tolist(), strict=True))
        return out

    def evidence(self, batch: list[str]) -> np.ndarray:
        out, some, size = [], [], 0
        for t in batch:
            some.append(t)
            size += len(t)
            if size >= LETTERS:
                out.append(self.some(some))
                some, size = [], 0
        return np.concatenate([*out, self.some(some)])

    def some(self, batch: list[str]) -> np.ndarray:
        if len(self.memo) > self.limit:
            self.memo.clear()
        cut_up = [words_of(t) for t in batch]
        new = self.learn(list(set().union(*cut_up) - self.memo.keys()))
        self.memo.update((w, e) for w, e in new.items() if len(w) <= MEMO_LETTERS)
        memo, out = self.memo, np.zeros(len(batch))
        for i, words in enumerate(cut_up):
            e = np.array([memo[w] if w in memo else new[w] for w in words])
            top = e if len(e) <= self.passage else np.partition(e, len(e) - self.passage)[-self.passage :]
            out[i] = np.sort(top).sum() / self.passage
        return out


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of a lightly ridged logistic regression of y (0, 1) on x, by Newton's method."""
    scale = float(x.std()) or 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hessian, z.T @ (p - y) + np.array([1e-3, 0]) * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]) / scale, float(w[1])


class ToxicityModel:
    """A fitted scorer: bounded tables and the logistic curve, sent to workers by broadcast."""

    def __init__(self, spark: SparkSession, tables: Tables, order: int, passage: int, slope: float = 0.0, intercept: float = 0.0):
        self.sent = spark.sparkContext.broadcast(tables)  # bounded with the sample that was learnt from
        self.order, self.passage, self.slope, self.intercept = order, passage, slope, intercept

    def evidence(self, df: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, name: str = "evidence") -> DataFrame:
        """`keep` columns (all, if not given) and the evidence of every row."""
        sent, order, passage = self.sent, self.order, self.passage

        def start():
            scorer = Scorer(sent.value, order, passage)
            return lambda batch: [pa.array(scorer.evidence(["" if t is None else t for t in batch]), pa.float64())]

        return with_results(df, text_col, df.columns if keep is None else keep, T.StructType().add(name, "double"), start)

    def score(self, evidence: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * evidence + F.lit(self.intercept))))


def labelled_ids(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, y): the largest label of every id."""
    return labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("y")).filter("doc_id is not null")


def labelled_sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int) -> DataFrame:
    """At most `max_rows` labelled rows of each class: (doc_id, text, y). Ids are chosen before texts are read."""
    ids = labelled_ids(labels, id_col, label_col)
    key = F.xxhash64("doc_id")
    some = [ids.filter(F.col("y") == c).orderBy(key, "doc_id").limit(max_rows) for c in (0, 1)]
    chosen = cut(some[0].unionByName(some[1]))  # at most 2 * max_rows ids
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").cast("int").alias("y"))


#: What is counted of a gram: how often toxic and ordinary texts have it, of the rows for the models and of those for the curve.
COUNTS = ["toxic", "ordinary", "held_toxic", "held_ordinary"]


def counted(every: list[str], words: list[Counter[str]], order: int) -> pa.RecordBatch:
    """The grams of some words, with their COUNTS."""
    symbols, at, word = spelt(every, order)
    columns = [symbols[at - k] for k in range(order - 1, -1, -1)]
    _, first, gram = np.unique(keys_of(columns), return_index=True, return_inverse=True)
    rows = np.column_stack([c[first] for c in columns]).astype("<u4")
    counts = [np.bincount(gram, np.array([c[w] for w in every])[word]).astype(np.int64) for c in words]
    offsets = pa.py_buffer(np.arange(0, (len(rows) + 1) * 4 * order, 4 * order, dtype=np.int32))
    grams = pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(rows.tobytes())])
    return pa.RecordBatch.from_arrays([grams, *map(pa.array, counts)], names=["gram", *COUNTS])


def gram_counter(order: int):
    """A mapInArrow function from (text, y, held) to the grams of `order` symbols and their COUNTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[Counter[str]] = [Counter() for _ in COUNTS]
        for batch in batches:
            for text, y, held in zip(texts(batch.column(0)), *(c.to_pylist() for c in batch.columns[1:]), strict=True):
                words[2 * held + 1 - y].update(words_of(text))
        every = list(set().union(*words))
        for i in range(0, len(every), WORDS):
            yield counted(every[i : i + WORDS], words, order)

    return run


def symbols_of(column: pa.ChunkedArray, order: int) -> np.ndarray:
    """A row of symbols for each gram of a binary column; no object is made of each, as there are millions."""
    parts = [np.zeros(0, dtype="<u4")]
    for chunk in column.cast(pa.binary()).chunks:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            ends = np.frombuffer(offsets, dtype=np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]].view("<u4"))
    return np.concatenate(parts).reshape(-1, order)


def two_tables(found: pa.Table, order: int, discount: float, weight: float) -> tuple[Tables, Tables]:
    """The models of the rows that are not held out, and of all, from the grams' COUNTS."""
    grams = symbols_of(found.column("gram"), order)
    toxic, ordinary, held_toxic, held_ordinary = (found.column(c).to_numpy().astype(float) for c in COUNTS)
    seen = toxic + ordinary > 0
    part = Tables(grams[seen], toxic[seen], ordinary[seen], discount=discount, weight=weight)
    return part, Tables(grams, toxic + held_toxic, ordinary + held_ordinary, discount=discount, weight=weight)


def fit(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", order: int = 8, discount: float = 0.75, weight: float = 100.0, passage: int = 3, max_rows: int = 4000) -> ToxicityModel:
    """Class models from the labelled rows of `labels` (id_col, label_col in 0, 1).

    The curve is fitted on a quarter of the rows, scored by models of the others; the models that are kept are of all.
    """
    spark = df.sparkSession
    sample = cut(labelled_sample(df, labels, id_col, text_col, label_col, max_rows).withColumn("held", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0).cast("int")))
    counted = small_batches(sample.select("text", "y", "held")).mapInArrow(gram_counter(order), ", ".join(["gram binary", *(f"{c} long" for c in COUNTS)]))
    found = counted.groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTS]).orderBy("gram")
    grams = found.toArrow()  # bounded with the sample
    release(spark)  # the JVM's heap shrinks before Python's arrays grow: both are the driver's memory
    part, whole = two_tables(grams, order, discount, weight)
    del grams
    give_back()
    before = ToxicityModel(spark, part, order, passage)
    held = before.evidence(sample.filter("held = 1"), keep=["y"]).toArrow()
    before.sent.unpersist()
    model = ToxicityModel(spark, whole, order, passage)
    y, x = held.column(0).to_numpy(), held.column(1).to_numpy()
    if len(set(y.tolist())) == 2:
        model.slope, model.intercept = logistic(x, y.astype(float))
        # The sample may hold one class whole and a part of the other; the curve is for the shares that the labels have.
        taken = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
        every = {r["y"]: r["count"] for r in labelled_ids(labels, id_col, label_col).groupBy("y").count().collect() if r["y"] in taken}
        model.intercept += math.log(every[1] / every[0]) - math.log(taken[1] / taken[0])
    else:
        share = sample.agg(F.avg("y")).first()[0]
        share = 0.5 if share is None else min(max(share, 1e-6), 1 - 1e-6)
        model.slope, model.intercept = 0.0, math.log(share / (1 - share))
    return model


def fit_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels a model may learn from: those of ids outside the held-out bucket."""
    return labels.filter(id_bucket(id_col, 5) != 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents, fit_labels(table(spark, sf_dir, "labels")))
    score = model.score(F.col("evidence"))
    scored = model.evidence(documents, keep=["doc_id"]).select("doc_id", (id_bucket("doc_id", 5) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
