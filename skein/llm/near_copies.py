"""SimHash near-duplicates held to an exact similarity: a Jaccard of `similarity` or more of the sets of word shingles.

Words are those of `simhash_dedup` (A-Z lower-cased, cut at ASCII white space); a text is the set of its shingles of
`size` words (a shorter text is one shingle; no word gives the empty set, which only equals itself). Texts of one set
are one node from the start.

First come SimHash's candidates: fingerprints of the sets, pigeonhole blocks and Hamming distance as in `simhash_dedup`.
A radius that a block index can afford holds only the closest pairs, however: at a Jaccard of 0.8 fingerprints differ in
some 10 of 64 bits, strangers' in some 32. So a prefix search brings together the rest: with the shingles of every set
in one order, two sets of that similarity share a shingle among the first `n - ceil(similarity n) + 1` of each, of each, whatever
the order is. The order is by how often a shingle occurs in a sample of the texts, rare ones first, then by hash; the
sample decides only how many candidates there are, and which shingles are dealt over several tasks.

Of a shingle's texts each is first compared with one, the one with the fewest of its own shingles before it, which most
of the others resemble if any do. Only texts still in different components, and of sizes that allow the similarity, are
then compared with each other, so a large group of copies does not emit its pairs. Where these would be more than
`PAIRS` for each text, rounds come between: every text is compared with the one of its shingle and about its size that
has the most links so far, until that links no more. In what is left then two texts of a group of more than `MANY` are
a pair only if the parities of their sets differ in no more bits than the sets may have shingles that they don't share.

Candidates are verified by their fingerprints' Hamming distance, at most `reach` (a pair of that similarity is farther
apart once in some 100,000 times), then by their sets, exactly; sets are made again from the few texts that come so far.

Null text counts as empty; null and repeated ids keep a row each; a very long text is one set, whole; an empty table
gives none; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import chunks, cut, small_batches, texts
from skein.llm.components import Rounds, components
from skein.llm.lm_scoring import Hasher, mix
from skein.llm.native import bound, small_side
from skein.llm.simhash_dedup import fingerprint, links

#: Texts of the sample that the order of the shingles comes from, and the most shingles it holds.
SAMPLE, COMMON = 5_000, 200_000

#: Rows up to which a counted side is broadcast.
BROADCAST_ROWS = 1_000_000

#: Texts of one shingle above which its rows are dealt over several tasks.
HOT = 50_000

#: Pairs of one shingle's texts in different components, for each of its texts, up to which they are compared at once;
#: the most rounds that come before else.
PAIRS, ROUNDS = 8, 4

#: Texts of one shingle above which pairs are held to their sets' parities, and the 64-bit numbers of these.
MANY, PARITIES = 64, 16

#: What a product of similarity and size may be off by.
ROUNDING = 1e-9


def text_key(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def shingle_set(hasher: Hasher, text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, as signed numbers."""
    words = hasher.tokens(text)[:-1]
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    n = max(len(words) - size + 1, 1)
    h = words[:n]
    for k in range(1, min(size, len(words))):
        h = mix(h, words[k : k + n])
    return np.unique(h.view(np.int64))


def set_rows(df: DataFrame, size: int) -> DataFrame:
    """`df` (..., t) with (node, s), the hash of a text's set and the set, in place of the text t (the last column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for chunk in chunks(batches, chunk_col, 4 << 20):
            sets = [shingle_set(hasher, t, size) for t in texts(chunk.column(chunk_col))]
            nodes = [xxhash.xxh64_intdigest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays([*chunk.columns[:-1], signed(nodes), lists(sets)], names=[*chunk.schema.names[:-1], "node", "s"])

    chunk_col = len(df.columns) - 1
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]]
    return small_batches(df).mapInArrow(run, ", ".join([*kept, "node long", "s array<long>"]))


def parities(s: np.ndarray) -> np.ndarray:
    """64 * PARITIES bits of a set, each telling if an odd number of its hashes fall to it."""
    bits = np.bincount((s.view(np.uint64) % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.array(numbers, dtype=np.uint64).view(np.int64))


def lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *arrays])))


def common_shingles(texts_: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are in several texts of a sample, sorted, and in how many."""
    share = min(1.0, SAMPLE / max(texts_.count(), 1))
    some = texts_.select("t").filter(F.xxhash64("t") <= int(share * 2.0**64) - 2**63 - 1).distinct()
    seen = set_rows(some, size).select(F.explode("s").alias("h")).groupBy("h").agg(F.count("*").alias("n")).filter("n > 2")
    found = seen.orderBy(F.desc("n"), "h").limit(COMMON).orderBy("h").toArrow()
    return found.column("h").to_numpy(), found.column("n").to_numpy()


def described(df: DataFrame, common: tuple[np.ndarray, np.ndarray], size: int, similarity: float) -> DataFrame:
    """(doc_id, text_key, node, n, fp, s, odd) of rows (doc_id, text_key, t): a text's node, its set's size and fingerprint,
    the first shingles of the set in the common order, and its parities."""
    sent = df.sparkSession.sparkContext.broadcast(common)  # at most COMMON shingles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (known, times) = Hasher(), sent.value
        for chunk in chunks(batches, 2, 4 << 20):
            nodes, sizes, fps, firsts, odd = [], [], [], [], []
            for t in texts(chunk.column(2)):
                s = shingle_set(hasher, t, size)
                n_of = np.zeros(len(s), dtype=np.int64)
                if len(known):
                    i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    n_of = np.where(known[i] == s, times[i], 0)
                first = len(s) - math.ceil(similarity * len(s) - ROUNDING) + 1 if len(s) else 0
                firsts.append(s[np.argsort(n_of, kind="stable")[:first]])
                nodes.append(xxhash.xxh64_intdigest(s.tobytes()))
                sizes.append(len(s))
                fps.append(fingerprint(s.view(np.uint64)))
                odd.append(parities(s))
            arrays = [chunk.column(0), chunk.column(1), signed(nodes), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), lists(firsts), lists(odd)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "node", "n", "fp", "s", "odd"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return small_batches(df).mapInArrow(run, f"doc_id {kind}, text_key long, node long, n int, fp long, s array<long>, odd array<long>")


def hot_shingles(spark: SparkSession, common: tuple[np.ndarray, np.ndarray], texts_of_all: int) -> DataFrame:
    """(h, parts) of the sampled shingles that some `HOT` texts and more should have: their rows are dealt over parts."""
    times = common[1] * (texts_of_all / SAMPLE)
    hot = times > HOT
    found = [(int(h), int(n // HOT) + 1) for h, n in zip(common[0][hot].tolist(), times[hot].tolist(), strict=True)]
    return spark.createDataFrame(found, "h long, parts long")


def shared_entries(tables: Rounds, rows: DataFrame, hot: DataFrame) -> DataFrame:
    """(h, node, n, pos, fp, hub) of every first shingle that several nodes have, hub being the one of these that has the
    least share of its set before it. A hot shingle's nodes have a hub for each of its parts."""
    of = rows.groupBy("node").agg(F.min("row").alias("row"), F.count("*").alias("of"))
    again = rows.select("row", "node").join(of.filter("of > 1").select("node", F.col("row").alias("first")), "node").filter("row <> first").select("row")
    again = cut(again)
    once = rows.join(small_side(again, again.count(), BROADCAST_ROWS), "row", "left_anti")
    entries = once.select("node", "n", "fp", F.posexplode("s").alias("pos", "h")).join(F.broadcast(hot), "h", "left")
    own = Window.partitionBy("h", "part")
    entries = entries.select("h", F.coalesce(F.pmod("node", "parts"), F.lit(0)).alias("part"), F.col("parts").isNotNull().alias("hot"), "node", "n", "pos", "fp")
    entries = entries.withColumns({"of": F.count("*").over(own), "hub": F.min(F.struct(before(), "node", "n", "pos", "fp")).over(own)})
    return tables.write(entries.filter("of > 1 OR hot").drop("of", "hot", "part"))[1]


def before() -> Column:
    return (F.col("pos") / F.col("n")).alias("before")


def near(a: Column, b: Column, reach: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= reach


def close_pairs(rows: DataFrame, radius: int, blocks: int) -> DataFrame:
    """SimHash's candidates (a, b): nodes of one fingerprint as a star, and stars of fingerprints within the radius."""
    of = cut(rows.select("fp", "node").distinct())
    first = cut(of.groupBy("fp").agg(F.min("node").alias("first")))
    same = of.join(first, "fp").filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    end = lambda c: first.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_node"))
    linked = links(first.select("fp"), radius=radius, blocks=blocks).join(end("a"), "a").join(end("b"), "b")
    return same.unionByName(linked.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def can_reach(a: Column, b: Column, similarity: float) -> Column:
    """Whether two entries (n, pos) of one shingle, if it is the first that their sets share, leave enough to share."""
    most = F.least(a.n - a.pos, b.n - b.pos)
    return most * (1 + similarity) >= similarity * (a.n + b.n) - ROUNDING


def verified(tables: Rounds, pairs: DataFrame, rows: DataFrame, text: DataFrame, size: int, similarity: float) -> DataFrame:
    """The `pairs` (a, b) of nodes whose sets, made of one text of each, have the similarity."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = rows.select("node", "text_key").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("k"))
    keys = cut(keys.select("k").distinct())
    some = text.join(small_side(keys, keys.count(), BROADCAST_ROWS), F.col("text_key") == F.col("k"), "left_semi")
    path, sets = tables.write(set_rows(some.select("t"), size).dropDuplicates(["node"]))
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    ok = bound(both, lambda n: n * (1 + F.lit(similarity)) >= F.lit(similarity) * (F.size("x") + F.size("y")) - ROUNDING)
    found = cut(pairs.join(left, "a").join(right, "b").filter(ok).select("a", "b"))
    tables.delete(path)
    return found


def size_band(n: Column, similarity: float) -> Column:
    """Sets of the similarity are in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(similarity)) + ROUNDING).cast("int")


def open_entries(entries: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """(h, node, n, pos, fp, label, band) of the shingles whose nodes are in different components."""
    labelled = entries.join(labels, "node", "left").select("h", "node", "n", "pos", "fp", F.coalesce("label", "node").alias("label"))
    mixed = cut(labelled.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("h"))
    return cut(labelled.join(small_side(mixed, mixed.count(), BROADCAST_ROWS), "h").withColumn("band", size_band(F.col("n"), similarity)))


def crowded(open_: DataFrame) -> bool:
    """Whether the shingles' nodes have more than `PAIRS` pairs each in different components."""
    of = open_.groupBy("h", "label").agg(F.count("*").alias("c")).groupBy("h").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("own"))
    found = of.agg(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2).alias("pairs"), F.sum("n").alias("n")).first()
    return (found.pairs or 0) > PAIRS * (found.n or 0)


def met_pairs(met: DataFrame, ok: Column, similarity: float, reach: int) -> DataFrame:
    """Pairs (a, b) of the entries p and q in a row that are `ok`, in different components and could reach the similarity."""
    met = met.filter((F.col("p.label") != F.col("q.label")) & near(F.col("p.fp"), F.col("q.fp"), reach) & can_reach(F.col("p"), F.col("q"), similarity) & ok)
    return met.select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()


def hub_pairs(open_: DataFrame, edges: DataFrame, similarity: float, reach: int) -> DataFrame:
    """Pairs (a, b) of an entry and the one of its shingle, in each band of sizes beside its own, that has most links."""
    of = edges.select(F.col("a").alias("node")).unionAll(edges.select("b")).groupBy("node").agg(F.count("*").alias("links"))
    rank = F.struct((-F.coalesce("links", F.lit(0))).alias("links"), before(), "node", "n", "pos", "fp", "label")
    hubs = cut(open_.join(of, "node", "left").groupBy("h", "band").agg(F.min(rank).alias("q")))
    beside = hubs.select("h", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])).alias("band"), "q")
    met = open_.select("h", "band", F.struct("node", "n", "pos", "fp", "label").alias("p"))
    return met_pairs(met.join(small_side(beside, 3 * hubs.count(), BROADCAST_ROWS), ["h", "band"]), F.lit(True), similarity, reach)


def with_parities(open_: DataFrame, rows: DataFrame) -> DataFrame:
    """`open_` with odd, the parities of a node's set; null in small groups."""
    large = cut(open_.groupBy("h").agg(F.count("*").alias("of")).filter(F.col("of") > MANY).select("h", F.lit(True).alias("large")))
    if not (n := large.count()):
        return open_.withColumn("odd", F.lit(None).cast("array<long>"))
    marked = cut(open_.join(small_side(large, n, BROADCAST_ROWS), "h", "left"))
    odd = rows.join(marked.filter("large").select("node").distinct(), "node", "left_semi").select("node", "odd").dropDuplicates(["node"])
    return marked.join(odd, "node", "left").withColumn("odd", F.when(F.col("large"), F.col("odd"))).drop("large")


def may_share(p: Column, q: Column, similarity: float) -> Column:
    """Whether two nodes' parities (odd) allow the similarity: a shingle of one set alone changes one bit, so no more bits
    differ than there are such shingles, and the similarity allows at most n + m - 2 overlap of them."""
    overlap = F.ceil((p.n + q.n) * F.lit(similarity / (1 + similarity)) - ROUNDING)
    differ = sum((F.bit_count(p.odd[k].bitwiseXOR(q.odd[k])) for k in range(PARITIES)), F.lit(0))
    return p.odd.isNull() | q.odd.isNull() | (differ <= p.n + q.n - 2 * overlap)


def unlinked_pairs(open_: DataFrame, rows: DataFrame, similarity: float, reach: int) -> DataFrame:
    """Pairs (a, b) of one shingle that are in different components and could reach the similarity."""
    all_ = with_parities(open_, rows).select("h", "band", F.struct("node", "n", "pos", "fp", "label", "odd").alias("e"))
    left = all_.select("h", F.col("band").alias("at"), "band", F.col("e").alias("p"))
    right = all_.select("h", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("at"), F.col("band").alias("own"), F.col("e").alias("q"))
    once = (F.col("band") < F.col("own")) | (F.col("p.node") < F.col("q.node"))
    met = left.join(right, ["h", "at"])
    return met_pairs(met.filter(once), may_share(F.col("p"), F.col("q"), similarity), similarity, reach)


def near_copies(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8, radius: int = 4, blocks: int = 6, reach: int = 22) -> DataFrame:
    """doc_id, text_key and copy_group (a number for each component of near copies) of every row."""
    text = df.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    common = common_shingles(text, size)
    tables = Rounds(df.sparkSession, "near-copies")
    rows = tables.write(described(text, common, size, similarity).withColumn("row", F.monotonically_increasing_id()))[1]
    entries = shared_entries(tables, rows, hot_shingles(df.sparkSession, common, rows.count()))
    ok = near(F.col("fp"), F.col("hub.fp"), reach) & can_reach(F.struct("n", "pos"), F.col("hub"), similarity)
    stars = entries.filter((F.col("node") != F.col("hub.node")) & ok).select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    first = stars.unionByName(close_pairs(rows, radius, blocks))
    first = cut(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    text = text.select("text_key", "t")
    edges = verified(tables, first, rows, text, size, similarity)
    entries, tried = entries.drop("hub"), first
    for k in range(ROUNDS + 1):
        open_ = open_entries(entries, components(edges), similarity)
        if k == ROUNDS or not crowded(open_):
            break
        met = cut(hub_pairs(open_, edges, similarity, reach).join(tried, ["a", "b"], "left_anti"))
        found = verified(tables, met, rows, text, size, similarity)
        tried = tried.unionByName(met)
        if found.isEmpty():
            break
        edges = edges.unionByName(found)
    met = cut(unlinked_pairs(open_, rows, similarity, reach).join(tried, ["a", "b"], "left_anti"))
    labels = components(edges.unionByName(verified(tables, met, rows, text, size, similarity)))
    group = F.coalesce("label", "node").alias("copy_group")
    found = cut(rows.select("doc_id", "text_key", "node").join(labels, "node", "left").select("doc_id", "text_key", group))
    tables.delete()
    return found
