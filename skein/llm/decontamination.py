"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Texts are lower-cased words; shingles are five words (an item of fewer words is one shingle of its own length). A window
of a text is as long as an item; windows that would begin before the text or go on after it are taken as far as the text
goes. Similarity is the Jaccard similarity of window and item as multisets of shingles, each weighted by how often it
occurs; `similarity` or more counts.

Windows: a window that reaches it with an item of m shingles shares at least `similarity * m` of its own shingles with
that item. So windows are laid wherever so many shingles of the items of that length stand within one, in every distinct
text once; no other window can match, whatever the fingerprints. Each window and each item has a 64-bit SimHash.

Index: the bits are cut into `blocks` blocks, of which one differs in at most `t` bits if all differ in at most `radius`
(pigeonhole; the t of the blocks add up to radius + 1 - blocks). Items are kept under every value of a block within
t - 1 bits of theirs, windows look up every value within one bit: they meet at every such pair, so the search misses no
pair within the radius. At the defaults it meets under a tenth of the pairs of one length. Pairs within the radius are
verified by the exact similarity. The radius is the only approximation: of pairs that just reach 0.8 some 0.3 % differ
in more than 17 bits, of closer ones fewer.

Nulls count as empty text and match nothing; a null id is reported as null; repeated rows and ids give one row for an id
and item, with the best window, the earliest of equal ones, and of these the longest; a text of any length is read
whole; an empty table on either side gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import cut, table
from skein.llm.native import bound, hamming, numbered, shingles, shared_share, simhash, small_side, word_hashes

#: Rows up to which a counted side is broadcast (some 40 bytes a row).
BROADCAST_ROWS = 1_000_000

#: What a product of similarity and size may be off by.
ROUNDING = 1e-9


def ball(value: Column, width: int, radius: int) -> Column:
    """All numbers of `width` bits that differ from `value` in at most `radius`."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(width), k)]
    return F.transform(F.expr(f"array({', '.join(f'{m}L' for m in masks)})"), lambda m: value.bitwiseXOR(m))


def entry(block: int):
    return lambda value: F.struct(F.lit(block).alias("block"), value.alias("value"))


def block_values(fp: Column, radius: int, blocks: int, side: str) -> Column:
    """(block, value) rows of a fingerprint, for the `item` or the `window` side of the index."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    rows = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        most = (radius + 1) // blocks + (k < (radius + 1) % blocks) - 1  # bits that this block may differ in
        near = min(1, max(most, 0)) if side == "window" else max(most - 1, 0)
        if most >= 0:
            value = F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
            rows.append(F.transform(ball(value, b - a, near), entry(k)))
    return F.inline(F.concat(*rows))


def short_runs(hashes: Column, n: int) -> Column:
    """Hashes of all runs of n words, as the only shingle of an item of n words is hashed: as one array."""
    starts = F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i + 1, n)))


def spans(places: Column, n: Column, length: Column, size: int, need: Column) -> Column:
    """Distinct (start, words) of the windows of n words, cut to a text of `length` words, that hold `need` of the
    shingles that stand at `places` (ascending)."""
    whole = n - F.least(n, F.lit(size))  # a window has its last shingle so far behind its first

    def of(p: Column) -> Column:
        first = F.when(F.size(p) >= need, F.sequence(F.lit(0), F.size(p) - need)).otherwise(F.array().cast("array<int>"))
        ranges = F.transform(first, lambda i: F.struct((p[i + need - 1] - whole).alias("low"), p[i].alias("high")))
        starts = F.flatten(F.transform(F.filter(ranges, lambda r: r.low <= r.high), lambda r: F.sequence(r.low, r.high)))
        cut_off = lambda s: F.struct(F.greatest(s, F.lit(0)).alias("start"), (F.least(s + n, length) - F.greatest(s, F.lit(0))).alias("words"))
        return F.array_distinct(F.transform(starts, cut_off))

    return bound(places, of)


def indexed(items: DataFrame, item_col: str, item_text_col: str, size: int) -> DataFrame:
    """(item_id, n, b) of the items that have words: their number and their shingles."""
    bench = items.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("wh")).filter(F.size("wh") > 0)
    return cut(bench.select("item_id", F.size("wh").alias("n"), shingles(F.col("wh"), size).alias("b")))


def laid_windows(docs: DataFrame, bench: DataFrame, text_col: str, size: int, similarity: float) -> DataFrame:
    """(key, n, start, words, a): the windows of every distinct text (by its hash) that could match, and their shingles."""
    lengths = [r["n"] for r in bench.filter(F.col("n") < size).select("n").distinct().collect()]  # 1 .. size - 1
    seeds = cut(bench.select("n", F.explode("b").alias("h")).distinct())
    n_seeds = seeds.count()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(text_key(text_col).alias("key"), text.alias("text"))
    words = keyed.select("key", word_hashes(F.col("text")).alias("wh"))
    held = lambda runs: words.select("key", F.size("wh").alias("size"), F.posexplode(runs).alias("at", "h"))
    hits = held(shingles(F.col("wh"), size, whole=False)).join(small_side(seeds.filter(F.col("n") >= size), n_seeds, BROADCAST_ROWS), "h")
    for n in lengths:
        hits = hits.unionByName(held(short_runs(F.col("wh"), n)).join(small_side(seeds.filter(F.col("n") == n), n_seeds, BROADCAST_ROWS), "h"))
    places = hits.groupBy("key", "n", "size").agg(F.sort_array(F.collect_set("at")).alias("at"))
    need = F.ceil(F.lit(similarity) * F.greatest(F.col("n") - (size - 1), F.lit(1)) - ROUNDING).cast("int")
    laid = places.filter(F.size("at") >= need).select("key", "n", spans(F.col("at"), F.col("n"), F.col("size"), size, need).alias("spans"))
    laid = cut(laid.filter(F.size("spans") > 0))
    of = laid.select(F.col("key").alias("of")).distinct()
    some = keyed.join(small_side(of, laid.count(), BROADCAST_ROWS), F.col("key") == F.col("of"), "left_semi").dropDuplicates(["key"])
    near = cut(some.select("key", word_hashes(F.col("text")).alias("wh"))).join(laid, "key")
    near = near.select("key", "n", "wh", F.inline("spans"))
    return near.select("key", "n", "start", "words", shingles(F.slice("wh", F.col("start") + 1, F.col("words")), size).alias("a"))


def candidates(windows: DataFrame, index: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Rows of `windows` (n, fp, ...) beside those of `index` (item_id, n, item_fp) that one block brings together; a
    pair may come several times."""
    items = cut(index.select("item_id", "n", "item_fp", block_values(F.col("item_fp"), radius, blocks, "item")))
    looked_up = windows.select("*", block_values(F.col("fp"), radius, blocks, "window"))
    return looked_up.join(small_side(items, items.count(), BROADCAST_ROWS), ["n", "block", "value"])


def text_key(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def contaminated_texts(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 5, radius: int = 17, blocks: int = 4, similarity: float = 0.8) -> DataFrame:
    """key (the hash of a text), item_id, start, hamming and similarity of the best window of every text and item."""
    bench = indexed(items, item_col, item_text_col, size)
    windows = laid_windows(docs, bench, text_col, size, similarity)
    windows = cut(windows.select("key", "n", "start", "words", numbered(F.col("a")).alias("a"), simhash(F.col("a")).alias("fp")))
    index = cut(bench.select("item_id", "n", numbered(F.col("b")).alias("b"), simhash(F.col("b")).alias("item_fp")))
    met = candidates(windows.drop("a"), index.drop("b"), radius, blocks)
    pairs = met.withColumn("hamming", hamming(F.col("fp"), F.col("item_fp"))).filter(F.col("hamming") <= radius)
    pairs = cut(pairs.select("key", "n", "start", "words", "item_id", "hamming").distinct())
    sets = small_side(index.select(F.col("item_id").alias("of"), "b"), index.count(), BROADCAST_ROWS // 32)
    verified = pairs.join(windows.drop("fp"), ["key", "n", "start", "words"]).join(sets, F.col("item_id").eqNullSafe(F.col("of")))
    verified = verified.withColumn("similarity", shared_share(F.col("a"), F.col("b"))).filter(F.col("similarity") >= similarity - ROUNDING)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "words", (-F.col("hamming")).alias("close"))).alias("best")
    found = verified.groupBy("key", "item_id").agg(best)
    return found.select("key", "item_id", (-F.col("best.back")).alias("start"), (-F.col("best.close")).alias("hamming"), F.col("best.similarity").alias("similarity"))


def contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 5, radius: int = 17, blocks: int = 4, similarity: float = 0.8) -> DataFrame:
    """doc_id, item_id, start (in words), hamming and similarity of the best window of every matching document and item."""
    found = cut(contaminated_texts(docs, items, text_col=text_col, item_col=item_col, item_text_col=item_text_col, size=size, radius=radius, blocks=blocks, similarity=similarity))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("key")).join(small_side(found, found.count(), BROADCAST_ROWS), "key")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), (-F.col("hamming")).alias("close"))).alias("best")
    rows = rows.groupBy("doc_id", "item_id").agg(best)
    return rows.select("doc_id", "item_id", (-F.col("best.back")).alias("start"), (-F.col("best.close")).alias("hamming"), F.col("best.similarity").alias("similarity"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
