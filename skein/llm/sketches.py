"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch is the sorted set of a text's five-word shingle hashes (a shorter text is one shingle) whose unsigned value is
below `fraction` of the range, and the least hash of all, so that a text with words has a sketch. Sketches of parts
merge by union. Containment of one text in another is the share of its hashes that the other has; the likeness of two
sketches is the larger of the two containments, also between very unequal texts. As text, a fingerprint is the
sketch's hashes in hexadecimal, 16 digits each, in order.

Null text counts as empty: no hash, the empty fingerprint; two empty sketches are alike (1), an empty and another are
not (0). Rows of one id share their place in the order of ids; the text taken of such an id for its neighbour is the
greatest. Null ids come last. A very long text is sketched whole, its sketch growing with it by the fraction. An empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, table
from skein.llm.native import bound, shingles, word_hashes

#: The share of the hash range that a sketch keeps. At a quarter a text of 100 words keeps some 25 hashes; more would not
#: leave the shuffles of op10 within their disk.
FRACTION = 1 / 4


def sketch(text: Column, size: int = 5, fraction: float = FRACTION) -> Column:
    """Sorted long array. Hashes are compared with their sign bit flipped, which orders them as unsigned numbers."""
    most = int(fraction * 2**64) - 2**63
    flip = F.lit(-(2**63)).cast("long")

    def keep(a: Column) -> Column:
        kept = bound(F.array_min(a), lambda least: F.filter(a, lambda h: (h < F.lit(most)) | (h == least)))
        return F.array_sort(F.array_distinct(kept))

    return bound(F.transform(shingles(word_hashes(text), size), lambda h: h.bitwiseXOR(flip)), keep)


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    most = int(fraction * 2**64) - 2**63

    def keep(u: Column) -> Column:
        return F.array_sort(bound(F.array_min(u), lambda least: F.filter(u, lambda h: (h < F.lit(most)) | (h == least))))

    return bound(F.array_union(a, b), keep)


def containment(a: Column, b: Column) -> Column:
    """The estimated share of a's shingles that b has."""
    common = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) > 0, common / F.size(a)).otherwise(F.when(F.size(b) > 0, F.lit(0.0)).otherwise(F.lit(1.0)))


def likeness(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.when(F.size(a) == F.size(b), F.lit(1.0)).otherwise(F.lit(0.0)))


def as_text(a: Column) -> Column:
    flip = F.lit(-(2**63)).cast("long")
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h.bitwiseXOR(flip))), 16, "0")), "")


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (null: empty) and sketch of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", sketch(F.col("text")).alias("sketch"))


def keyed(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """`df` with a null-safe key of an id in two columns: joins and groups by them share one way of dealing rows."""
    return df.withColumns({f"{prefix}key": F.coalesce(column, F.lit(0)), f"{prefix}none": F.col(column).isNull()})


def following(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) in descending order of distinct `ids` (after the last: the first), nulls last.

    The order is cut into ranges; only the first id of each range meets the others' in one place.
    """
    order = F.col("doc_id").desc_nulls_last()
    ranged = cut(ids.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(order)
    seen = ranged.select("doc_id", "part", F.lead(F.struct("doc_id")).over(inside).alias("next"))
    heads = ranged.groupBy("part").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("head"))
    heads = heads.select("part", F.struct(F.col("head.doc_id").alias("doc_id")).alias("head"))
    across = Window.orderBy("part")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(F.col("part").alias("of"), F.coalesce(F.lead("head").over(across), F.first("head").over(whole)).alias("after"))
    met = seen.join(F.broadcast(heads), F.col("part") == F.col("of"))  # a row for each range
    return met.select("doc_id", F.coalesce("next", "after").getField("doc_id").alias("next_id"))


def edited(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with its next document and its edited text (the last third replaced by the next one's beginning).

    Texts are dealt by id once, for both joins (which therefore need the same columns of them), and sketched behind the
    deal; the next document sends its sketch and no more than the beginning that is needed.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = keyed(df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")), "doc_id", "").drop("doc_id")
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.char_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("n"))
    most = cut(source.groupBy("doc_id").agg((F.max("n") / 3).cast("int").alias("most")))
    pairs = most.join(following(most.select("doc_id")).withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")))
    pairs = cut(keyed(keyed(pairs.select("doc_id", "next_id", "most"), "doc_id", "before_"), "next_id", "next_"))
    pairs = pairs.select("before_key", "before_none", "next_key", "next_none", "most")
    sent = docs.join(pairs, (F.col("key") == F.col("next_key")) & (F.col("none") == F.col("next_none")))
    begin = F.struct(F.substring("text", F.lit(1), F.col("most")).alias("begin"), sketch(F.col("text")).alias("next_sketch"))
    sent = sent.select("before_key", "before_none", begin.alias("sent")).groupBy("before_key", "before_none").agg(F.max("sent").alias("sent"))
    rows = docs.join(sent, (F.col("key") == F.col("before_key")) & (F.col("none") == F.col("before_none")))
    rows = rows.withColumn("n_chars", F.char_length("text"))
    cut_off = F.floor(F.col("n_chars") / 3).cast("int")
    head = F.substring("text", F.lit(1), F.col("n_chars") - cut_off)
    text = F.concat(head, F.substring(F.col("sent.begin"), F.lit(1), cut_off))
    own = F.when(~F.col("none"), F.col("key")).alias("doc_id")
    return rows.select(own, F.col("n_chars").cast("long").alias("n_chars"), sketch(F.col("text")).alias("sketch"), F.col("sent.next_sketch").alias("next_sketch"), text.alias("edited"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited(table(spark, sf_dir, "documents"))
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "sketch", "next_sketch", sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
