"""Corpus preparation: stages that each read what the one before has written.

Toxic texts go, then texts that belong to no language (none at all, as null or without a letter, or unlike all that was
learnt), then near copies (one row of each group stays, that of the least id), then texts that hold benchmark items; the
rest is packed. Copies are told by their texts, whatever their ids, and so are texts that hold an item: different texts
of a null or repeated id each have their own fate. No stage reads a column but doc_id, text and (to learn from) lang;
all but the last return every column of their input, whatever its other columns are named. Texts of any length are
read whole; an empty table gives none. Each stage begins with executors' heaps shrunk to what still lives, as what its
Python workers take comes on top of what the stages before have left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import decontamination, language_id, near_copies, packing, toxicity
from skein.llm.common import cut, delete, shared_dir, shrink_heaps, table, unused
from skein.llm.native import small_side

#: A text scores at least this if it is toxic.
TOXIC = 0.5

#: Chunks a worker's encoder holds: workers outlive stages, whose memory adds up.
MEMO = 200_000


def as_they_were(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op3: rows that score less than TOXIC stay, the model being fitted on all labels."""
    shrink_heaps(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    (name,) = unused(docs, "evidence")
    return as_they_were(model.evidence(docs, name=name).filter(model.score(F.col(name)) < TOXIC), docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op7: rows that belong to the language that the classifier gives them stay."""
    shrink_heaps(spark)
    names = unused(docs, "lang_pred", "score", "belongs")
    found = language_id.fit(docs).predict(docs, names=tuple(names))
    return as_they_were(found.filter((F.col(names[0]) != language_id.UNKNOWN) & F.col(names[2])), docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op5, held to a Jaccard of 0.8 of five-word shingles: of each group the row of the least (id, text) stays."""
    shrink_heaps(spark)
    rows = cut(near_copies.near_copies(docs).groupBy("doc_id", "text_key", "copy_group").agg(F.count("*").alias("times")))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    least = rows.groupBy("copy_group").agg(F.min(rank).alias("least"))
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))
    of, key, stays, own = unused(docs, "of_id", "of_key", "stays", "own_key")
    marked = rows.join(least, "copy_group").select(F.col("doc_id").alias(of), F.col("text_key").alias(key), first.alias(stays), "times")
    marked = cut(marked.filter(~F.col(stays) | (F.col("times") > 1)).select(of, key, stays))
    marked = small_side(marked, marked.count(), near_copies.BROADCAST_ROWS)
    same = (F.col(own) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(of))
    found = docs.withColumn(own, near_copies.text_key()).join(marked, same, "left")
    alone = found.filter(F.col(stays).isNull())
    repeated = found.filter(F.col(stays)).dropDuplicates([of, key])
    return as_they_were(alone.unionByName(repeated), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op6: rows whose text holds no benchmark item stay."""
    shrink_heaps(spark)
    (key,) = unused(docs, "held_key")
    held = cut(decontamination.contaminated_texts(docs, table(spark, sf_dir, "benchmark")).select(F.col("key").alias(key)).distinct())
    return docs.join(small_side(held, held.count(), decontamination.BROADCAST_ROWS), decontamination.text_key() == F.col(key), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op2: the pieces of every row's tokens."""
    shrink_heaps(spark)
    return packing.packed(docs, memo=MEMO)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL has neither the classifiers' models nor the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written to the shared folder and read again; only the last one's table is kept."""
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{spark.sparkContext.applicationId}-{spark._jvm.java.util.UUID.randomUUID().toString()}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before:
            delete(spark, before)
        before = f"{base}/{name}"
    return docs
