"""Connected components of an edge table by randomised contraction, each round written to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import cut, delete, shared_dir


class Rounds:
    """Tables of an iteration, written to a folder of their own in the shared one and deleted when they are done with."""

    def __init__(self, spark, kind: str):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame) -> tuple[str, DataFrame]:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        return path, self.spark.read.schema(df.schema).parquet(path)

    def delete(self, path: str | None = None) -> None:
        delete(self.spark, path or self.root)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of `edges` (a, b): label is one node of its component, the same for all of it.

    In a round every node names the first of itself and its neighbours, in an order that is drawn anew (by a hash of node
    and round, so a repeated task draws the same); the named ones are the next round's nodes, with the edges that are
    left between them. Of the nodes that still have edges a constant share goes in each round, whatever the graph's
    shape, so a chain of n takes O(log n) rounds. At the end the names are followed from the last round back to the first.

    Tables shrink by round, and those of earlier edges are deleted. Rows of a hub are dealt for joins alone, which can
    be split; what is aggregated is combined before it is sent. An empty table has no nodes; an edge from a node to
    itself gives a component of one.
    """
    spark = edges.sparkSession
    rounds = Rounds(spark, "components")
    rows = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    path, both = rounds.write(rows.unionByName(rows.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    named: list[DataFrame] = []
    while not both.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(named))).alias("place"), F.col(c).alias("node"))
        first = both.groupBy("a").agg(F.min(order("b")).alias("first")).select(F.col("a").alias("node"), F.least(order("a"), "first").getField("node").alias("name"))
        _, first = rounds.write(first)
        named.append(first)
        to = lambda c: first.select(F.col("node").alias(c), F.col("name").alias(f"{c}_name"))
        left = both.join(to("a"), "a").join(to("b"), "b").select(F.col("a_name").alias("a"), F.col("b_name").alias("b"))
        was = path
        path, both = rounds.write(left.filter("a <> b").distinct())
        rounds.delete(was)
    if not named:
        rounds.delete()
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).filter("false")
    labels = named.pop().withColumnRenamed("name", "label")
    while named:
        upper = labels.select(F.col("node").alias("name"), F.col("label").alias("upper"))
        met = named.pop().join(upper, "name", "left")
        _, labels = rounds.write(met.select("node", F.coalesce("upper", "name").alias("label")))
    labels = cut(labels)
    rounds.delete()
    return labels
