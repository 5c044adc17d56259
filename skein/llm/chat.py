"""Preference formatting of conversations.

A pair of conversations, chosen and rejected, is split at the longest common prefix of their turns (equal role and
text). The prefix is rendered once, as the prompt; what follows is rendered as the two completions, each with a mask:
an array of (chars, train) runs over its text, where only the content of assistant turns is trained on.

A turn is rendered as its role's header line, its text and a line break. Turns are ordered by number, role and text,
so repeated or unnumbered turns have a place (nulls first); a null role is `unknown`, a null text is empty, a text of any
length is rendered whole, rows of a null conversation id are one conversation. A conversation is one row of the result,
so it must fit in memory; nothing else is gathered. A pair without a second conversation has null for it and no common turns. An empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, table

MASK = "array<struct<chars:int,train:boolean>>"


def turns_of(df: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, t) of every row, t a turn: (turn, role, text)."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).alias("conv_id"), F.struct(F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of turns_of()'s rows."""
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn.role, F.lit("|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), t.text, F.lit("\n"))), "")


def mask(turns: Column) -> Column:
    runs = F.transform(turns, lambda t: F.array(F.struct(F.char_length(header(t)).alias("chars"), F.lit(False).alias("train")), F.struct((F.char_length(t.text) + 1).alias("chars"), (t.role == "assistant").alias("train"))))
    return F.flatten(runs)


def preferences(pairs: DataFrame) -> DataFrame:
    """Of rows (pair_id, chosen_id, chosen, rejected_id, rejected), the latter turns or null: the formatted pairs."""
    least = F.least(F.size("chosen"), F.size("rejected"))
    steps = F.when(least > 0, F.sequence(F.lit(1), least)).otherwise(F.array().cast("array<int>"))
    differs = F.filter(steps, lambda i: (F.element_at("chosen", i).role != F.element_at("rejected", i).role) | (F.element_at("chosen", i).text != F.element_at("rejected", i).text))
    common = F.when(F.col("rejected").isNull(), F.lit(0)).otherwise(F.coalesce(F.array_min(differs) - 1, least))
    split = pairs.withColumn("n_common", common)
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    return split.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        "n_common",
        rendered(F.slice("chosen", 1, F.col("n_common"))).alias("prompt"),
        rendered(rest("chosen")).alias("chosen"),
        mask(rest("chosen")).alias("chosen_mask"),
        rendered(rest("rejected")).alias("rejected"),
        mask(rest("rejected")).alias("rejected_mask"),
    )


def running(rows: DataFrame, value: Column, *order: str) -> Column:
    """Of rows with `part`, numbered in the given order: the sum of `value` over the rows before, as a column for `rows`."""
    sizes = rows.groupBy("part").agg(F.sum(value).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))  # a row for each range
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(F.broadcast(sizes), "part").withColumn("before", F.col("base") + F.col("at")).drop("base", "at")


def placed(keys: DataFrame) -> DataFrame:
    """conv_id, pair_id and side of `keys` (conv_id, opening): pairs within an opening first, the odd ones left over among themselves.

    Only an opening that is the first or last of its range can go on in another; these few are added up over the ranges.
    """
    order = ("opening", "conv_id")
    rows = cut(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    rows = running(rows, F.lit(1), *order).withColumnRenamed("before", "rank")
    own = Window.partitionBy("part", "opening")
    rows = cut(rows.withColumns({"first": F.min("rank").over(own), "n": F.count("*").over(own)}))
    ends = rows.groupBy("part").agg(F.array(F.min("opening"), F.max("opening")).alias("ends")).select(F.explode("ends").alias("opening")).distinct()
    whole = rows.join(F.broadcast(ends), "opening").groupBy("opening").agg(F.min("rank").alias("all_first"), F.count("*").alias("all_n"))
    rows = rows.join(F.broadcast(whole), "opening", "left")
    rows = rows.withColumns({"first": F.coalesce("all_first", "first"), "n": F.coalesce("all_n", "n")})
    at = F.col("rank") - F.col("first")
    rows = cut(rows.select("part", "opening", "conv_id", "rank", at.alias("at_opening"), ((F.col("n") % 2 == 1) & (at == F.col("n") - 1)).cast("int").alias("odd")))
    left = rows.agg(F.coalesce(F.sum("odd"), F.lit(0))).first()[0]
    rows = running(rows, F.col("odd"), *order)
    met = F.lit((left + 1) // 2) + F.floor((F.col("rank") - F.col("before")) / 2)
    pair = F.when(F.col("odd") == 1, F.floor(F.col("before") / 2)).otherwise(met)
    return rows.select("conv_id", pair.alias("pair_id"), F.when(F.col("odd") == 1, F.col("before") % 2).otherwise(F.col("at_opening") % 2).alias("side"))


def pair_up(turns: DataFrame) -> DataFrame:
    """Pairs of conversations that open alike, in the order of their ids; an odd one left over of each opening is paired
    with the next such one in the order of the openings' digests.

    However many open alike, an order has no groups, so nothing is gathered for one opening. The order needs opening
    turns only; all turns are dealt twice, for their conversation's place and for their pair.
    """
    first = turns.groupBy("conv_id").agg(F.min("t").alias("t"))
    keys = first.select("conv_id", F.md5(F.concat(header(F.col("t")), F.col("t").text).cast("binary")).alias("opening"))
    places = cut(placed(keys).withColumnRenamed("conv_id", "id"))
    met = turns.join(places, F.col("conv_id").eqNullSafe(F.col("id")))
    of = lambda n, c: F.when(F.col("side") == n, F.col(c))
    pairs = met.groupBy("pair_id").agg(
        F.max(of(0, "conv_id")).alias("chosen_id"),
        F.sort_array(F.collect_list(of(0, "t"))).alias("chosen"),
        F.max(of(1, "conv_id")).alias("rejected_id"),
        F.sort_array(F.collect_list(of(1, "t"))).alias("rejected"),
    )
    return pairs.withColumn("rejected", F.when(F.size("rejected") > 0, F.col("rejected")))


def op1_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preferences(pair_up(turns_of(table(spark, sf_dir, "conversations"))))
    runs = lambda c: F.array_join(F.transform(c, lambda r: F.concat(F.when(r.train, F.lit("+")).otherwise(F.lit("-")), r.chars.cast("string"))), "")
    found = found.withColumns({c: runs(F.col(c)) for c in ("chosen_mask", "rejected_mask")})
    return found.withColumn("rejected_id", F.coalesce("rejected_id", F.lit(-1)))


OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS i
  FROM conversations),
shown AS (
  SELECT *, '<|' || role || '|>' || chr(10) AS head FROM turns),
openings AS (
  SELECT conv_id, row_number() OVER (ORDER BY md5(head || text), conv_id NULLS FIRST) - 1 AS place,
         row_number() OVER (PARTITION BY md5(head || text) ORDER BY conv_id NULLS FIRST) - 1 AS at_opening,
         count(*) OVER (PARTITION BY md5(head || text)) AS n
  FROM shown WHERE i = 1),
odd_ones AS (
  SELECT *, CAST(n % 2 = 1 AND at_opening = n - 1 AS BIGINT) AS odd FROM openings),
counted AS (
  SELECT *, CAST(coalesce(sum(odd) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS odd_before,
         CAST(sum(odd) OVER () AS BIGINT) AS odd_all
  FROM odd_ones),
places AS (
  SELECT conv_id, CASE WHEN odd = 1 THEN odd_before // 2 ELSE (odd_all + 1) // 2 + (place - odd_before) // 2 END AS pair_id,
         CASE WHEN odd = 1 THEN odd_before % 2 ELSE at_opening % 2 END AS side
  FROM counted),
sided AS (
  SELECT pair_id, side, s.* FROM shown s JOIN places p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
pairs AS (
  SELECT pair_id, max(CASE WHEN side = 0 THEN conv_id END) AS chosen_id, max(CASE WHEN side = 1 THEN conv_id END) AS rejected_id,
         least(count(*) FILTER (side = 0), count(*) FILTER (side = 1)) AS shorter, count(*) FILTER (side = 1) AS others
  FROM sided GROUP BY pair_id),
differs AS (
  SELECT c.pair_id, min(c.i) AS i FROM sided c JOIN sided r ON c.pair_id = r.pair_id AND c.i = r.i AND c.side = 0 AND r.side = 1
  WHERE c.role <> r.role OR c.text <> r.text GROUP BY c.pair_id),
common AS (
  SELECT p.pair_id, chosen_id, rejected_id, others, CAST(coalesce(d.i - 1, shorter) AS INTEGER) AS n_common
  FROM pairs p LEFT JOIN differs d ON p.pair_id = d.pair_id)
SELECT c.pair_id, chosen_id, coalesce(rejected_id, -1) AS rejected_id, n_common,
       coalesce(string_agg(head || text || chr(10), '' ORDER BY i) FILTER (side = 0 AND i <= n_common), '') AS prompt,
       coalesce(string_agg(head || text || chr(10), '' ORDER BY i) FILTER (side = 0 AND i > n_common), '') AS chosen,
       coalesce(string_agg('-' || length(head) || CASE WHEN role = 'assistant' THEN '+' ELSE '-' END || (length(text) + 1), '' ORDER BY i) FILTER (side = 0 AND i > n_common), '') AS chosen_mask,
       CASE WHEN others > 0 THEN coalesce(string_agg(head || text || chr(10), '' ORDER BY i) FILTER (side = 1 AND i > n_common), '') END AS rejected,
       CASE WHEN others > 0 THEN coalesce(string_agg('-' || length(head) || CASE WHEN role = 'assistant' THEN '+' ELSE '-' END || (length(text) + 1), '' ORDER BY i) FILTER (side = 1 AND i > n_common), '') END AS rejected_mask
FROM common c JOIN sided s ON c.pair_id = s.pair_id
GROUP BY c.pair_id, chosen_id, rejected_id, n_common, others
"""
