"""Registered queries: logs written from the tables, read back and queried, each beside SQL over the table itself."""

from __future__ import annotations

import atexit
import functools
import gzip
import shutil
import tempfile
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import inet
from skein.functions.types import interval_text
from skein.plans.reader import read_log
from skein.sources.header import LogError, LogHeader
from skein.sources.writer import put, write_log, write_zstd
from skein.sql import sql

Query = Callable[[SparkSession, str], DataFrame]

#: name -> (query, SQL over the tables)
REGISTRY: dict[str, tuple[Query, str]] = {}

EVENTS = LogHeader(
    path="events",
    fields=("ts", "id", "id.orig_p", "kind", "value", "dur", "ok", "note", "id.orig_h", "props"),
    types=("time", "count", "port", "enum", "double", "interval", "bool", "string", "addr", "string"),
)

#: SQL text of each field of an events log, over the table.
EVENT_TEXT = {
    "ts": "concat(us DIV 1000000, '.', lpad(us % 1000000, 6, '0'))",
    "id": "string(event_id)",
    "id.orig_p": "string(65000 + event_id % 1000)",
    "kind": "event_type",
    "value": "string(value)",
    "dur": "string(value)",
    "ok": "element_at(array('T', 'F', 'true', 'no'), int(event_id % 4) + 1)",
    "note": "CASE WHEN event_id % 7 = 0 THEN '-' WHEN event_id % 5 = 0 THEN '(empty)' ELSE concat(event_type, '_', event_id) END",
    "id.orig_h": "concat('10.', user_id DIV 65536 % 256, '.', user_id DIV 256 % 256, '.', user_id % 256)",
    "props": "coalesce(nullif(props, ''), '-')",
}


@functools.lru_cache(maxsize=1)
def scratch(shared: str) -> str:
    """A folder for this process's logs: in the session's shared folder, or a temporary one where there is none."""
    if not shared:
        made = tempfile.mkdtemp(prefix="skein-logs-")
        atexit.register(shutil.rmtree, made, True)
        return made
    return f"{shared.rstrip('/')}/logs-{uuid.uuid4().hex}"


def folder(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark.conf.get('spark.checkpoint.dir', None) or '')}/{name}-{uuid.uuid4().hex[:8]}"


def plain(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)


def event_rows(spark: SparkSession, sf_dir: str, where: str = "true", **changed: str) -> DataFrame:
    text = EVENT_TEXT | changed
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter(where)
    events = events.withColumn("us", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"))
    return events.select(*[F.expr(text[f]).alias(f"c{i}") for i, f in enumerate(EVENTS.fields)])


_written: dict[tuple, str] = {}


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a log, written once a process and table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        at = folder(spark, "events")
        write_log(event_rows(spark, sf_dir), at, EVENTS)
        _written[key] = at
    return read_log(spark, f"{_written[key]}/part-*")


def registered(name: str, oracle: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        REGISTRY[name] = (f, oracle)
        return f

    return add


def over_events(name: str, text: str, oracle: str) -> None:
    """A query that is SQL text over the view `log`."""

    @registered(name, oracle)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sql(spark, text, log=events_log(spark, sf_dir))


US = "epoch_us(ts)"
PORT = "CASE WHEN 65000 + event_id % 1000 <= 65535 THEN 65000 + event_id % 1000 END"
NOTE = "CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN NULL ELSE event_type || '_' || event_id END"
OK = "event_id % 4 IN (0, 2)"
HOST = "'10.' || user_id // 65536 % 256 || '.' || user_id // 256 % 256 || '.' || user_id % 256"
LOG = f"(SELECT {US} AS us, event_id AS id, coalesce(CAST({PORT} AS INTEGER), -1) AS id_orig_p, event_type AS kind, value, CAST(trunc(value * 1000000) AS BIGINT) AS dur_us, {OK} AS ok, {NOTE} AS note, {HOST} AS host, nullif(props, '') AS props FROM events) log"
COLUMNS = "unix_micros(ts) AS us, CAST(id AS BIGINT) AS id, coalesce(id_orig_p, -1) AS id_orig_p, kind, value, CAST(extract(DAY FROM dur) * 86400000000 + extract(HOUR FROM dur) * 3600000000 + extract(MINUTE FROM dur) * 60000000 + extract(SECOND FROM dur) * 1000000 AS BIGINT) AS dur_us, ok, note, inet_text(id_orig_h) AS host, props"

over_events("scan_all_types", f"SELECT {COLUMNS} FROM log", f"SELECT * FROM {LOG}")
over_events("count_star", "SELECT count(*) AS n FROM log", "SELECT count(*) AS n FROM events")
over_events("projection", "SELECT kind, value FROM log", f"SELECT kind, value FROM {LOG}")
over_events("filter_eq_string", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE kind = 'click'", f"SELECT id FROM {LOG} WHERE kind = 'click'")
over_events("filter_neq", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE kind <> 'click'", f"SELECT id FROM {LOG} WHERE kind <> 'click'")
over_events("filter_range_port", "SELECT CAST(id AS BIGINT) AS id, id_orig_p FROM log WHERE id_orig_p > 65500 AND id_orig_p <= 65530", f"SELECT id, id_orig_p FROM {LOG} WHERE id_orig_p > 65500 AND id_orig_p <= 65530")
over_events("filter_time", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE ts >= '2024-01-10 00:00:00+00'::timestamptz", "SELECT event_id AS id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'")
over_events("filter_interval", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE dur > INTERVAL '30' SECOND", f"SELECT id FROM {LOG} WHERE dur_us > 30000000")
over_events("filter_bool", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE ok", f"SELECT id FROM {LOG} WHERE ok")
over_events("filter_double", "SELECT CAST(id AS BIGINT) AS id, value FROM log WHERE value >= 15.5 AND value < 40", f"SELECT id, value FROM {LOG} WHERE value >= 15.5 AND value < 40")
over_events("filter_count", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE id <= 100", f"SELECT id FROM {LOG} WHERE id <= 100")
over_events("filter_in_string", "SELECT CAST(id AS BIGINT) AS id, kind FROM log WHERE kind IN ('click', 'error', NULL)", f"SELECT id, kind FROM {LOG} WHERE kind IN ('click', 'error')")
over_events("filter_in_port", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE id_orig_p IN (65001, 65535, 65536)", f"SELECT id FROM {LOG} WHERE id_orig_p IN (65001, 65535, 65536)")
over_events("filter_and", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE kind = 'view' AND value > 50 AND ok", f"SELECT id FROM {LOG} WHERE kind = 'view' AND value > 50 AND ok")
over_events("filter_or", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE kind = 'view' OR kind = 'error'", f"SELECT id FROM {LOG} WHERE kind = 'view' OR kind = 'error'")
over_events("filter_is_null", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE note IS NULL", f"SELECT id FROM {LOG} WHERE note IS NULL")
over_events("filter_is_not_null", "SELECT CAST(id AS BIGINT) AS id, note FROM log WHERE note IS NOT NULL", f"SELECT id, note FROM {LOG} WHERE note IS NOT NULL")
over_events("empty_marker_null", "SELECT count(*) AS n, count(note) AS noted FROM log", f"SELECT count(*) AS n, count(note) AS noted FROM {LOG}")
over_events("bool_parse", "SELECT ok, count(*) AS n FROM log GROUP BY ok", f"SELECT ok, count(*) AS n FROM {LOG} GROUP BY ok")
over_events("port_overflow_null", "SELECT CAST(id AS BIGINT) AS id, coalesce(id_orig_p, -1) AS id_orig_p FROM log", f"SELECT id, id_orig_p FROM {LOG}")
over_events("interval_micros", "SELECT CAST(id AS BIGINT) AS id, CAST(extract(DAY FROM dur) * 86400000000 + extract(HOUR FROM dur) * 3600000000 + extract(MINUTE FROM dur) * 60000000 + extract(SECOND FROM dur) * 1000000 AS BIGINT) AS us FROM log", f"SELECT id, dur_us AS us FROM {LOG}")
over_events("group_sum_order", "SELECT kind, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, min(value) AS low, max(value) AS high FROM log GROUP BY kind ORDER BY n DESC, kind", f"SELECT kind, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, min(value) AS low, max(value) AS high FROM {LOG} GROUP BY kind")
over_events("distinct_count", "SELECT count(DISTINCT kind) AS kinds, count(DISTINCT inet_text(id_orig_h)) AS hosts FROM log", f"SELECT count(DISTINCT kind) AS kinds, count(DISTINCT host) AS hosts FROM {LOG}")
over_events("like_prefix", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE note LIKE 'c%'", f"SELECT id FROM {LOG} WHERE note LIKE 'c%'")
over_events("top_n", "SELECT CAST(id AS BIGINT) AS id, value FROM log ORDER BY value DESC, id LIMIT 25", f"SELECT id, value FROM {LOG} ORDER BY value DESC, id LIMIT 25")
over_events("cross_join", "SELECT count(*) AS n FROM (SELECT DISTINCT kind FROM log) a, (SELECT DISTINCT ok FROM log) b", f"SELECT count(*) AS n FROM (SELECT DISTINCT kind FROM {LOG}) a, (SELECT DISTINCT ok FROM {LOG}) b")
over_events("subquery", "SELECT max(n) AS most FROM (SELECT kind, count(*) AS n FROM log GROUP BY kind)", f"SELECT max(n) AS most FROM (SELECT kind, count(*) AS n FROM {LOG} GROUP BY kind)")
over_events("is_null_expression", "SELECT note IS NULL AS missing, count(*) AS n FROM log GROUP BY 1", f"SELECT note IS NULL AS missing, count(*) AS n FROM {LOG} GROUP BY 1")
over_events("inet_eq", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE id_orig_h = '10.0.0.7'::inet", f"SELECT id FROM {LOG} WHERE host = '10.0.0.7'")
over_events("inet_contained_by", "SELECT CAST(id AS BIGINT) AS id FROM log WHERE id_orig_h <<= '10.0.0.8/29'::inet", "SELECT event_id AS id FROM events WHERE user_id % 65536 BETWEEN 8 AND 15 AND user_id // 65536 % 256 = 0")
over_events("inet_group", "SELECT inet_text(id_orig_h) AS host, count(*) AS n FROM log GROUP BY id_orig_h", f"SELECT host, count(*) AS n FROM {LOG} GROUP BY host")
over_events("describe", "SELECT column_name AS name FROM (DESCRIBE SELECT * FROM log)", "SELECT unnest(['ts', 'id', 'id_orig_p', 'kind', 'value', 'dur', 'ok', 'note', 'id_orig_h', 'props']) AS name")
over_events("typeof", "SELECT DISTINCT typeof(ts) AS t, typeof(id) AS c, typeof(dur) AS d, typeof(id_orig_p) AS p, typeof(ok) AS b FROM log", "SELECT 'timestamp' AS t, 'decimal(20,0)' AS c, 'interval day to second' AS d, 'int' AS p, 'boolean' AS b")
over_events("window_rank", "SELECT CAST(id AS BIGINT) AS id, row_number() OVER (PARTITION BY kind ORDER BY value DESC, id) AS place FROM log", f"SELECT id, row_number() OVER (PARTITION BY kind ORDER BY value DESC, id) AS place FROM {LOG}")
over_events("rollup", "SELECT kind, ok, count(*) AS n FROM log GROUP BY ROLLUP (kind, ok)", f"SELECT kind, ok, count(*) AS n FROM {LOG} GROUP BY ROLLUP (kind, ok)")


@registered("short_rows_null", "SELECT event_id AS id, CASE WHEN event_id % 3 <> 0 THEN nullif(props, '') END AS props FROM events")
def short_rows_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_rows(spark, sf_dir).withColumn("c9", F.expr("CASE WHEN bigint(c1) % 3 <> 0 THEN c9 END"))  # concat_ws leaves nulls out
    at = folder(spark, "short")
    write_log(rows, at, EVENTS)
    return read_log(spark, f"{at}/part-*").select(F.col("id").cast("bigint").alias("id"), "props")


@registered("count_u64", "SELECT event_id AS id, CAST(18446744073709551615 - event_id AS VARCHAR) AS big FROM events")
def count_u64(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.expr("string(event_id)").alias("a"), F.expr("string(18446744073709551615BD - event_id)").alias("b"))
    at = folder(spark, "u64")
    write_log(rows, at, LogHeader(fields=("id", "big"), types=("int", "count")))
    return read_log(spark, f"{at}/part-*").select("id", F.col("big").cast("string").alias("big"))


@registered("lenient_int", "SELECT event_id AS id, TRY_CAST(event_id || '.5' AS BIGINT) AS half, TRY_CAST(event_id || 'e1' AS BIGINT) AS ten, TRY_CAST('x' || event_id AS BIGINT) AS bad FROM events")
def lenient_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(*[F.expr(f"concat({x})").alias(f"c{i}") for i, x in enumerate(("event_id", "event_id, '.5'", "event_id, 'e1'", "'x', event_id"))])
    at = folder(spark, "lenient")
    write_log(rows, at, LogHeader(fields=("id", "half", "ten", "bad"), types=("int",) * 4))
    return read_log(spark, f"{at}/part-*")


@registered("list_double", "SELECT vec_id AS id, CAST(i - 1 AS INTEGER) AS at, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def list_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("string(vec_id) AS a", "array_join(transform(embedding, x -> string(double(x))), ',') AS b")
    at = folder(spark, "lists")
    write_log(rows, at, LogHeader(fields=("id", "v"), types=("int", "vector[double]")))
    return read_log(spark, f"{at}/part-*").select("id", F.posexplode("v").alias("at", "x"))


NATIONS = "SELECT n_regionkey AS region, string_agg(n_name, '|' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey"


def nations(spark: SparkSession, sf_dir: str, value: str, kind: str = "set[string]", **lexical: str) -> DataFrame:
    tables(spark, sf_dir, "nation")
    rows = spark.sql(f"SELECT string(n_regionkey) AS a, {value} AS b FROM nation GROUP BY n_regionkey")
    at = folder(spark, "nations")
    write_log(rows, at, LogHeader(fields=("region", "names"), types=("int", kind), **lexical))
    return read_log(spark, f"{at}/part-*")


@registered("list_string_set", f"SELECT CAST(region AS BIGINT) AS region, names FROM ({NATIONS})")
def list_string_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir, "array_join(sort_array(collect_list(n_name)), ',')").select("region", F.array_join("names", "|").alias("names"))


@registered("list_null_elements", "SELECT CAST(n_regionkey AS BIGINT) AS region, count(*) AS n, count(*) FILTER (n_nationkey % 2 = 0) AS known FROM nation GROUP BY n_regionkey")
def list_null_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = nations(spark, sf_dir, "array_join(collect_list(CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '-' END), ',')", "vector[string]")
    return got.select("region", F.size("names").cast("bigint").alias("n"), F.size(F.filter("names", lambda x: x.isNotNull())).cast("bigint").alias("known"))


@registered("list_empty_is_null", "SELECT CAST(r_regionkey AS BIGINT) AS region, r_regionkey % 2 = 0 AS missing FROM region")
def list_empty_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = nations(spark, sf_dir, "CASE WHEN n_regionkey % 2 = 0 THEN '(empty)' ELSE max(n_name) END")
    return got.select("region", F.col("names").isNull().alias("missing"))


@registered("list_interval", "SELECT event_id AS id, CAST(trunc(value * 1000000) AS BIGINT) AS us, CAST(1500000 AS BIGINT) AS other, CAST(2 AS INTEGER) AS n FROM events")
def list_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("string(event_id) AS a", "concat(value, ',', '1.5') AS b")
    at = folder(spark, "intervals")
    write_log(rows, at, LogHeader(fields=("id", "v"), types=("int", "vector[interval]")))
    us = "CAST(extract(MINUTE FROM v[{0}]) * 60000000 + extract(SECOND FROM v[{0}]) * 1000000 AS BIGINT) AS {1}"
    return read_log(spark, f"{at}/part-*").selectExpr("id", us.format(0, "us"), us.format(1, "other"), "size(v) AS n")


@registered("list_rendering", f"SELECT CAST(region AS BIGINT) AS region, '[' || replace(names, '|', ', ') || ']' AS names FROM ({NATIONS})")
def list_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = nations(spark, sf_dir, "array_join(sort_array(collect_list(n_name)), ',')")
    return got.select("region", F.col("names").cast("string").alias("names"))


LONG_US = "CAST(trunc(value * 1000 * 1000000) AS BIGINT)"


@registered("interval_rendering", f"SELECT event_id AS id, CAST(to_days(CAST({LONG_US} // 86400000000 AS INTEGER)) + to_microseconds({LONG_US} % 86400000000) AS VARCHAR) AS dur FROM events")
def interval_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("string(event_id) AS a", "string(value * 1000) AS b")
    at = folder(spark, "durations")
    write_log(rows, at, LogHeader(fields=("id", "dur"), types=("int", "interval")))
    return read_log(spark, f"{at}/part-*").select("id", interval_text("dur").alias("dur"))


def people_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as a second log, with the address that a user of their number has in the events."""
    host = EVENT_TEXT["id.orig_h"].replace("user_id", "c_custkey")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("string(c_custkey) AS a", f"{host} AS b", "string(c_nationkey) AS c")
    at = folder(spark, "people")
    write_log(rows, at, LogHeader(fields=("number", "addr", "nation"), types=("int", "addr", "count")))
    return read_log(spark, f"{at}/part-*")


PEOPLE = f"(SELECT c_nationkey AS nation, {'c_custkey'.join(HOST.split('user_id'))} AS addr FROM customer) people"


def over_two_logs(name: str, text: str, oracle: str) -> None:
    """A query that is SQL text over the views `log` and `people`."""

    @registered(name, oracle)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sql(spark, text, log=events_log(spark, sf_dir), people=people_log(spark, sf_dir))


over_two_logs("join_inner", "SELECT CAST(nation AS BIGINT) AS nation, kind, count(*) AS n FROM log JOIN people ON id_orig_h = addr GROUP BY 1, 2", f"SELECT CAST(nation AS BIGINT) AS nation, kind, count(*) AS n FROM {LOG} JOIN {PEOPLE} ON host = addr GROUP BY 1, 2")
over_two_logs("join_left", "SELECT CAST(id AS BIGINT) AS id, CAST(nation AS BIGINT) AS nation FROM log LEFT JOIN people ON id_orig_h = addr", f"SELECT id, CAST(nation AS BIGINT) AS nation FROM {LOG} LEFT JOIN {PEOPLE} ON host = addr")
over_two_logs("join_semi", "SELECT CAST(id AS BIGINT) AS id FROM log LEFT SEMI JOIN people ON id_orig_h = addr AND nation < 5", f"SELECT id FROM {LOG} SEMI JOIN (SELECT * FROM {PEOPLE} WHERE nation < 5) p ON host = p.addr")
over_two_logs("join_anti", "SELECT CAST(id AS BIGINT) AS id FROM log LEFT ANTI JOIN people ON id_orig_h = addr AND nation < 5", f"SELECT id FROM {LOG} ANTI JOIN (SELECT * FROM {PEOPLE} WHERE nation < 5) p ON host = p.addr")
over_events("join_range", "SELECT band, count(*) AS n FROM log JOIN (VALUES (1, 0, 20), (2, 20, 100), (3, 90, 500)) AS b(band, low, high) ON value >= low AND value < high GROUP BY band", f"SELECT band, count(*) AS n FROM {LOG} JOIN (VALUES (1, 0, 20), (2, 20, 100), (3, 90, 500)) AS b(band, low, high) ON value >= low AND value < high GROUP BY band")
over_two_logs("intersect", "SELECT inet_text(id_orig_h) AS host FROM log WHERE value > 100 INTERSECT SELECT inet_text(addr) FROM people WHERE nation >= 10", f"SELECT host FROM {LOG} WHERE value > 100 INTERSECT SELECT addr FROM {PEOPLE} WHERE nation >= 10")
over_two_logs("except", "SELECT inet_text(addr) AS host FROM people EXCEPT SELECT inet_text(id_orig_h) FROM log", f"SELECT addr AS host FROM {PEOPLE} EXCEPT SELECT host FROM {LOG}")
over_events("cube", "SELECT kind, ok, count(*) AS n, max(value) AS high FROM log GROUP BY CUBE (kind, ok)", f"SELECT kind, ok, count(*) AS n, max(value) AS high FROM {LOG} GROUP BY CUBE (kind, ok)")
over_events("grouping_sets", "SELECT kind, ok, count(*) AS n FROM log GROUP BY GROUPING SETS ((kind), (ok), ())", f"SELECT kind, ok, count(*) AS n FROM {LOG} GROUP BY GROUPING SETS ((kind), (ok), ())")


#: What is asked of a folder with a good log, one that lacks #types, one of another layout and a false .gz, and the message's beginning.
FAULTS = [
    ("no file", "none*", {}, "No files found matching pattern"),
    ("no header", "headless.log", {}, "missing #types"),
    ("not gzip", "*.gz", {}, "Input is not a GZIP stream"),
    ("nothing left", "*.gz", {"ignore_file_errors": True}, "No valid log files found in pattern"),
    ("other layout", "layout-*.log", {}, "has a different schema than"),
    ("other type", "layout-*.log", {"union_by_name": True}, "field 'n' has type"),
]


@registered("faults", " UNION ALL ".join(f"SELECT '{case}' AS fault, TRUE AS refused" for case, *_ in FAULTS))
def faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each fault is refused with the message that says so."""
    at = folder(spark, "faults")
    for name, head, row in (("layout-a.log", "#fields\tn\n#types\tint\n", "1\n"), ("layout-b.log", "#fields\tn\n#types\tstring\n", "x\n"), ("headless.log", "#fields\tn\n", "1\n"), ("false.log.gz", "", "text\n")):
        put(at, name, f"{head}{row}".encode())
    out = []
    for case, pattern, options, message in FAULTS:
        try:
            read_log(spark, f"{at}/{pattern}", **options)
            out.append((case, False))
        except LogError as e:
            out.append((case, message in str(e)))
    return spark.createDataFrame(out, "fault string, refused boolean")


def four_files(spark: SparkSession, sf_dir: str) -> str:
    at = folder(spark, "four")
    for k in range(4):
        write_log(event_rows(spark, sf_dir, f"event_id % 4 = {k}").coalesce(1), f"{at}/f{k}", EVENTS)
    return at


@registered("glob_multi_file", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def glob_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_log(spark, f"{four_files(spark, sf_dir)}/f*/part-*").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@registered("filename_distinct", "SELECT 'f' || event_id % 4 AS file, count(*) AS n FROM events GROUP BY 1")
def filename_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = read_log(spark, f"{four_files(spark, sf_dir)}/f*/part-*", filename=True)
    return got.groupBy(F.regexp_extract("filename", "/(f[0-9])/", 1).alias("file")).agg(F.count("*").alias("n"))


@registered("filename_filter", "SELECT event_id AS id FROM events WHERE event_id % 4 = 2")
def filename_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = read_log(spark, f"{four_files(spark, sf_dir)}/**/part-*.txt", filename=True)
    return got.filter(F.col("filename").contains("/f2/")).select(F.col("id").cast("bigint").alias("id"))


@registered("gzip_read", f"SELECT us, id, kind, value FROM {LOG}")
def gzip_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = folder(spark, "gzip")
    write_log(event_rows(spark, sf_dir), at, EVENTS, compression="gzip")
    return read_log(spark, f"{at}/part-*.gz").selectExpr("unix_micros(ts) AS us", "CAST(id AS BIGINT) AS id", "kind", "value")


@registered("zstd_read", f"SELECT us, id, kind, value FROM {LOG}")
def zstd_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = folder(spark, "zstd")
    write_zstd(event_rows(spark, sf_dir), at, EVENTS)
    return read_log(spark, f"{at}/part-*.zst").selectExpr("unix_micros(ts) AS us", "CAST(id AS BIGINT) AS id", "kind", "value")


@registered("crlf_and_comments", f"SELECT id, note, props FROM {LOG}")
def crlf_and_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = folder(spark, "crlf")
    rows = event_rows(spark, sf_dir).withColumn("c9", F.expr("CASE WHEN bigint(c1) % 9 = 0 THEN concat(c9, '\r\n\r\n#a comment\t1') ELSE c9 END"))
    write_log(rows, at, EVENTS, line_end="\r")
    return read_log(spark, f"{at}/part-*").selectExpr("CAST(id AS BIGINT) AS id", "note", "props")


@registered("dotted_names", f"SELECT id_orig_p FROM {LOG}")
def dotted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_log(spark, sf_dir).selectExpr("coalesce(id_orig_p, -1) AS id_orig_p")


@registered("dotted_names_kept", f'SELECT id_orig_p AS "id.orig_p" FROM {LOG}')
def dotted_names_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_log(spark, sf_dir)
    at = _written[(spark.sparkContext.applicationId, sf_dir)]
    return read_log(spark, f"{at}/part-*", replace_periods=False).selectExpr("coalesce(`id.orig_p`, -1) AS `id.orig_p`")


@registered("inet_as_text", f"SELECT host FROM {LOG}")
def inet_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_log(spark, sf_dir)
    at = _written[(spark.sparkContext.applicationId, sf_dir)]
    return read_log(spark, f"{at}/part-*", inet=False).select(F.col("id_orig_h").alias("host"))


@registered("custom_separators", f"SELECT CAST(region AS BIGINT) AS region, names FROM ({NATIONS})")
def custom_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = nations(spark, sf_dir, "array_join(sort_array(collect_list(n_name)), '|')", separator=";", set_separator="|", empty="~", unset="?")
    return got.select("region", F.array_join("names", "|").alias("names"))


UNITED = "(SELECT event_id AS id, event_type AS kind, CASE WHEN event_id % 2 = 1 THEN nullif(props, '') END AS props FROM events)"


def halves(spark: SparkSession, sf_dir: str) -> str:
    at = folder(spark, "halves")
    short = LogHeader(fields=EVENTS.fields[:9], types=EVENTS.types[:9])
    write_log(event_rows(spark, sf_dir, "event_id % 2 = 0").drop("c9"), f"{at}/old", short)
    write_log(event_rows(spark, sf_dir, "event_id % 2 = 1"), f"{at}/new", EVENTS)
    return at


@registered("union_by_name", f"SELECT * FROM {UNITED}")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = read_log(spark, f"{halves(spark, sf_dir)}/*/part-*", union_by_name=True)
    return got.select(F.col("id").cast("bigint").alias("id"), "kind", "props")


@registered("union_filter_missing", f"SELECT id FROM {UNITED} WHERE props IS NULL")
def union_filter_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = read_log(spark, f"{halves(spark, sf_dir)}/*/part-*", union_by_name=True)
    return got.filter("props IS NULL").select(F.col("id").cast("bigint").alias("id"))


@registered("ignore_file_errors", "SELECT count(*) AS n FROM events")
def ignore_file_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = folder(spark, "faulty")
    write_log(event_rows(spark, sf_dir), at, EVENTS, compression="gzip")
    with open(f"{plain(at)}/part-fake.log.gz", "w") as f:
        f.write("not compressed\n")
    with gzip.open(f"{plain(at)}/part-headless.log.gz", "wt") as f:
        f.write("1\t2\n")
    return read_log(spark, f"{at}/part-*.gz", ignore_file_errors=True).agg(F.count("*").alias("n"))


@registered("ignore_strict_mismatch", "SELECT event_id AS id FROM events WHERE event_id % 2 = 1")
def ignore_strict_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = read_log(spark, f"{halves(spark, sf_dir)}/*/part-*", ignore_file_errors=True)
    return got.select(F.col("id").cast("bigint").alias("id"))


@registered("sql_surface", f"SELECT kind, count(*) AS n, max(value) AS high FROM {LOG} WHERE note IS NOT NULL GROUP BY kind")
def sql_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_log(spark, sf_dir)
    at = _written[(spark.sparkContext.applicationId, sf_dir)]
    return sql(spark, f"SELECT kind, count(*) AS n, max(value) AS high FROM read_log('{at}/part-*', filename = true, inet = false) WHERE note IS NOT NULL GROUP BY kind")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, values and hosts of a network by event type, from a log."""
    inet.register(spark)
    return sql(spark, "SELECT kind, count(*) AS n, max(value) AS high FROM log WHERE value > 15 AND id_orig_h <<= '10.0.0.0/8'::inet GROUP BY kind ORDER BY kind", log=events_log(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in REGISTRY.items()}
