import pytest

from skein.functions.types import interval_text
from skein.sources.header import LogError
from skein.sql import log_view, sql
from tests.conftest import rows


@pytest.fixture
def path(log):
    return log("it's.log", ["id.orig_h", "n", "note"], ["addr", "count", "string"], ["10.0.0.1\t1\tread_log('x')", "10.1.0.1\t2\t-"]).replace("'", "''")


def test_calls_named_arguments_and_literals(spark, path):
    q = f"SELECT n, note FROM read_log('{path}', inet=false, filename => true) WHERE note = 'read_log(''x'')' -- read_log(\n"
    assert [(int(a), b) for a, b in rows(sql(spark, q))] == [(1, "read_log('x')")]
    assert rows(sql(spark, f"SELECT typeof(id_orig_h) FROM read_anything('{path}', INET := FALSE) LIMIT 1")) == [("string",)]
    assert rows(sql(spark, f"SELECT count(*) FROM read_log('{path}') a, read_log('{path}') b")) == [(4,)]


def test_inet_operators(spark, path):
    assert [int(r[0]) for r in sql(spark, f"SELECT n FROM read_log('{path}') WHERE id_orig_h <<= '10.1.0.0/16'::inet").collect()] == [2]
    assert [int(r[0]) for r in sql(spark, f"SELECT n FROM read_log('{path}') t WHERE t.id_orig_h = '10.0.0.1'::INET").collect()] == [1]


def test_describe(spark, path):
    assert rows(sql(spark, f"SELECT column_name FROM (DESCRIBE SELECT * FROM read_log('{path}', filename=true)) ORDER BY 1")) == [("filename",), ("id_orig_h",), ("n",), ("note",)]


def test_quoted_names(spark, path):
    assert rows(sql(spark, f'SELECT "id.orig_h" FROM read_log(\'{path}\', replace_periods=false, inet=false) LIMIT 1')) == [("10.0.0.1",)]


@pytest.mark.parametrize("args", ["nonsense=true", "inet=1", "'second'"])
def test_unknown_parameters(spark, path, args):
    with pytest.raises(LogError, match="unknown parameter"):
        sql(spark, f"SELECT * FROM read_log('{path}', {args})")


def test_views_for_plain_sql(spark, path):
    before = {t.name for t in spark.catalog.listTables()}
    log_view(spark, "hosts", path.replace("''", "'"), filename=True)
    assert [int(r[0]) for r in spark.sql("SELECT n FROM hosts WHERE inet_contained_by(id_orig_h, to_inet('10.1.0.0/16'))").collect()] == [2]
    assert rows(sql(spark, f"SELECT count(*) FROM read_log('{path}') a, (DESCRIBE SELECT * FROM hosts) b")) == [(8,)]
    assert {t.name for t in spark.catalog.listTables()} - before == {"hosts"}
    spark.catalog.dropTempView("hosts")


def test_texts_of_intervals(spark):
    given = ["0 00:00:00", "1 00:00:00", "2 03:04:05.5", "0 00:00:00.000001", "0 23:59:59.100", "-1 00:00:00", "-0 00:01:30"]
    want = ["00:00:00", "1 day", "2 days 03:04:05.5", "00:00:00.000001", "23:59:59.1", "-1 day", "-00:01:30"]
    got = [spark.sql(f"SELECT INTERVAL '{g}' DAY TO SECOND AS d").select(interval_text("d")).first()[0] for g in given]
    assert got == want
