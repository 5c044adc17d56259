import gzip
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skein.plans.reader import read_log, respelling
from skein.sources import files
from skein.sources.header import LogError, LogHeader
from skein.sources.writer import write_log
from tests.conftest import rows


def test_scalars(spark, log):
    p = log("a.log", ["t", "i", "d", "c", "n", "b", "p", "s", "e", "u"], ["time", "interval", "double", "count", "int", "bool", "port", "string", "enum", "mystery"], ["1.5\t86400\t2.5\t18446744073709551615\t-3\tT\t65535\tx\tudp\t?"])
    df = read_log(spark, p)
    assert [f.dataType.simpleString() for f in df.schema] == ["timestamp", "interval day to second", "double", "decimal(20,0)", "bigint", "boolean", "int", "string", "string", "string"]
    (r,) = df.selectExpr("unix_micros(t)", "i", "d", "c", "n", "b", "p", "s", "e", "u").collect()
    assert tuple(r) == (1500000, timedelta(days=1), 2.5, Decimal(18446744073709551615), -3, True, 65535, "x", "udp", "?")


def test_unparseable_is_null_and_bool_is_false(spark, log):
    p = log("a.log", list("tidcnbp"), ["time", "interval", "double", "count", "int", "bool", "port"], ["\t".join(["abc"] * 7), "\t".join(["nan"] * 7), "\t".join(["-1"] * 7), "\t".join([""] * 7)])
    got = rows(read_log(spark, p))
    assert got[0] == (None, None, None, None, None, False, None)
    assert got[1][0] is None and got[1][1] is None and got[1][2] != got[1][2]
    assert got[2][3] is None and got[2][4] == -1 and got[2][6] is None
    assert got[3] == (None, None, None, None, None, False, None)


def test_markers_short_long_blank_and_comment_lines(spark, log):
    p = log("a.log", ["a", "b"], ["string", "vector[string]"], ["-\t-", "(empty)\t(empty)", "x", "y\t1,-,(empty),\tmore\tstill", "", "#z\t1", "\t"], last=False)
    assert rows(read_log(spark, p)) == [(None, None), (None, None), ("x", None), ("y", ["1", None, None, ""]), ("", [""])]
    assert read_log(spark, p).count() == 5


def test_line_ends(spark, log):
    p = log("a.log", ["a", "b"], ["string", "int"], ["x\ry\t1", "z\t2"], end="\r\n")
    assert rows(read_log(spark, p)) == [("x\ry", 1), ("z", 2)]


def test_lists_of_each_type(spark, log):
    p = log("a.log", ["a", "b", "c", "d", "e"], ["set[count]", "vector[interval]", "vector[bool]", "vector[", "set[port]"], ["1,x,2,1\t1.5,-\tT,F,x\tp,q\t1,70000"])
    assert rows(read_log(spark, p)) == [([1, None, 2, 1], [timedelta(seconds=1.5), None], [True, False, False], ["p", "q"], [1, None])]


def test_lists_of_lists_are_refused(spark, log):
    with pytest.raises(LogError, match="lists of lists"):
        read_log(spark, log("a.log", ["a"], ["vector[set[int]]"], ["1"]))


def test_microseconds_are_cut_not_rounded(spark, log):
    values = ["0.0000019", "-0.0000019", "1767139200.060078", "65.123457", "1e400"]
    p = log("a.log", ["t"], ["time"], values)
    got = [r[0] for r in read_log(spark, p).selectExpr("unix_micros(t)").collect()]
    assert got[:-1] == [int(float(v) * 1e6) for v in values[:-1]] and got[-1] is None


NUMBERS = ["1", "-1", "+1", " 1 ", "1.5", "-1.5", "2.5", "0.4", "-0.4", "-0", "-0.0", "1e3", "1E3", "1_000", "1__0", "_1", "1_", ".5", "5.", ".", "", "abc", "65535", "65536", "65535.4", "65535.5", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "18446744073709551615", "18446744073709551616", "1e19", "1e20", "nan", "inf", "-inf", "Infinity", "1e400", "1d", "1f", "0x", "--1", "1 2", "٣", "1e", "e1"]


@pytest.mark.parametrize("kind,sql", [("int", "BIGINT"), ("count", "UBIGINT"), ("port", "USMALLINT"), ("double", "DOUBLE")])
def test_numbers_against_try_cast(spark, log, kind, sql):
    p = log("a.log", ["s", "v"], ["string", kind], [f"{v}\t{v}" for v in NUMBERS])
    got = {r[0]: r[1] for r in read_log(spark, p).collect()}
    con = duckdb.connect()
    for v in NUMBERS:
        want = con.sql(f"SELECT TRY_CAST('{v}' AS {sql}) AS x").fetchall()[0][0]
        mine = got[v]
        assert (mine != mine and want != want) or (None if mine is None else float(mine)) == (None if want is None else float(want)), v


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"[+-]?[0-9]{0,6}(\.[0-9]{0,3})?([eE][0-9])?", fullmatch=True).filter(lambda s: s not in ("-", "")), min_size=50, max_size=80))
def test_random_numbers_against_try_cast(spark, log, values):
    p = log("r.log", ["v", "c", "d"], ["int", "count", "double"], [f"{v}\t{v}\t{v}" for v in values])
    con = duckdb.connect()
    want = [con.sql(f"SELECT TRY_CAST('{v}' AS BIGINT), TRY_CAST('{v}' AS UBIGINT), TRY_CAST('{v}' AS DOUBLE)").fetchall()[0] for v in values]
    number = lambda r: tuple(None if x is None else float(x) for x in r)
    assert [number(r) for r in read_log(spark, p).collect()] == [number(w) for w in want]


def test_separators_and_markers_of_ones_own(spark, log):
    head = "#separator \\x7c\n#set_separator ;\n#empty_field EMPTY\n#unset_field \n"
    p = log("a.log", ["a", "b", "c"], ["int", "vector[int]", "string"], ["1|2;3;EMPTY|", "EMPTY|EMPTY|x-"], sep="|", head=head)
    assert rows(read_log(spark, p)) == [(1, [2, 3, None], None), (None, None, "x-")]


def test_names(spark, log):
    p = log("a.log", ["id.a", "id.b.c"], ["int", "int"], ["1\t2"])
    assert read_log(spark, p).columns == ["id_a", "id_b_c"]
    assert read_log(spark, p, replace_periods=False).columns == ["id.a", "id.b.c"]
    for fields in (["a.b", "a_b"], ["a", "A"], ["a", "a"]):
        with pytest.raises(LogError, match="one name"):
            read_log(spark, log("b.log", fields, ["int", "int"], []))
    with pytest.raises(LogError, match="one name"):
        read_log(spark, log("b.log", ["filename"], ["int"], []), filename=True)


def test_globs_and_odd_file_names(spark, log, tmp_path):
    for name in ("x/a b.log", "x/c%20d+.log", "x/[e].log", "y/z/f.log"):
        log(name, ["n"], ["string"], [name])
    got = rows(read_log(spark, f"{tmp_path}/**/*.log", filename=True))
    assert len(got) == 4 and all(f == f"{tmp_path}/{n}" for n, f in got)
    assert rows(read_log(spark, f"{tmp_path}/x/[[]e].log")) == [("x/[e].log",)]
    assert rows(read_log(spark, f"{tmp_path}/x/[e].log")) == [("x/[e].log",)]
    with pytest.raises(LogError, match="No files found matching pattern"):
        read_log(spark, f"{tmp_path}/none*")


def test_relative_names_stay_relative(spark, log, tmp_path, monkeypatch):
    log("r.log", ["n"], ["int"], ["1"])
    monkeypatch.chdir(tmp_path)
    assert rows(read_log(spark, "r.log", filename=True)) == [(1, "r.log")]


def test_compression(spark, log):
    p = log("a.log.gz", ["n"], ["int"], ["1", "2"], opener=gzip.open)
    assert rows(read_log(spark, p)) == [(1,), (2,)]
    z = log("a.log.zst", ["n"], ["int"], ["3"], opener=lambda path, mode: pa.CompressedOutputStream(pa.OSFile(str(path), mode), "zstd"))
    assert rows(read_log(spark, z)) == [(3,)]


def test_header_only_files(spark, log):
    p = log("a.log", ["n", "v"], ["int", "set[addr]"], [])
    assert read_log(spark, p).count() == 0 and read_log(spark, p).columns == ["n", "v"]


def test_strict_layouts(spark, log, tmp_path):
    log("a.log", ["ts", "id", "value"], ["time", "string", "count"], ["1\tA\t10"])
    log("b.log", ["ts", "id", "value"], ["time", "string", "string"], ["1\tB\t20"])
    with pytest.raises(LogError, match="has a different schema than .*type for field 'value'"):
        read_log(spark, f"{tmp_path}/*.log")
    assert read_log(spark, f"{tmp_path}/*.log", ignore_file_errors=True).count() == 1
    with pytest.raises(LogError, match="field 'value' has type"):
        read_log(spark, f"{tmp_path}/*.log", union_by_name=True)


def test_union(spark, log, tmp_path):
    log("new.log", ["ts", "id", "value", "extra", "flag"], ["time", "string", "count", "string", "bool"], ["1\tB1\t30\tx\tT", "2\tB2\t40\ty\tF"])
    log("old.log", ["ts", "id", "value"], ["time", "string", "count"], ["3\tA1\t10", "4\tA2\t20"])
    df = read_log(spark, f"{tmp_path}/*.log", union_by_name=True, filename=True)
    assert df.columns == ["ts", "id", "value", "extra", "flag", "filename"]
    assert df.filter("extra IS NULL").count() == 2 and df.filter("flag").count() == 1 and df.filter("id LIKE 'A%'").count() == 2
    log("bar.log", ["ts"], ["time"], ["1"], sep=";")
    with pytest.raises(LogError, match="#separator differs"):
        read_log(spark, f"{tmp_path}/*.log", union_by_name=True)


def test_file_errors(spark, log, tmp_path):
    (tmp_path / "fake.log.gz").write_text("plain text")
    with pytest.raises(LogError, match="Input is not a GZIP stream"):
        read_log(spark, f"{tmp_path}/fake.log.gz")
    with pytest.raises(LogError, match="No valid log files found in pattern"):
        read_log(spark, f"{tmp_path}/fake.log.gz", ignore_file_errors=True)
    (tmp_path / "zero.log.gz").write_bytes(gzip.compress(b""))
    log("good.log.gz", ["id"], ["string"], ["A1", "A2"], opener=gzip.open)
    for union in (False, True):
        assert read_log(spark, f"{tmp_path}/*.gz", ignore_file_errors=True, union_by_name=union).count() == 2


def test_corruption_inside_a_file_is_raised(spark, log, tmp_path):
    p = log("cut.log.gz", ["id"], ["string"], [str(i * 7919) for i in range(50000)], opener=gzip.open)
    data = open(p, "rb").read()
    open(p, "wb").write(data[: len(data) // 2])
    with pytest.raises(Exception):  # noqa: B017
        read_log(spark, p, ignore_file_errors=True).count()


def test_only_what_is_asked_for_is_parsed(spark, log):
    p = log("a.log", ["a", "b", "h"], ["int", "int", "addr"], ["1\t2\tnot-an-address", "3\t4\t10.0.0.1"])
    df = read_log(spark, p)
    assert df.count() == 2 and rows(df.select("a")) == [(1,), (3,)]
    assert rows(df.filter("b = 4").selectExpr("a", "inet_text(h)" if False else "h.prefix")) == [(3, 32)]
    plan = df.select("a")._jdf.queryExecution().executedPlan().toString()
    assert "not-an" not in plan and "Python" not in plan and "raise_error" not in plan
    with pytest.raises(Exception, match="Failed to parse inet"):
        df.collect()


def test_times_are_instants(spark, log):
    p = log("a.log", ["t"], ["time"], ["1768521602.060078"])
    assert rows(read_log(spark, p).selectExpr("string(t)")) == [("2026-01-16 00:00:02.060078",)]
    assert read_log(spark, p).filter("t > timestamp '2026-01-16'").count() == 1
    assert isinstance(read_log(spark, p).first()[0], datetime)


def test_remote_globs_go_into_folders(spark, log, tmp_path):
    """A store that only Spark opens: `**` matches folders of any depth, as it does for local paths."""
    for name in ("a.log", "x/b.log", "x/y/c.log.gz", "x/y/d.txt", ".hidden/e.log"):
        log(name, ["n"], ["string"], [name], opener=gzip.open if name.endswith("gz") else open)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.logs.link./in", f"file://{tmp_path}")
    got = rows(read_log(spark, "viewfs://logs/in/**/*.log*", filename=True))
    assert sorted(got) == [(n, f"viewfs://logs/in/{n}") for n in ("a.log", "x/b.log", "x/y/c.log.gz")]
    assert [r[0] for r in rows(read_log(spark, "viewfs://logs/in/x/**/c*"))] == ["x/y/c.log.gz"]
    assert sorted(r[0] for r in rows(read_log(spark, "viewfs://logs/in/x/*.log"))) == ["x/b.log"]
    with pytest.raises(LogError, match="No files found"):
        read_log(spark, "viewfs://logs/in/none/**/*.log")


def test_very_many_files(spark, log, tmp_path, monkeypatch):
    """Headers are read by tasks, and neither the plan nor what comes back grows with the number of files."""
    for i in range(3_000):
        (tmp_path / f"{i:05d}.log").write_text(f"#separator \\x09\n#fields\tn\n#types\tint\n{i}\n")
    monkeypatch.setattr(files, "sniff", None)
    df = read_log(spark, f"{tmp_path}/*.log", filename=True)
    assert len(df._jdf.queryExecution().analyzed().toString()) < 20_000
    some = df.filter("n < 300")
    assert rows(some.selectExpr("count(*)", "count(DISTINCT filename)")) == [(300, 300)]
    assert df.filter("n = 17").first().filename == f"{tmp_path}/00017.log"


def test_faults_found_in_tasks_are_those_of_the_driver(spark, log, tmp_path, monkeypatch):
    log("good.log.gz", ["id"], ["string"], ["A1", "A2"], opener=gzip.open)
    log("plain.log", ["id"], ["string"], ["A3"])
    (tmp_path / "fake.log.gz").write_text("plain text")
    (tmp_path / "none.log").write_text("")
    paths = sorted(str(p) for p in tmp_path.iterdir())
    by_driver = [(type(h), str(h)) for h in (attempt(spark, p) for p in paths)]
    by_tasks = [(type(h), str(h)) for h in files.sniff_in_tasks(spark, paths)]
    assert by_driver == by_tasks
    monkeypatch.setattr(files, "IN_TASKS", 1)
    assert read_log(spark, f"{tmp_path}/*", ignore_file_errors=True).count() == 3
    with pytest.raises(LogError, match="Input is not a GZIP stream"):
        read_log(spark, f"{tmp_path}/*")


def attempt(spark, path):
    try:
        return files.sniff(spark, path)
    except LogError as e:
        return e


def test_spellings(spark, log, tmp_path, monkeypatch):
    (tmp_path / "deep").mkdir()
    for n in ("deep/a.log", "deep/b.log"):
        log(n, ["n"], ["string"], [n])
    monkeypatch.chdir(tmp_path / "deep")
    assert sorted(rows(read_log(spark, "../deep/*.log", filename=True))) == [("deep/a.log", "../deep/a.log"), ("deep/b.log", "../deep/b.log")]
    assert respelling([("/w/a", "a"), ("/w/b", "b")]) == ("/w/", "") and respelling([("/a", "/a")]) == ("", "")
    assert respelling([("/w/a", "a"), ("/v/b", "b")]) is None


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_log_written_with_an_empty_first_partition(spark, tmp_path, compression):
    header = LogHeader(fields=("n", "text"), types=("int", "string"))
    df = spark.range(0, 40, 1, 4).selectExpr("string(id) AS a", "concat('x', id) AS b")
    for name, where in (("some", "int(a) >= 15"), ("none", "int(a) > 100")):
        write_log(df.filter(where), f"{tmp_path}/{name}", header, compression=compression, line_end="\r")
        got = read_log(spark, f"{tmp_path}/{name}/part-*")
        assert got.dtypes == [("n", "bigint"), ("text", "string")]
        assert sorted(rows(got)) == [(n, f"x{n}") for n in range(15, 40) if name == "some"]
