import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from skein.operators import queries
from skein.operators.queries import REGISTRY
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def comparable(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(r[i] for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, con, name):
    query, text = REGISTRY[name]
    df = query(spark, DATA)
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(text)
    assert got == comparable(rel.columns, rel.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_but_the_entry_imports_llm():
    """The subpackage can be taken away."""
    root = Path(queries.__file__).resolve().parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
