import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log(tmp_path):
    """Writes a log of the given fields, types and lines; directives can be replaced."""

    def write(name, fields, types, lines, *, sep="\t", head=None, end="\n", last=True, opener=open):
        text = head if head is not None else f"#separator \\x{ord(sep):02x}\n#set_separator,\n#set_separator ,\n#empty_field (empty)\n#unset_field -\n#path t\n"
        text += "" if fields is None else "#fields " + sep.join(fields) + "\n"
        text += "" if types is None else "#types " + sep.join(types) + "\n"
        body = end.join(lines) + (end if last and lines else "")
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with opener(path, "wb") as f:
            f.write((text + body).encode())
        return str(path)

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]
