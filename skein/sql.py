"""SQL text over logs: `read_...('glob', name = value)` calls in FROM, `::inet`, `<<=` and DESCRIBE as a relation."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skein.functions import inet
from skein.plans.reader import read_log
from skein.sources.header import LogError

_views = itertools.count()

PARAMETERS = ("filename", "replace_periods", "inet", "union_by_name", "ignore_file_errors")

#: String literals, quoted names and comments: nothing inside them is rewritten.
OPAQUE = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)

CALL = re.compile(r"\bread_\w+\s*\(", re.I)

OPERAND = r"(?:[A-Za-z_][\w.]*(?:\([^()]*\))?|\x00\d+\x00)"


class Hidden:
    """Text whose opaque parts are numbered placeholders."""

    def __init__(self, text: str):
        self.parts: list[str] = []
        self.text = OPAQUE.sub(self._hide, text)

    def _hide(self, m: re.Match) -> str:
        if m[0].startswith(("--", "/*")):
            return " "
        self.parts.append(f"`{m[0][1:-1]}`" if m[0][0] == '"' else m[0])
        return f"\x00{len(self.parts) - 1}\x00"

    def shown(self, text: str) -> str:
        return re.sub(r"\x00(\d+)\x00", lambda m: self.parts[int(m[1])], text)


def closing(text: str, start: int) -> int:
    """The position of the bracket that closes the one before `start`."""
    depth = 1
    for i in range(start, len(text)):
        depth += {"(": 1, ")": -1}.get(text[i], 0)
        if not depth:
            return i
    raise LogError("unbalanced brackets")


def arguments(text: str, hidden: Hidden) -> tuple[str, dict[str, bool]]:
    first, *rest = [a.strip() for a in text.split(",")]
    pattern = hidden.shown(first)
    if not pattern.startswith("'"):
        raise LogError(f"the first argument must be a string literal: {pattern}")
    named = {}
    for a in rest:
        m = re.fullmatch(r"(\w+)\s*(?:=>|:=|=)\s*(true|false)", a, re.I)
        if not m or m[1].lower() not in PARAMETERS:
            raise LogError(f"unknown parameter: {hidden.shown(a)}; known: {', '.join(PARAMETERS)}")
        named[m[1].lower()] = m[2].lower() == "true"
    return pattern[1:-1].replace("''", "'"), named


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Runs `text` with log readers, INET casts and containment rewritten; `views` are further named frames."""
    inet.register(spark)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    made: list[str] = []
    try:
        return spark.sql(rewritten(spark, text, made))
    finally:
        for view in made:  # the frame has been analysed; it does not need their names
            spark.catalog.dropTempView(view)


def rewritten(spark: SparkSession, text: str, made: list[str]) -> str:
    """`text` in Spark's own SQL; the views that it names are added to `made`."""
    hidden = Hidden(text)
    body = hidden.text
    while m := CALL.search(body):
        end = closing(body, m.end())
        pattern, named = arguments(body[m.end() : end], hidden)
        view = f"__log_{next(_views)}"
        made.append(view)
        read_log(spark, pattern, **named).createOrReplaceTempView(view)
        body = body[: m.start()] + view + body[end + 1 :]
    body = re.sub(rf"({OPERAND})\s*::\s*inet\b", r"to_inet(\1)", body, flags=re.I)
    operand = rf"(?:to_inet\({OPERAND}\)|{OPERAND})"
    body = re.sub(rf"({operand})\s*<<=\s*({operand})", r"inet_contained_by(\1, \2)", body, flags=re.I)
    body = re.sub(rf"({operand})\s*>>=\s*({operand})", r"inet_contained_by(\2, \1)", body, flags=re.I)
    body = re.sub(r"::\s*timestamptz\b|::\s*timestamp with time zone\b", "::timestamp", body, flags=re.I)
    while m := re.search(r"\(\s*describe\s+", body, re.I):
        end = closing(body, m.end())
        view = f"__schema_{next(_views)}"
        made.append(view)
        described(spark, hidden.shown(body[m.end() : end])).createOrReplaceTempView(view)
        body = body[: m.start()] + view + body[end + 1 :]
    return hidden.shown(body)


def register(spark: SparkSession) -> None:
    """What plain `spark.sql` needs: to_inet, inet_text and inet_contained_by as temporary functions (see log_view too).

    A table function of Spark's own would be a Python UDTF: one task, one Python worker, every column parsed and nothing
    pushed down. Logs are views in its place, which Catalyst plans as it does read_log's frames.
    """
    inet.register(spark)


def log_view(spark: SparkSession, name: str, pattern: str, **parameters: bool) -> DataFrame:
    """Logs as a temporary view of the session, for plain `spark.sql`; parameters as of read_log."""
    register(spark)
    df = read_log(spark, pattern, **parameters)
    df.createOrReplaceTempView(name)
    return df


def described(spark: SparkSession, query: str) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in spark.sql(query).schema]
    return spark.createDataFrame(rows, T.StructType().add("column_name", "string").add("column_type", "string"))
