"""Reading logs: headers are looked at on the driver, one plan is made for each layout, Catalyst does the rest."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.types import field_sql, literal_pattern, spark_type
from skein.sources.files import each_header, expand, for_spark, is_local, local_path, sniff
from skein.sources.header import LogError, LogHeader, difference, lexical_difference

PARTS = "__parts"


def output_names(fields: tuple[str, ...], replace_periods: bool, filename: bool) -> list[str]:
    names = [f.replace(".", "_") if replace_periods else f for f in fields]
    seen: dict[str, str] = {}
    for name, raw in zip([*names, "filename"] if filename else names, [*fields, "filename"], strict=False):
        if name.lower() in seen:
            raise LogError(f"columns '{seen[name.lower()]}' and '{raw}' have one name, '{name}'")
        seen[name.lower()] = raw
    return names


def parsed(lines: DataFrame, header: LogHeader, columns: list[tuple[str, str, str]], inet: bool, *extra: Column) -> DataFrame:
    """`columns` (output name, field, type) of a frame of raw lines, and `extra`; a field that the header lacks is null."""
    rows = lines.filter((F.col("value") != "") & (F.col("value") != "\r") & ~F.startswith("value", F.lit("#")))
    parts = F.expr(f"split(regexp_replace(value, '\\\\r$', ''), {literal_pattern(header.separator)}, -1)")
    rows = rows.select(parts.alias(PARTS), *extra)
    place = {name: i for i, name in enumerate(header.fields)}
    out = []
    for name, field, log_type in columns:
        kind = spark_type(log_type, inet)
        sql = field_sql(f"get({PARTS}, {place[field]})", log_type, header, inet) if field in place else "NULL"
        out.append(F.expr(sql).cast(kind).alias(name))
    return rows.select(*out, *rows.columns[1:])


def respelling(pairs: list[tuple[str, str]]) -> tuple[str, str] | None:
    """(front, new) if every (whole, spelt) path has `new` where `whole` has `front`, followed by the same; else None."""
    whole, spelt = pairs[0]
    shared = len(os.path.commonprefix([whole[::-1], spelt[::-1]]))
    front, new = whole[: len(whole) - shared], spelt[: len(spelt) - shared]
    fits = all(w.startswith(front) and s == new + w[len(front) :] for w, s in pairs)
    return (front, new) if fits else None


def file_names(paths: list[str]) -> Column:
    """The file a row is read from, spelt as in `paths`, from Spark's own spelling, percent-decoded.

    Paths of one pattern differ from Spark's by one beginning at most (none, or the working folder), so the plan does not
    grow with their number; where they do not, they are looked up in a literal map. url_decode takes a plus for a blank, so
    pluses are escaped before it.
    """
    pairs = [(os.path.abspath(local_path(p)) if is_local(p) else p, p) for p in paths]
    spelt = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/"), F.lit("+"), F.lit("%2B")))
    found = respelling(pairs)
    if found == ("", ""):
        return spelt
    if found:
        return F.concat(F.lit(found[1]), F.substring(spelt, F.lit(len(found[0]) + 1), F.length(spelt)))
    return F.element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), spelt)


def groups(pairs: list[tuple[str, LogHeader]]) -> Iterator[tuple[LogHeader, list[str]]]:
    """Files by layout, in the order of the first of each."""
    found: dict[tuple, tuple[LogHeader, list[str]]] = {}
    for path, header in pairs:
        found.setdefault(header.layout, (header, []))[1].append(path)
    yield from found.values()


def read_log(
    spark: SparkSession,
    pattern: str,
    *,
    filename: bool = False,
    replace_periods: bool = True,
    inet: bool = True,
    union_by_name: bool = False,
    ignore_file_errors: bool = False,
) -> DataFrame:
    """The rows of every log that `pattern` matches (a path or a glob, `**` included).

    filename: add a column of each row's file. replace_periods: dots in field names become underscores. inet: addresses
    and subnets as INET structs, else text. union_by_name: columns are the union of all files' fields, else all files
    must have the first one's layout. ignore_file_errors: leave out files that cannot be opened, whose header is
    faulty, or (without union_by_name) whose layout is another.
    """
    paths = expand(spark, pattern)

    def failed(path: str, error: LogError) -> None:
        if not ignore_file_errors:
            raise error

    pairs = each_header(spark, paths, failed)
    if not pairs:
        raise LogError(f"No valid log files found in pattern: {pattern}")
    if union_by_name:
        fields, types = united(pairs)
    else:
        pairs = alike(pairs, ignore_file_errors)
        fields, types = pairs[0][1].fields, pairs[0][1].types
    names = output_names(fields, replace_periods, filename)
    columns = list(zip(names, fields, types, strict=True))
    frames = []
    for header, own in groups(pairs):
        lines = spark.read.text([for_spark(p) for p in own], lineSep="\n")
        extra = [file_names(own).alias("filename")] if filename else []
        frames.append(parsed(lines, header, columns, inet, *extra))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def alike(pairs: list[tuple[str, LogHeader]], ignore: bool) -> list[tuple[str, LogHeader]]:
    first_path, first = pairs[0]
    out = []
    for path, header in pairs:
        why = difference(first, header)
        if why is None:
            out.append((path, header))
        elif not ignore:
            raise LogError(f"{path} has a different schema than {first_path}: {why}")
    return out


def united(pairs: list[tuple[str, LogHeader]]) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Fields in first-seen order and their types; lexical settings and a field's types must agree."""
    first_path, first = pairs[0]
    types: dict[str, tuple[str, str]] = {}
    for path, header in pairs:
        why = lexical_difference(first, header)
        if why is not None:
            raise LogError(f"{path} cannot be united with {first_path}: {why}")
        for name, kind in zip(header.fields, header.types, strict=True):
            before, where = types.setdefault(name, (kind, path))
            if before != kind:
                raise LogError(f"field '{name}' has type '{before}' in {where} but type '{kind}' in {path}")
    return tuple(types), tuple(t for t, _ in types.values())


def read_header(spark: SparkSession, path: str) -> LogHeader:
    return sniff(spark, path)
