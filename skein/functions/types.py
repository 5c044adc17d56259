"""Field types of logs: their Spark types, and SQL text that parses a raw field. Nothing here raises but addresses do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions.inet import INET, once, to_inet_sql
from skein.sources.header import LogError, LogHeader

#: The shapes of numbers, as regular expressions in SQL text.
NUMBER = r"^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$"
NOT_FINITE = r"^\\s*[+-]?(inf|infinity|nan)\\s*$"

SIMPLE = {
    "time": T.TimestampType(),
    "interval": T.DayTimeIntervalType(T.DayTimeIntervalType.DAY, T.DayTimeIntervalType.SECOND),
    "double": T.DoubleType(),
    "count": T.DecimalType(20, 0),
    "int": T.LongType(),
    "bool": T.BooleanType(),
    "port": T.IntegerType(),
}


def element_type(log_type: str) -> str | None:
    """The element type of a vector or set type, else None; an unclosed one holds strings."""
    if not log_type.startswith(("vector[", "set[")):
        return None
    start, end = log_type.index("["), log_type.rfind("]")
    return log_type[start + 1 : end] if end > start else "string"


def spark_type(log_type: str, inet: bool = True) -> T.DataType:
    inner = element_type(log_type)
    if inner is not None:
        return T.ArrayType(spark_type(inner, inet), True)
    if log_type in ("addr", "subnet") and inet:
        return INET
    return SIMPLE.get(log_type, T.StringType())


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + "".join(f"\\u{ord(c):04X}" if c in "'\\" or ord(c) < 32 or 126 < ord(c) < 65536 else c for c in text) + "'"


def literal_pattern(char: str) -> str:
    """A SQL literal of a regular expression that matches one character."""
    return quoted(f"\\x{{{ord(char):x}}}")


def plain_digits(s: str) -> str:
    return f"regexp_replace({s}, '(?<=[0-9])_(?=[0-9])', '')"


def whole_number(s: str) -> str:
    """SQL for a lenient whole number as DECIMAL(20, 0): decimal and exponent forms are rounded half away from zero.

    A plain run of at most 18 digits, as nearly all fields are, is cast; only others go through the patterns.
    """
    odd = once(plain_digits(s), "t", f"CASE WHEN t RLIKE '{NUMBER}' THEN try_cast(t AS DECIMAL(20, 0)) END")
    return f"coalesce(CAST(try_cast({s} AS BIGINT) AS DECIMAL(20, 0)), {odd})"


def unsigned(s: str, most: str) -> str:
    """SQL for a whole number from 0 to `most`; what is below zero before it is rounded is null."""
    minus = rf"(startswith(ltrim({s}), '-') AND NOT {plain_digits(s)} RLIKE '^\\s*-0+\\s*$')"
    return once(whole_number(s), "n", f"CASE WHEN n BETWEEN 0 AND {most} AND NOT {minus} THEN n END")


def real(s: str) -> str:
    return once(plain_digits(s), "t", f"CASE WHEN t RLIKE '{NUMBER}' OR lower({s}) RLIKE '{NOT_FINITE}' THEN try_cast(t AS DOUBLE) END")


def micros(s: str) -> str:
    """Seconds to microseconds, cut towards zero; NaN and infinity have none."""
    return f"try_cast({real(s)} * 1000000D AS BIGINT)"


def scalar_sql(s: str, log_type: str, inet: bool) -> str:
    if log_type == "time":
        return f"timestamp_micros({micros(s)})"
    if log_type == "interval":
        return f"(timestamp_micros({micros(s)}) - timestamp_micros(0))"
    if log_type == "double":
        return real(s)
    if log_type == "int":
        return f"try_cast({whole_number(s)} AS BIGINT)"
    if log_type == "count":
        return f"CAST({unsigned(s, '18446744073709551615BD')} AS DECIMAL(20, 0))"
    if log_type == "port":
        return f"CAST({unsigned(s, '65535')} AS INT)"
    if log_type == "bool":
        return f"({s} = 'T' OR {s} = 'true')"
    if log_type in ("addr", "subnet") and inet:
        return to_inet_sql(s)
    return s


def interval_text_sql(d: str) -> str:
    """SQL for an interval's usual text: whole days, then hours, minutes, seconds and what there is of a fraction."""
    days = "CASE WHEN abs(p.days) = 1 THEN concat(p.days, ' day') WHEN p.days <> 0 THEN concat(p.days, ' days') END"
    two = lambda x: f"lpad({x}, 2, '0')"
    fraction = "CASE WHEN p.us % 1000000 <> 0 THEN concat('.', rtrim('0', lpad(p.us % 1000000, 6, '0'))) END"
    clock = f"concat({two('p.us DIV 3600000000')}, ':', {two('p.us DIV 60000000 % 60')}, ':', {two('p.us DIV 1000000 % 60')}, coalesce({fraction}, ''))"
    time = f"CASE WHEN p.us <> 0 OR p.days = 0 THEN concat(CASE WHEN p.minus THEN '-' ELSE '' END, {clock}) END"
    whole = once(f"CAST(extract(HOUR FROM {d}) * 3600000000L + extract(MINUTE FROM {d}) * 60000000L + extract(SECOND FROM {d}) * 1000000 AS BIGINT)", "u", f"named_struct('days', CAST(extract(DAY FROM {d}) AS BIGINT), 'us', abs(u), 'minus', u < 0)")
    return f"CASE WHEN {d} IS NOT NULL THEN {once(whole, 'p', f'concat_ws(chr(32), {days}, {time})')} END"


def interval_text(duration: str) -> Column:
    """The text of an interval; `duration` is a SQL expression, such as a column's name."""
    return F.expr(interval_text_sql(f"({duration})"))


def field_sql(s: str, log_type: str, header: LogHeader, inet: bool = True) -> str:
    """SQL for a raw field: null if absent or a marker, else its value. The raw text is taken out of its line once."""
    markers = f"{quoted(header.unset)}, {quoted(header.empty)}"
    inner = element_type(log_type)
    if inner is None:
        value = scalar_sql("f", log_type, inet)
    elif element_type(inner) is not None:
        raise LogError(f"lists of lists are not supported: {log_type}")
    else:
        value = f"transform(split(f, {literal_pattern(header.set_separator)}, -1), e -> CASE WHEN e NOT IN ({markers}) THEN {scalar_sql('e', inner, inet)} END)"
    return once(s, "f", f"CASE WHEN f NOT IN ({markers}) THEN {value} END")
