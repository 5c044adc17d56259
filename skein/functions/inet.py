"""Internet addresses as struct<family tinyint, addr binary, prefix smallint>, in SQL text over built-in functions.

Addresses of one family compare and group as their bytes; the bytes of an address keep the host bits of a subnet.
"""

from __future__ import annotations

from weakref import WeakSet

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INET = T.StructType().add("family", T.ByteType()).add("addr", T.BinaryType()).add("prefix", T.ShortType())

#: Sessions that have the functions.
_registered: WeakSet[SparkSession] = WeakSet()

OCTET = r"(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IPV4 = rf"{OCTET}(\\.{OCTET}){{3}}"
GROUPS = r"([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?"


def once(value: str, name: str, body: str) -> str:
    """`body`, in which `name` stands for a value that is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def to_inet_sql(s: str) -> str:
    """SQL for a text's address or subnet; null stays null, anything else raises."""
    octets = "transform(split(p.host, '\\\\.'), o -> lpad(conv(o, 10, 16), 2, '0'))"
    v4 = f"named_struct('family', 4Y, 'addr', unhex(array_join({octets}, '')), 'prefix', CAST(coalesce(p.bits, 32) AS SMALLINT))"
    sides = "transform(split(h, '::', -1), z -> filter(split(z, ':'), g -> g <> ''))"
    filled = "concat(q[0], array_repeat('0', greatest(8 - size(q[0]) - size(coalesce(get(q, 1), array())), 0)), coalesce(get(q, 1), array()))"
    digits = f"unhex(array_join(transform({filled}, g -> lpad(g, 4, '0')), ''))"
    width = "size(q[0]) + size(coalesce(get(q, 1), array()))"
    fits = f"((instr(h, '::') = 0 AND {width} = 8) OR (instr(h, '::') > 0 AND {width} < 8))"
    shape = f"(h RLIKE '^{GROUPS}(::{GROUPS})?$')"
    v6 = f"named_struct('family', 6Y, 'addr', {digits}, 'prefix', CAST(coalesce(p.bits, 128) AS SMALLINT))"
    bad = f"raise_error(concat('Failed to parse inet: ', {s}))"
    tail = "regexp_extract(lower(p.host), '([0-9.]+)$', 1)"
    parts = f"transform(split({tail}, '\\\\.'), o -> lpad(conv(o, 10, 16), 2, '0'))"
    four = once(parts, "t", "concat(t[0], t[1], ':', t[2], t[3])")
    host = f"CASE WHEN p.host RLIKE ':{IPV4}$' THEN concat(regexp_replace(lower(p.host), '[0-9.]+$', ''), {four}) ELSE lower(p.host) END"
    inner = once(sides, "q", f"CASE WHEN {shape} AND {fits} AND coalesce(p.bits, 0) <= 128 THEN {v6} ELSE {bad} END")
    split = f"named_struct('host', split({s}, '/')[0], 'bits', try_cast(get(split({s}, '/'), 1) AS INT))"
    whole = f"CASE WHEN NOT {s} RLIKE '^[0-9A-Fa-f:.]+(/[0-9]{{1,3}})?$' THEN {bad} WHEN p.host RLIKE '^{IPV4}$' AND coalesce(p.bits, 0) <= 32 THEN {v4} ELSE {once(host, 'h', inner)} END"
    return f"CASE WHEN {s} IS NOT NULL THEN {once(split, 'p', whole)} END"


def inet_text_sql(a: str) -> str:
    """SQL for an address's usual text; a full prefix is left out."""
    v4 = "array_join(transform(sequence(0, 3), i -> conv(substring(hex(x.addr), 2 * i + 1, 2), 16, 10)), '.')"
    groups = "array_join(transform(sequence(0, 7), i -> lower(conv(substring(hex(x.addr), 4 * i + 1, 4), 16, 16))), ':')"
    shorter = " ".join(f"WHEN v RLIKE '(^|:)0(:0){{{n - 1}}}(:|$)' THEN regexp_replace(v, '^(.*?)(^|:)0(:0){{{n - 1}}}(:|$)(.*)$', '$1::$5')" for n in range(8, 1, -1))
    v6 = once(groups, "v", f"CASE {shorter} ELSE v END")
    text = f"concat(CASE WHEN x.family = 4 THEN {v4} ELSE {v6} END, CASE WHEN x.prefix = CASE WHEN x.family = 4 THEN 32 ELSE 128 END THEN '' ELSE concat('/', x.prefix) END)"
    return once(a, "x", f"CASE WHEN x IS NOT NULL THEN {text} END")


def contained_by_sql(a: str, b: str) -> str:
    """SQL for whether a is b or lies inside it: same family, no shorter prefix, equal leading bits.

    The leading whole digits of the two in hexadecimal are equal, and so are the leading bits of the next one.
    """
    whole = "CAST(p.y.prefix DIV 4 AS INT)"
    digit = lambda x: f"shiftright(CAST(conv(substring(hex(p.{x}.addr), {whole} + 1, 1), 16, 10) AS INT), 4 - CAST(p.y.prefix % 4 AS INT))"
    start = lambda x: f"substring(hex(p.{x}.addr), 1, {whole})"
    same = f"{start('x')} = {start('y')} AND (p.y.prefix % 4 = 0 OR {digit('x')} = {digit('y')})"
    inside = f"CASE WHEN p.x IS NULL OR p.y IS NULL THEN NULL ELSE p.x.family = p.y.family AND p.x.prefix >= p.y.prefix AND {same} END"
    return once(f"named_struct('x', {a}, 'y', {b})", "p", inside)


def to_inet(text: str) -> Column:
    """The address of a text; `text` is a SQL expression, such as a column's name."""
    return F.expr(to_inet_sql(f"({text})"))


def inet_text(address: str) -> Column:
    return F.expr(inet_text_sql(f"({address})"))


def inet_contained_by(address: str, network: str) -> Column:
    return F.expr(contained_by_sql(f"({address})", f"({network})"))


def register(spark: SparkSession) -> None:
    """to_inet, inet_text and inet_contained_by as temporary SQL functions of the session, made once."""
    if spark in _registered:
        return
    kind = "STRUCT<family: TINYINT, addr: BINARY, prefix: SMALLINT>"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION to_inet(s STRING) RETURNS {kind} RETURN {to_inet_sql('s')}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION inet_text(a {kind}) RETURNS STRING RETURN {inet_text_sql('a')}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION inet_contained_by(a {kind}, b {kind}) RETURNS BOOLEAN RETURN {contained_by_sql('a', 'b')}")
    _registered.add(spark)
