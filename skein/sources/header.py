"""Headers of self-describing delimited logs: directive lines that start with `#`, before the first data line."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace


class LogError(ValueError):
    """A log or a set of logs that cannot be read as asked."""


@dataclass(frozen=True)
class LogHeader:
    separator: str = "\t"
    set_separator: str = ","
    empty: str = "(empty)"
    unset: str = "-"
    path: str = ""
    opened: str = ""
    fields: tuple[str, ...] = field(default=())
    types: tuple[str, ...] = field(default=())

    @property
    def lexical(self) -> tuple[str, str, str, str]:
        return self.separator, self.set_separator, self.unset, self.empty

    @property
    def layout(self) -> tuple:
        """What decides how a line is read: headers of equal layout are read by one plan."""
        return self.fields, self.types, self.lexical


def unescape(text: str) -> str:
    r"""`\xHH`, `\t` and `\n` replaced; bad hexadecimal digits are an error."""
    out, i = [], 0
    while i < len(text):
        two = text[i : i + 2]
        if two == "\\x" and i + 4 <= len(text):
            try:
                out.append(chr(int(text[i + 2 : i + 4], 16)))
            except ValueError:
                raise LogError(f"bad escape {text[i : i + 4]!r} in a separator") from None
            i += 4
        elif two in ("\\t", "\\n"):
            out.append({"\\t": "\t", "\\n": "\n"}[two])
            i += 2
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def apply_directive(line: str, header: LogHeader) -> LogHeader:
    """The header after one directive line; fields and types are split by the separator in force at that point."""
    at = min((i for i in (line.find("\t"), line.find(" ")) if i >= 0), default=len(line))
    name, value = line[:at], line[at + 1 :]
    if name in ("#separator", "#set_separator"):
        key, plain = name[1:], unescape(value)
        return replace(header, **{key: plain[0]}) if plain else header
    simple = {"#empty_field": "empty", "#unset_field": "unset", "#path": "path", "#open": "opened"}
    if name in simple:
        return replace(header, **{simple[name]: value})
    if name in ("#fields", "#types"):
        return replace(header, **{name[1:]: tuple(value.split(header.separator)) if value else ()})
    return header


def parse_header(lines: Iterable[str], where: str = "") -> LogHeader:
    """The header at the start of `lines`; carriage returns in directives are dropped."""
    header = LogHeader()
    for line in lines:
        line = line.rstrip("\n").replace("\r", "")
        if not line.startswith("#"):
            break
        header = apply_directive(line, header)
    place = f" in {where}" if where else ""
    if not header.fields:
        raise LogError(f"missing #fields{place}")
    if not header.types:
        raise LogError(f"missing #types{place}")
    if len(header.fields) != len(header.types):
        raise LogError(f"{len(header.fields)} #fields but {len(header.types)} #types{place}")
    return header


def difference(expected: LogHeader, actual: LogHeader) -> str | None:
    """The first way in which `actual` is laid out unlike `expected`, or None."""
    if len(expected.fields) != len(actual.fields):
        return f"different field count ({len(expected.fields)} and {len(actual.fields)})"
    for i, (a, b) in enumerate(zip(expected.fields, actual.fields, strict=True)):
        if a != b:
            return f"field {i} differs ('{a}' and '{b}')"
    for name, a, b in zip(expected.fields, expected.types, actual.types, strict=True):
        if a != b:
            return f"type for field '{name}' differs ('{a}' and '{b}')"
    return lexical_difference(expected, actual)


def lexical_difference(expected: LogHeader, actual: LogHeader) -> str | None:
    names = ("#separator", "#set_separator", "#unset_field", "#empty_field")
    return next((f"{n} differs" for n, a, b in zip(names, expected.lexical, actual.lexical, strict=True) if a != b), None)
