import pytest

from skein.sources.header import LogError, LogHeader, difference, parse_header, unescape


def test_unescape():
    assert unescape(r"\x09") == "\t" and unescape(r"\t\n") == "\t\n" and unescape("a\tb") == "a\tb"
    with pytest.raises(LogError):
        unescape(r"\xZZ")


def test_directives_end_at_tab_or_blank_and_later_separators_count():
    h = parse_header(["#separator \t", "#set_separator\t|", "#empty_field (e)", "#unset_field ~", "#path x y", "#unknown z", "#fields a\tb", "#types int\tstring", "1\t2"])
    assert h == LogHeader("\t", "|", "(e)", "~", "x y", "", ("a", "b"), ("int", "string"))
    h = parse_header(["#separator \\x3b", "#fields a;b\r", "#types int;int"])
    assert h.fields == ("a", "b") and h.separator == ";"
    assert parse_header(["#fields a\tb", "#separator ;", "#types int;int"]).fields == ("a", "b")


def test_first_byte_of_separators_and_empty_ones():
    assert parse_header(["#set_separator |,", "#separator ", "#fields a", "#types int"]).lexical[:2] == ("\t", "|")


@pytest.mark.parametrize("lines,message", [(["#types int"], "missing #fields"), (["#fields a"], "missing #types"), (["#fields a\tb", "#types int"], "2 #fields but 1 #types"), ([], "missing #fields"), (["", "#fields a", "#types int"], "missing #fields")])
def test_faulty_headers(lines, message):
    with pytest.raises(LogError, match=message):
        parse_header(lines)


def test_differences_in_order():
    base = LogHeader(fields=("a", "b"), types=("int", "count"))
    assert difference(base, base) is None
    assert "different field count" in difference(base, LogHeader(fields=("a",), types=("int",)))
    assert "field 0 differs" in difference(base, LogHeader(fields=("b", "a"), types=("int", "count")))
    assert "type for field 'b' differs" in difference(base, LogHeader(fields=("a", "b"), types=("int", "string")))
    for key, name in (("separator", "#separator"), ("set_separator", "#set_separator"), ("unset", "#unset_field"), ("empty", "#empty_field")):
        assert difference(base, LogHeader(**{"fields": base.fields, "types": base.types, key: "!"})) == f"{name} differs"
