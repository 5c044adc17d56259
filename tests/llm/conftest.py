import pytest

#: Texts of every awkward kind; ids may be null or repeated.
ODD = [
    (1, "The cat sat on the mat and the dog ran off to the far end of the long road."),
    (2, "The cat sat on the mat and the dog ran off to the far end of the long road."),
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (6, "word"),
    (6, "word"),
    (7, "x" * 30000),
    (8, "many words " * 20000),
    (None, "a row of no id at all, but with words"),
    (9, "Ünïcödé  çà et là\x85日本語 😀 <|endoftext|> end."),
    (10, "1234 5678 !!! ???"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns whose names clash with those the operators use."""
    rows = [(i, t, "en", "s", 0, 0.5, 1, "k") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, fp int, evidence string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
