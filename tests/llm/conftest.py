import pytest

#: Columns whose names the operators use inside.
EXTRA = ["1 as score", "'x' as ids", "2L as key", "3L as node", "4 as n", "5 as root", "'q' as quality", "'s' as secrets", "6 as y", "7 as copy", "8 as hits"]

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated rows, an id with two texts, clashing extra columns."""
    long = "the quick brown fox jumps over it " * 4000
    rows = [(None, "some words of a text without id here"), (None, None), (1, None), (2, ""), (3, long), (4, "same text twice in the table"),
            (4, "same text twice in the table"), (4, "another text of that id"), (5, " \n\t "), (6, "日本語のテキスト 😀 é́"), (7, "!!!"), (8, "???"), (9, "x" * 70000)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *EXTRA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
