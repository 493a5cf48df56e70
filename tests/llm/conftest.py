import pytest

#: (doc_id, text, source): nulls, empty texts, ties, repeated rows, blanks only, a long text.
EDGE_ROWS = [
    (1, "Hello  world", "a"), (2, "Helloworld", "a"), (3, None, "b"), (4, "", None), (5, " \t\n", "b"),
    (6, "Hello\tworld", "a"), (6, "Hello\tworld", "a"), (None, "Hello world", "a"), (None, "lonely", None),
    (7, "word " * 30_000, "c"), (8, "caf\u00e9 \u65e5\u672c \U0001f600 \u00a0x", "c"), (9, "The same line here.\nThe same line here.\n" * 20, "c"),
]
SCHEMA = "doc_id long, text string, source string, row_no int, digest string, length int"


@pytest.fixture
def edge(spark):
    """Edge cases, with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", 2) for r in EDGE_ROWS], SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
