import pytest

DOCS = "doc_id long, text string, lang string, source string, kept boolean, component_id long, `__key` long, copy int, n_lines int"


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with names the operators use."""
    long = " ".join(f"word{i % 997}" for i in range(30_000)) + "\n" * 50
    rows = [
        (1, "alpha beta gamma delta", "en", "a"), (2, "alpha beta gamma delta", "en", "a"), (2, "alpha beta gamma delta", "en", "a"), (3, None, None, None),
        (None, "alpha beta gamma delta", "en", "a"), (None, None, "en", "b"), (4, "", "en", "b"), (5, long, "de", None), (6, long, "de", "b"), (7, "  \n\t ", "fr", ""),
        (8, "one\ntwo\nthree\nfour", "en", "a"), (9, "zero\none\ntwo\nthree", "en", "a"), (9, "another text", "en", "a"), (10, "x" * 100_000, "en", "b"),
    ]
    return spark.createDataFrame([(*r, True, 5, 7, 9, 11) for r in rows], DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
