import pytest

#: Columns that the operators use inside themselves.
CLASHING = ["doc", "n", "h1", "token", "item", "pos", "words", "removed", "component", "first", "block", "start", "score"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, copies, and columns with names the operators use."""
    long = " ".join(f"word{i} And more." for i in range(40_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
        (2, None, "en", None),
        (3, "", None, "b"),
        (4, long, "en", "b"),
        (5, long, "de", "b"),
        (5, long, "de", "b"),
        (6, " \n\t ", "en", "b"),
        (7, "ÄÖÜ 123 ,,, ñandú", "es", "b"),
        (None, "A row without a key that holds some words of its own.", "en", "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in CLASHING:
        docs = docs.selectExpr("*", f"'x' AS {c}")
    return docs.cache()


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")
