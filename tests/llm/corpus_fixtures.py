"""Documents the tests of the corpus operators share."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside or give to their results.
CLASHING = ("score", "print", "n_words", "plain_text", "text_key", "unknown", "number", "row", "kinds", "grp", "_n")


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns of clashing names."""

    def make(pairs, lang="en", source="s"):
        rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in pairs]
        docs = spark.createDataFrame(rows, SCHEMA)
        for name in CLASHING:
            docs = docs.selectExpr("*", f"'x' as `{name}`")
        return docs

    return make


LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))
EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, LONG), (6, "same text here twice " * 8), (6, "same text here twice " * 8), (None, "no id but words"), (7, LONG)]


@pytest.fixture
def edge_docs(make_docs):
    """Nulls, empty, blank and very long texts, repeated rows and a row without id."""
    return make_docs(EDGES)


@pytest.fixture
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
