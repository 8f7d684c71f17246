import pytest


@pytest.fixture
def docs(spark):
    """Documents from texts: doc_id counts from 0, or (doc_id, text) pairs."""
    def make(texts, extra=False):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        if extra:  # columns that clash with names the operators use inside
            return spark.createDataFrame(
                [(i, t, "x", 1, "y", [1]) for i, t in pairs],
                "doc_id long, text string, row string, n int, component_id string, kept array<int>")
        return spark.createDataFrame(pairs, "doc_id long, text string")
    return make


EDGE_TEXTS = [None, "", "   \n ", "one", "one", "one two three four five six", "x " * 20000, "Grüße 日本語 \x00 end", None]
