import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of the given texts; extra columns have names the operators use inside."""

    def make(texts, ids=None, sources=None, langs=None):
        n = len(texts)
        rows = [
            (
                (ids or list(range(n)))[i], texts[i], (langs or ["en"] * n)[i], (sources or ["a"] * n)[i],
                len(texts[i] or ""), "x", i, "y", 1.0,
            )
            for i in range(n)
        ]
        return spark.createDataFrame(rows, DOCS + ", row string, id long, h string, size double").repartition(3)

    return make
