import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs or whole rows; any column may be null."""

    def make(rows, extra=""):
        full = [r if len(r) > 2 else (r[0], r[1], None, None, None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS + extra)

    return make
