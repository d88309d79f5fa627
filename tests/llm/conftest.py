import pytest

from quotemill.llm.shipping import ship

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text, lang, source) tuples."""
    def make(rows):
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], DOCUMENTS)

    return make
