import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string"


@pytest.fixture
def documents(spark):
    """Documents from (id, text); the last column clashes with one that an operator adds."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), "own") for i, t in rows], DOC)
    return make
