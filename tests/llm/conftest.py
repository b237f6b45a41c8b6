import pytest

from viewtide.llm.base import prepared


@pytest.fixture
def session(spark):
    return prepared(spark)


@pytest.fixture
def documents(session):
    """A table of documents from (doc_id, text, lang, source), with columns whose names an operator might use itself."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, number string, row string, code string, size string"
        full = [(i, t, l, s, None if t is None else len(t), "n", "r", "c", "z") for i, t, l, s in rows]
        return session.createDataFrame(full, schema).repartition(3)

    return make
