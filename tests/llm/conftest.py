import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Make a documents table; two extra columns clash with names the operators use inside."""

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), i, "x") for i, t, s in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", _row long, size string")

    return make
