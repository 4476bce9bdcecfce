import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with the other columns of the table and one of a clashing name."""

    def build(rows):
        full = [(i, text, "en", "s", len(text) if text is not None else None) for i, text in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build

