import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """(id, text) rows as a documents table with clashing extra columns."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", "y", len(t or ""), "z", 1.0) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, score string, spans double")
    return make
