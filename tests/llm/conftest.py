import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table of (id, text) pairs with extra columns whose names clash with inner ones."""

    def make(pairs):
        return spark.createDataFrame(
            [(i, t, "x", 1, None) for i, t in pairs], "doc_id long, text string, digest string, file int, row string"
        )

    return make
