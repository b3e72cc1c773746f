import pytest

TEXT = "doc_id long, text string"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from pairs of id and text."""

    def make(*rows):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(pairs, TEXT)

    return make
