import pytest


@pytest.fixture
def frame(spark):
    """DataFrame from rows of (doc_id, text)."""
    return lambda rows, parts=3: spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
