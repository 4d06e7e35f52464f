import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Documents from (id, text) pairs, with a column whose name clashes with the operators' own."""
    return lambda pairs: spark.createDataFrame([(i, t, "x") for i, t in pairs], "doc_id long, text string, pos string")
