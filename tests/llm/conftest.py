import pytest


@pytest.fixture()
def docs_of(spark):
    """``docs_of([(1, "text"), ...], extra="x string")`` with columns doc_id, text and more."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make
