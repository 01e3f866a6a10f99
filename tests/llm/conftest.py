import pytest


@pytest.fixture
def texts(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def build(*rows):
        schema = "doc_id long, text string, body binary, line int, _features string"
        return spark.createDataFrame([(i, t, bytearray(b"x"), 1, "y") for i, t in rows], schema)

    return build
