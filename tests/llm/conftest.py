import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())])


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) as a frame with one more column, whose name clashes with an output's."""
    return lambda rows: spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)
