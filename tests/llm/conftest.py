import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """make_docs([(doc_id, text), ...]) -> a documents table."""
    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", None) for i, t in rows], DOCS)
    return make
