import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def documents(spark):
    """Rows to a ``documents`` table; a ``score`` and a ``token`` column clash with the operators' own names."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("token", T.StringType())])

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "x") for i, t in zip(ids, texts, strict=True)], schema)
    return make
