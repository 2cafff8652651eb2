from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("row", T.StringType()), T.StructField("spans", T.IntegerType())])


@pytest.fixture(scope="session")
def shipped(spark):
    from locusframe.llm.queries import ship

    ship(spark)
    return spark


@pytest.fixture
def documents(shipped):
    """Rows of (doc_id, text), with more columns whose names operators use themselves."""
    def make(rows, parts=3):
        rows = [(i, t, f"extra {i}", 5) for i, t in rows]
        return shipped.createDataFrame(rows, DOCUMENTS).repartition(parts) if rows else shipped.createDataFrame([], DOCUMENTS)

    return make
