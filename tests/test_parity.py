"""Every registered query gives what its SQL gives on the same tables."""

from __future__ import annotations

import os

import pytest
from compare import compare

import __spark_entry__ as spark_entry
from parity import spark_queries

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(spark_queries.REGISTRY))
def test_query_matches_sql(spark, name):
    compare(spark, SF_DIR, spark_entry.queries()[name], spark_entry.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(spark_queries.REGISTRY) <= set(spark_entry.queries()) & set(spark_entry.oracle_sql())


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.count() > 0
