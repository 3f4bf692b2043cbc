"""Every registered query against its SQL counterpart on the smallest provided tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as spark_entry

QUERIES, ORACLES = spark_entry.QUERIES, spark_entry.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_matches_sql(spark, sf, con, key):
    assert differences(QUERIES[key](spark, sf), con, ORACLES[key]) is None


def test_entry(spark):
    rows = spark_entry.entry(spark)
    assert rows.columns == ["consumption", "amount", "room", "device", "date_key", "created_at"]
    assert rows.count() > 0
