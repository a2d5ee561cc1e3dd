"""Every registered query against its expected SQL, and the entry point."""

import pytest
from conftest import SF

import __spark_entry__
from tidemark.catalog.queries import registered
from verification.blocks import BLOCKS
from verification.compare import connect, difference
from verification.oracle_sql import statements

# Queries of other parts that the entry point adds have tests of their own.
QUERIES, EXPECTED = registered(), statements()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(EXPECTED) and len(QUERIES) > 130 and len(BLOCKS) > 40
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(EXPECTED) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, EXPECTED[name]) is None


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["year", "month", "region_name", "gross_revenue", "net_revenue"] and df.count() > 0


def test_comparison_notices_differences(spark, duck):
    df = spark.sql("select 1L a, 'x' b")
    assert difference(df, duck, "select cast(1 as bigint) a, 'x' b") is None
    assert difference(df, duck, "select cast(2 as bigint) a, 'x' b") and difference(df, duck, "select 1 a, 'x' b")
