"""Registered queries against independent SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry_points
from check_oracles import compare, sql_engine
from tests.conftest import SF

# One trip key repeats in the smallest data set, and this query's SQL joins on the key.
NEEDS_UNIQUE_KEYS = {"prepare_training"}


@pytest.fixture(scope="module")
def con():
    return sql_engine(SF)


@pytest.mark.parametrize("name", sorted(set(entry_points.oracle_sql()) - NEEDS_UNIQUE_KEYS))
def test_values_match(spark, con, name):
    verdict = compare(spark, con, name, SF)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 24 and "mean_fare_amount" in df.columns


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
