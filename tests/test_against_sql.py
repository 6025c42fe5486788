"""Every registered query against its SQL, on the smallest test data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.oracle import oracle
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(small_dir):
    return connect(small_dir)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(oracle())
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark, small_dir):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, small_dir, name):
    assert compare(spark, duck, small_dir, QUERIES[name], oracle()[name]) is None


@pytest.mark.parametrize("name", ["field_inventory", "field_count_pivot", "names_per_group"])
def test_comparison_is_not_of_empty_results(spark, small_dir, name):
    assert QUERIES[name](spark, small_dir).count() > 0
