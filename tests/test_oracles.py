"""Every registered query gives the rows of its SQL twin."""

import pytest
from compare import duck, duck_rows, spark_rows
from conftest import SF_DIR

import __spark_entry__ as contract
from tidemark.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql_twin(spark, connection, name):
    columns, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    want_columns, want_rows = duck_rows(connection, contract.oracle_sql()[name])
    assert columns == want_columns
    assert len(rows) == len(want_rows)
    assert rows == want_rows


def test_every_query_has_a_twin_and_the_flagship_runs(spark):
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


def test_sorted_revenue_comes_in_window_order(spark):
    rows = contract.queries()["revenue_tumbling_sorted"](spark, SF_DIR).collect()
    keys = [(r.window_start, r.category is not None, r.category) for r in rows]
    assert keys == sorted(keys)
