"""Every registered query of the warehouse against its SQL check, over the whole of the smallest test data."""

import re

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from tellerlake.plans.registry import CHECK_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# No Python in the workers, no row-by-row or all-pairs joins.
FOREIGN = re.compile("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


# pip_03 starts with all that pip_01 and pip_02 do.
NAMES = sorted(QUERIES.keys() - {"pip_01", "pip_02"})


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    found = differences(df, connection, CHECK_SQL[name])
    assert not found, found
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Joining lines that quotes hold together is the one pass over Arrow batches.
    plan = plan.replace("MapInArrow _pieces", "")
    assert not FOREIGN.search(plan), FOREIGN.findall(plan)


def test_all_are_registered_with_the_driver():
    assert QUERIES.keys() <= entry.queries().keys() and CHECK_SQL.keys() <= entry.oracle_sql().keys()


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def _plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_versions_are_compared_with_the_source_once(spark):
    """What the source contradicts is read from its written table; customers are scanned for both halves only."""
    assert _plan(spark, "dim_03").count("/customer.parquet") <= 6


def test_a_month_reaches_the_scan(spark):
    plan = _plan(spark, "ana_09")
    assert re.search(r"l_shipdate#\d+ >= 1998-06-01 .* l_shipdate#\d+ < 1998-07-01", plan.replace("(", ""))


def test_log_rows_are_not_sorted_before_they_are_filtered(spark):
    """Whole rows are aggregated only once the semi joins have left the newest of each key."""
    plan = _plan(spark, "log_01")
    assert plan.count("SortAggregate") <= 2 and "HashAggregate" in plan
