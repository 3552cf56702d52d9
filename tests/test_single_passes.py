"""Work that is done once: shuffles that are shared, tables that are not searched, rows that are not written first."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import dashboard, facts, quality
from tellerlake.plans import daily
from tellerlake.schemas import ACCOUNT_FILE, CUSTOMER_FILE, TRANSACTION_FILE
from tellerlake.sources.lake import Lake

FILES = {"t_customer": CUSTOMER_FILE, "t_account": ACCOUNT_FILE, "t_transaction": TRANSACTION_FILE}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, table, ids, note):
    """A row an id; ``note`` tells the copies of different loads apart."""
    at = datetime(2024, 1, 1, 9)
    cells = {
        "t_customer": lambda n: (n, "F", "L", "a@b.com", "1", note, "ON", "Canada", at),
        "t_account": lambda n: (n, "c1", "Savings", note, "CAD", date(2023, 1, 1), at),
        "t_transaction": lambda n: (n, "a1", at, "Fee", None, note),
    }[table]
    return spark.createDataFrame([cells(n) for n in ids], FILES[table])


def load(lake, table, load_id, ids, note, day=1):
    tables = {table: rows(lake.spark, table, ids, note)}
    daily.from_tables(tables, load_id, datetime(2024, 3, day))(lake)


@pytest.fixture
def labels(monkeypatch):
    """Labels of the intermediate tables that the runs write."""
    seen, real = [], daily.written
    monkeypatch.setattr(daily, "written", lambda df, label: seen.append(label) or real(df, label))
    return seen


def test_account_levels_and_join_share_one_shuffle(spark, tmp_path):
    accounts = spark.createDataFrame([("a1", "c1"), ("a2", "c1")], "account_id string, customer_id string")
    rows(spark, "t_transaction", ["1", "2"], "x").write.parquet(f"{tmp_path}/t")
    found = facts.daily_rollups(spark.read.parquet(f"{tmp_path}/t"), accounts)
    assert sorted(r.rollup_level for r in found.collect()) == [1, 2, 3, 4]
    plan = plan_of(found).split("Initial Plan")[0]
    assert not re.search(r"hashpartitioning\(date_key#\d+, account_id#\d+, \d+\)", plan)
    spread = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    # One shuffle by account; all other places that read it reuse it.
    assert sum("ReusedExchange" not in line for line in spread) == 1, spread


def test_an_aggregate_is_sorted_without_being_written(spark):
    accounts = spark.createDataFrame([("a1", "c1")], "account_id string, customer_id string")
    found = dashboard.agg_extract(facts.daily_rollups(rows(spark, "t_transaction", ["1", "2"], "x"), accounts))
    assert "unordered-" not in plan_of(found)
    assert [r.customer_id for r in found.collect()] == [None, None, "c1", "c1"]


def test_a_table_of_one_load_time_is_not_searched_for_copies(spark, tmp_path, labels):
    lake = Lake(spark, str(tmp_path))
    load(lake, "t_account", 1, [" 1", "1", "2"], "O")
    daily.cleanse_bronze(lake, "t_account")
    assert sorted(r.account_id for r in lake.read("bronze/t_account").collect()) == ["1", "1", "2"]
    assert labels == []


def test_copies_of_every_older_load_go(spark, tmp_path, labels):
    """Load 2 holds a copy that is neither the oldest nor the newest, load 3 none that is superseded."""
    lake = Lake(spark, str(tmp_path))
    for load_id, ids in ((1, ["1", "2"]), (2, ["1", "3"]), (3, ["1"])):
        load(lake, "t_account", load_id, ids, f"s{load_id}", day=load_id)
    newest = lake._state("bronze/t_account")["_load_id=3"].paths
    daily.cleanse_bronze(lake, "t_account")
    held = sorted((r.account_id, r.status) for r in lake.read("bronze/t_account").collect())
    assert held == [("1", "s3"), ("2", "s1"), ("3", "s2")]
    assert labels == ["stale-t_account"]
    assert lake._state("bronze/t_account")["_load_id=3"].paths == newest
    # A later load is met with the keys it brings.
    load(lake, "t_account", 4, ["2", "4"], "s4", day=9)
    daily.cleanse_bronze(lake, "t_account")
    held = sorted((r.account_id, r.status) for r in lake.read("bronze/t_account").collect())
    assert held == [("1", "s3"), ("2", "s4"), ("3", "s2"), ("4", "s4")]


def test_rules_count_anew_where_every_load_has_changed(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    for table in FILES:
        load(lake, table, 1, ["c1", "a1", "a1"], "x")
    daily.check_quality(lake, datetime(2024, 3, 1))
    for table in FILES:
        load(lake, table, 1, ["c1", "c1", "a1"], "y")
    monkeypatch.setattr(quality, "count_changes", None)
    daily.check_quality(lake, datetime(2024, 3, 2))
    log = lake.read("governance/data_quality_log").where(F.col("log_id") > 8)
    want = quality.failure_counts(*[lake.read(name) for name in daily.LOADED], lake.read("silver/dim_customer"))
    assert sorted((r.log_id - 8, r.records_failed) for r in log.collect()) == sorted(map(tuple, want.collect()))


def test_replaced_dates_are_not_written_twice(spark, tmp_path, monkeypatch):
    lake, name = Lake(spark, str(tmp_path)), "gold/fact_daily_agg"
    accounts = spark.createDataFrame([("a1", "c1")], "account_id string, customer_id string")
    rollups = facts.daily_rollups(rows(spark, "t_transaction", ["1"], "x"), accounts)
    lake.replace(name, rollups)
    monkeypatch.setattr("tellerlake.sources.lake.written", None)
    lake.replace_dates(name, rollups, spark.createDataFrame([(date(2024, 1, 1),)], "date_key date"))
    assert lake.read(name).count() == 4
