from collections import defaultdict
from contextlib import contextmanager
from datetime import date, datetime
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import cleanse, dashboard, dimensions, distinct_sets, facts, load_stats, views
from tellerlake.operators.joins import in_order
from tellerlake.plans import daily
from tellerlake.schemas import FACT_TRANSACTION, TRACKED, TRANSACTION_FILE
from tellerlake.sources.lake import Lake

ACCOUNTS = "account_id string, customer_id string"


def transactions(spark, *rows):
    """Rows of (id, account, day, type, amount)."""
    full = [(i, a, datetime(2024, 1, d, 9, 30), t, None if m is None else Decimal(m), None) for i, a, d, t, m in rows]
    return spark.createDataFrame(full, TRANSACTION_FILE)


@pytest.fixture
def small(spark):
    txn = transactions(
        spark,
        ("t1", "a1", 1, "Cash", "10.00"),
        ("t2", "a1", 1, "Cash", None),
        ("t3", "a1", 1, None, "5.50"),
        ("t4", "orphan", 1, "Cash", "1.00"),
        ("t5", "a2", 2, "Fee", "2.25"),
        ("t6", "twice", 2, "Fee", "3.00"),
    )
    acct = spark.createDataFrame(
        [("a1", "c1"), ("a2", "c1"), ("twice", "c2"), ("twice", "c3")], ACCOUNTS
    )
    return txn, acct


def test_fact_drops_orphans_and_fans_out(small):
    rows = facts.transaction_fact(*small).collect()
    assert sorted((r.transaction_id, r.customer_id) for r in rows) == [
        ("t1", "c1"), ("t2", "c1"), ("t3", "c1"), ("t5", "c1"), ("t6", "c2"), ("t6", "c3"),
    ]


def test_fact_of_one_date(small):
    rows = facts.transaction_fact(*small, report_date=date(2024, 1, 2)).collect()
    assert {r.transaction_id for r in rows} == {"t5", "t6"}


def test_late_rows_of_a_loaded_date_are_skipped(spark, small):
    txn, acct = small
    loaded = facts.transaction_fact(txn.where("transaction_id = 't1'"), acct)
    rows = facts.transaction_fact(txn, acct, already_loaded=loaded).collect()
    assert {r.transaction_id for r in rows} == {"t5", "t6"}
    everything = facts.transaction_fact(txn, acct)
    assert facts.transaction_fact(txn, acct, already_loaded=everything).count() == 0


def brute_rollups(txn, acct):
    owners = defaultdict(list)
    for a, c in acct:
        owners[a].append(c)
    out = defaultdict(lambda: [None, 0])

    def add(key, amount):
        if amount is not None:
            out[key][0] = (out[key][0] or Decimal(0)) + amount
        out[key][1] += 1

    for _, a, day, kind, amount in txn:
        add((2, day, None, a, None), amount)
        add((4, day, None, a, kind), amount)
        for c in owners[a]:
            add((1, day, c, None, None), amount)
            add((3, day, c, None, kind), amount)
    return {key: tuple(value) for key, value in out.items()}


def test_rollups_against_brute_force(spark):
    rng = Random(3)
    acct = [(f"a{n}", f"c{n % 4}") for n in range(8)] + [("a0", "c9"), ("hot", "c1")]
    txn = [
        (f"t{n}", "hot" if rng.random() < 0.34 else rng.choice(["a0", "a1", "a5", "orphan", None]),
         rng.randint(1, 4), rng.choice(["Cash", "Fee", None]),
         rng.choice([None, Decimal(rng.randint(1, 9999)) / 100]))
        for n in range(200)
    ]
    got = facts.daily_rollups(
        transactions(spark, *[(i, a, d, t, m) for i, a, d, t, m in txn]), spark.createDataFrame(acct, ACCOUNTS)
    ).collect()
    assert {
        (r.rollup_level, r.date_key.day, r.customer_id, r.account_id, r.transaction_type):
        (r.total_amount, r.transaction_count) for r in got
    } == brute_rollups(txn, acct)
    assert len(got) == len(brute_rollups(txn, acct))


def test_customer_levels_agree(small):
    rows = facts.daily_rollups(*small)
    one = rows.where("rollup_level = 1").groupBy("date_key", "customer_id").agg(F.sum("total_amount").alias("s"))
    three = rows.where("rollup_level = 3").groupBy("date_key", "customer_id").agg(F.sum("total_amount").alias("s"))
    assert sorted(one.collect()) == sorted(three.collect())


def test_raw_transactions_are_scanned_and_shuffled_once(spark, tmp_path, small):
    txn, acct = small
    txn.write.parquet(f"{tmp_path}/t")
    acct.write.parquet(f"{tmp_path}/a")
    rows = facts.daily_rollups(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/a"))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    # Transactions once, accounts once; the scan for a NULL account finds nothing and is gone.
    assert len(scans) == 2, scans
    assert "ReusedExchange" in plan


def test_a_null_type_reads_as_a_coarser_grain(small):
    rows = dashboard.with_grain(facts.daily_rollups(*small))
    names = {(r.rollup_level, r.grain) for r in rows.collect()}
    assert (3, "By Customer + Type") in names and (3, "By Customer") in names


def test_spend_profile_uses_current_attributes_only(spark, small):
    fact = facts.transaction_fact(*small)
    dim = spark.createDataFrame(
        [
            ("c1", "Ann", "Lee", "Rome", "RM", "Y"),
            ("c1", "Ann", "Lee", "Oslo", "OS", "N"),
            ("c2", "Bob", None, None, None, "N"),
        ],
        "customer_id string, first_name string, last_name string, city string, state_province string, "
        "current_flag string",
    )
    rows = {r.transaction_type: r for r in views.monthly_spend_profile(fact, dim).collect()}
    assert set(rows) == {"Cash", None, "Fee"}
    cash = rows["Cash"]
    assert (cash.city, cash.transaction_count, cash.total_spend) == ("Rome", 2, Decimal("10.00"))
    # The NULL amount counts as a transaction but not in the average.
    assert cash.avg_transaction == 10.0
    assert cash.month_key == date(2024, 1, 1)


def test_two_equal_current_versions_double_the_spend(spark, small):
    """As the join does; the quality rules report such customers."""
    fact = facts.transaction_fact(*small)
    dim = spark.createDataFrame(
        [("c1", "Ann", "Lee", "Rome", "RM", "Y")] * 2,
        "customer_id string, first_name string, last_name string, city string, state_province string, "
        "current_flag string",
    )
    rows = {r.transaction_type: r for r in views.monthly_spend_profile(fact, dim).collect()}
    assert (rows["Cash"].transaction_count, rows["Cash"].total_spend) == (4, Decimal("20.00"))


def test_type_trend(small):
    rows = {r.transaction_type: r for r in views.type_trend(facts.transaction_fact(*small)).collect()}
    fee = rows["Fee"]
    assert (fee.transaction_count, fee.total_amount) == (3, Decimal("8.25"))
    assert (fee.unique_customers, fee.unique_accounts) == (3, 2)
    assert fee.avg_amount == 2.75 and fee.avg_spend_per_customer == 2.75


def test_dashboard_leaves_out_null_types_and_breaks_ties(spark, small):
    fact = facts.transaction_fact(*small)
    assert dashboard.filter_fact(fact).where("transaction_type is null").count() == 0
    assert {r.transaction_type for r in dashboard.count_by(fact, "transaction_type").collect()} == {"Cash", "Fee"}
    assert dashboard.filter_fact(fact, ["Fee"], date(2024, 1, 1), date(2024, 1, 1)).count() == 0
    spend = spark.createDataFrame(
        [(f"c{n:02d}", "f", "l" if n else None, date(2024, 1, 1), "Fee", Decimal("1.00")) for n in range(18)],
        "customer_id string, first_name string, last_name string, month_key date, transaction_type string, "
        "total_spend decimal(18,2)",
    )
    top = [r.customer_id for r in dashboard.top_spenders(spend).collect()]
    # Equal spend at the cut: smallest ids win; the customer without a name is left out.
    assert top == [f"c{n:02d}" for n in range(1, 16)]


def test_month_averages(spark):
    spend = spark.createDataFrame(
        [("c1", date(2024, 1, 1), "Fee", Decimal("1.00")), ("c1", date(2024, 1, 1), "Cash", Decimal("2.00")),
         ("c2", date(2024, 1, 1), "Fee", Decimal("3.00")), ("c9", date(2023, 1, 1), "Fee", Decimal("9.00"))],
        "customer_id string, month_key date, transaction_type string, total_spend decimal(18,2)",
    )
    row = dashboard.month_kpis(dashboard.one_month(spend, date(2024, 1, 1))).first()
    assert (row.unique_customers, row.total_spend) == (2, Decimal("6.00"))
    assert (row.avg_per_customer, row.avg_spend_per_distinct_customer) == (2.0, 3.0)


def test_newest_month_needs_a_current_customer(spark, small):
    fact = facts.transaction_fact(*small)
    later = transactions(spark, ("t9", "a3", 3, "Fee", "1.00")).withColumn(
        "transaction_date", F.lit("2024-05-31 23:00:00").cast("timestamp_ntz")
    )
    owner = spark.createDataFrame([("a3", "gone")], ACCOUNTS)
    fact = fact.unionByName(facts.transaction_fact(later, owner))
    dim = spark.createDataFrame([("c1", "Y"), ("gone", "N")], "customer_id string, current_flag string")
    assert dashboard.newest_month(fact, dim) == date(2024, 1, 1)
    assert dashboard.fact_of_month(fact, date(2024, 5, 1)).count() == 1
    assert dashboard.newest_month(fact.limit(0), dim) is None


def test_reconciliation_shows_late_rows(spark, small):
    txn, acct = small
    fact = facts.transaction_fact(txn.where("transaction_id <> 't3'"), acct)
    agg = facts.daily_rollups(txn, acct)
    rows = {r.date_key.day: r for r in load_stats.fact_against_rollup(fact, agg).collect()}
    assert (rows[1].late_rows, rows[1].late_amount) == (1, Decimal("5.50"))
    assert (rows[2].late_rows, rows[2].late_amount) == (0, Decimal("0.00"))


@contextmanager
def settings(spark, **values):
    names = {key: f"spark.sql.{key.replace('__', '.')}" for key in values}
    before = {name: spark.conf.get(name, None) for name in names.values()}
    for key, value in values.items():
        spark.conf.set(names[key], value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# Sizes that make a few megabytes look like a cluster's hot partition.
TIGHT = {
    "autoBroadcastJoinThreshold": "-1",
    "adaptive__autoBroadcastJoinThreshold": "-1",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "adaptive__advisoryPartitionSizeInBytes": "64k",
    "shuffle__partitions": "16",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """120,000 transactions, a third of them of one account, in two loads."""
    path = f"{tmp_path_factory.mktemp('hot')}/t"
    account = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (F.col("id") % 5000).cast("string")))
    loaded = F.when(F.col("id") % 2 == 0, "2024-01-01 00:00:00").otherwise("2024-01-02 00:00:00")
    rows = spark.range(120_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        account.alias("account_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("transaction_date"),
        F.lit("Fee").alias("transaction_type"),
        F.lit("1.00").cast("decimal(18,2)").alias("amount"),
        F.lit("d").alias("description"),
        loaded.cast("timestamp_ntz").alias("_loaded_at"),
    )
    rows.repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_account_is_split_in_the_fact_join(spark, tmp_path, hot):
    hot.select("account_id").distinct().withColumn("customer_id", F.lit("c")).write.parquet(f"{tmp_path}/a")
    with settings(spark, **TIGHT):
        fact = facts.transaction_fact(hot, spark.read.parquet(f"{tmp_path}/a"))
        assert len(fact.collect()) == 120_000
        assert "SortMergeJoin(skew=true)" in final_plan(fact)
        # Also where a grouping that includes the account follows the join.
        trend = views.type_trend(fact)
        assert [r.transaction_count for r in trend.collect()] == [120_000]
        assert "SortMergeJoin(skew=true)" in final_plan(trend)


def test_hot_customer_is_split_in_the_version_joins(spark, tmp_path, hot):
    source = hot.select(
        F.col("account_id").alias("customer_id"),
        *[F.lit("x").alias(c) for c in TRACKED if c != "city"],
        F.col("transaction_id").alias("city"),
    )
    held = source.groupBy("customer_id").agg(*[F.max(c).alias(c) for c in TRACKED])
    held.withColumns({"current_flag": F.lit("Y")}).write.parquet(f"{tmp_path}/d")
    dim = spark.read.parquet(f"{tmp_path}/d")
    with settings(spark, **TIGHT):
        outdated = dimensions.outdated_versions(dim, source)
        n = len(outdated.collect())
        assert n == source.groupBy("customer_id").count().where("count > 1").count()
        assert "SortMergeJoin(skew=true)" in final_plan(outdated)
        fresh = dimensions.new_versions(dim.where("customer_id <> 'hot'"), source, date(2024, 1, 1))
        assert len(fresh.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in final_plan(fresh)


def test_hot_key_is_split_in_the_dedupe_join(spark, hot):
    with settings(spark, **TIGHT):
        kept = cleanse.keep_latest(hot, "account_id")
        newest = {}
        rows = [(r.account_id, r._loaded_at) for r in hot.select("account_id", "_loaded_at").collect()]
        for key, at in rows:
            newest[key] = max(newest.get(key, at), at)
        assert len(kept.collect()) == sum(at == newest[key] for key, at in rows)
        assert "SortMergeJoin(skew=true)" in final_plan(kept)


def test_equal_sort_keys_are_split_over_partitions(spark, tmp_path):
    """A third of the rows are equal in every column, another third in the keys."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("k"),
        F.when(F.col("id") % 3 == 1, F.col("id")).otherwise(0).alias("v"),
    )
    rows.repartition(6).write.parquet(f"{tmp_path}/t")
    with settings(spark, shuffle__partitions="8", adaptive__coalescePartitions__enabled="false"):
        for table in (spark.read.parquet(f"{tmp_path}/t"), rows.groupBy("k", "v").count().drop("count").union(rows)):
            ordered = in_order(table, F.col("k").desc())
            assert ordered.columns == table.columns
            parts = ordered.withColumn("p", F.spark_partition_id()).groupBy("p")
            parts = sorted(parts.agg(F.count("*").alias("n"), F.max("k").alias("high"), F.min("k").alias("low")).collect())
            assert len(parts) == 8 and max(r.n for r in parts) < 2 * table.count() / 8
            assert all(a.low >= b.high for a, b in zip(parts, parts[1:]))
            assert sorted(map(tuple, ordered.collect())) == sorted(map(tuple, table.collect()))


def test_kept_sets_give_the_trend_of_the_whole_fact(spark, tmp_path):
    """Parts arrive, a date is replaced, one is emptied; months in which nothing changed are not touched."""
    rng, lake, name = Random(3), Lake(spark, str(tmp_path)), "gold/fact_daily_transaction"

    def part(month, days, n):
        rows = [(rng.choice(["c1", "c2", "c3", None]), f"a{rng.randrange(9)}", f"t{k}", rng.choice(["Fee", "Cash", None]),
                 rng.choice([None, Decimal("2.50"), Decimal("1.00")]), date(2024, month, rng.choice(days))) for k in range(n)]
        return spark.createDataFrame(rows, FACT_TRANSACTION)

    def agrees():
        views.type_trend(lake.read(name)).createOrReplaceTempView("whole")
        daily.load_trend(lake)
        got = distinct_sets.trend(*daily.kept_trend(lake))
        want = spark.table("whole").select(*got.columns)
        show = lambda df: sorted(str([float(x) if isinstance(x, Decimal) else x for x in r]) for r in df.collect())
        assert show(got) == show(want)
        one = distinct_sets.totals(*daily.kept_trend(lake)).first()
        assert one.unique_customers == lake.read(name).agg(F.count_distinct("customer_id")).first()[0]
        return lake._state("gold/trend_sets")

    lake.append(name, part(1, [1, 2], 40).union(part(2, [1, 5], 30)))
    first = agrees()["date_part=2024-01-01"].paths
    lake.append(name, part(2, [7], 20).union(part(3, [1], 5)))
    assert agrees()["date_part=2024-01-01"].paths == first
    lake.replace_date(name, part(2, [7], 3), date(2024, 2, 7))
    lake.replace_date(name, part(3, [1], 0), date(2024, 3, 1))
    state = agrees()
    assert state["date_part=2024-01-01"].paths == first and state["date_part=2024-03-01"].paths == []
    numbers = lake.read("gold/value_numbers")
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("kind", "value").distinct().count()
