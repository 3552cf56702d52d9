"""Whole runs over two small deliveries with known counts."""

import gzip
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import dimensions, load_stats, quality
from tellerlake.operators.facts import daily_rollups
from tellerlake.plans import daily
from tellerlake.schemas import CUSTOMER_FILE, DIM_ACCOUNT
from tellerlake.sources.lake import Lake
from tellerlake.streaming.dimension_feed import apply_customers, follow_customers
from tellerlake.streaming.file_ingest import csv_stream, ingest

DAY1, DAY2 = date(2024, 1, 1), date(2024, 1, 2)


def customer(n, city, mail="a@b.com"):
    return f"CUST-{n:03d},F{n},L{n},{mail},416-555-0000,{city},ON,Canada,2023-01-01 00:00:00"


def account(n, status):
    return f"ACCT-{n:03d},CUST-{n % 20:03d},Savings,{status},,2023-01-01,2023-01-01 00:00:00"


def transaction(n, day):
    return f"TXN-{n:05d},ACCT-{n % 30:03d},{day} 10:00:00,{'Fee' if n % 2 else 'Cash'},{n}.25,x"


# 20 customers, then 5 of them in another city and 5 new; 30 accounts, then 4
# closed and 6 new; 100 transactions, then 30 of later dates and one late.
HISTORY = {
    "customer": [customer(n, "Toronto") for n in range(20)],
    "account": [account(n, "Active") for n in range(30)],
    "transaction": [transaction(n, f"2023-01-{n % 10 + 1:02d}") for n in range(100)],
}
INCREMENT = {
    "customer": [customer(n, "Halifax") for n in range(15, 20)] + [customer(n, "Calgary") for n in range(20, 25)],
    "account": [account(n, "Closed") for n in range(26, 36)],
    "transaction": [transaction(n, f"2023-02-{n % 5 + 1:02d}") for n in range(100, 130)]
    + [transaction(130, "2023-01-01")],
}
HEADERS = {"customer": 9, "account": 7, "transaction": 6}


def arrive(folder, name, delivery):
    for table, lines in delivery.items():
        target = folder / table
        target.mkdir(parents=True, exist_ok=True)
        header = ",".join(f"h{n}" for n in range(HEADERS[table]))
        (target / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")


def agg_rows(lines):
    """Distinct groups of the four rollups; account n belongs to customer n % 20."""
    found = set()
    for line in lines:
        _, account_id, at, kind, _, _ = line.split(",")
        customer_n = int(account_id[-3:]) % 20
        found |= {(1, at, customer_n), (2, at, account_id), (3, at, customer_n, kind), (4, at, account_id, kind)}
    return len(found)


def counts(lake):
    return {name.split("/")[1]: lake.read(name).count() for name in [*daily.LOADED, *daily.BUILT]}


@pytest.fixture(scope="module")
def loaded(spark, ticking, tmp_path_factory):
    """A lake after the history and after the increment, with the counts in between."""
    root = tmp_path_factory.mktemp("runs")
    lake = Lake(spark, f"{root}/lake")
    first, second = ticking(datetime(2024, 1, 1)), ticking(datetime(2024, 1, 2))
    arrive(root / "in", "history", HISTORY)
    steps = daily.historical_run(lake, daily.from_csv_folders(f"{root}/in", f"{root}/cp", first), DAY1, first)
    between = counts(lake)
    arrive(root / "in", "increment", INCREMENT)
    daily.incremental_run(lake, daily.from_csv_folders(f"{root}/in", f"{root}/cp", second), DAY2, second)
    return root, lake, steps.collect(), between


def test_history(loaded):
    _, _, steps, between = loaded
    assert between == {
        "t_customer": 20,
        "t_account": 30,
        "t_transaction": 100,
        "dim_customer": 20,
        "dim_account": 30,
        "dim_transaction_type": 2,
        "fact_daily_transaction": 100,
        "fact_daily_agg": agg_rows(HISTORY["transaction"]),
    }
    assert [r.step for r in steps if r.table_name == "governance/data_quality_log"] == [
        "checks after cleanse", "quality checks", "checks after load",
    ]


def test_increment(loaded):
    _, lake, _, between = loaded
    after = counts(lake)
    assert (after["t_customer"], after["t_account"], after["t_transaction"]) == (25, 36, 131)
    assert (after["dim_customer"], after["dim_account"], after["dim_transaction_type"]) == (30, 36, 2)
    assert dimensions.current_versions(lake.read("silver/dim_customer")).count() == 25
    # The late transaction is in the aggregate, not in the fact.
    assert after["fact_daily_transaction"] == 130
    assert after["fact_daily_agg"] == agg_rows(HISTORY["transaction"] + INCREMENT["transaction"])
    gap = load_stats.fact_against_rollup(
        lake.read("gold/fact_daily_transaction"), lake.read("gold/fact_daily_agg")
    ).where("late_rows <> 0")
    assert [(r.date_key, r.late_rows) for r in gap.collect()] == [(date(2023, 1, 1), 1)]
    keys = lake.read("silver/dim_customer").select("customer_key")
    assert keys.distinct().count() == 30 and keys.where("customer_key is null").count() == 0
    assert lake.read("governance/data_quality_log").count() == 48
    assert {r.currency_code for r in lake.read("silver/dim_account").select("currency_code").collect()} == {"CAD"}


def test_rollups_add_up(loaded):
    _, lake, _, _ = loaded
    totals = {
        r.rollup_level: (r.n, r.s)
        for r in lake.read("gold/fact_daily_agg")
        .groupBy("rollup_level")
        .agg(F.sum("transaction_count").alias("n"), F.sum("total_amount").alias("s"))
        .collect()
    }
    assert len(set(totals.values())) == 1 and totals[1][0] == 131


def test_running_again_changes_nothing(loaded):
    root, lake, _, _ = loaded
    before = counts(lake)
    assert ingest(lake, "bronze/t_customer", f"{root}/in/customer", f"{root}/cp/customer") == 0
    # Another progress folder knows no file, but the table does.
    assert ingest(lake, "bronze/t_customer", f"{root}/in/customer", f"{root}/cp/other") == 0
    daily.daily_run(lake, date(2024, 1, 3), lambda: datetime(2024, 1, 3))
    assert counts(lake) == before


def agg(lake, **as_of):
    return sorted(map(str, lake.read("gold/fact_daily_agg", **as_of).collect()))


def full_agg(lake):
    rows = daily_rollups(lake.read("bronze/t_transaction"), lake.read("bronze/t_account"))
    return sorted(map(str, rows.select(*lake.read("gold/fact_daily_agg").columns).collect()))


def quality_counts(lake):
    log = lake.read("governance/data_quality_log")
    last = log.agg(F.max("log_id")).first()[0]
    return {r.check_name: r.records_failed for r in log.where(F.col("log_id") > last - 8).collect()}


def full_counts(lake):
    tables = [lake.read(name) for name in [*daily.LOADED, "silver/dim_customer"]]
    names = {rule.number: rule.check for rule in quality.RULES}
    return {names[r.rule_no]: r.records_failed for r in quality.failure_counts(*tables).collect()}


def test_only_changed_dates_are_built_and_earlier_states_stay(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")

    def run(how, day):
        at = lambda: datetime(2024, 1, day)
        how(lake, daily.from_csv_folders(f"{tmp_path}/in", f"{tmp_path}/cp", at), date(2024, 1, day), at)

    arrive(tmp_path / "in", "history", HISTORY)
    run(daily.historical_run, 1)
    name = "gold/fact_daily_agg"
    first, version = agg(lake), lake.version(name)
    assert first == full_agg(lake) and quality_counts(lake) == full_counts(lake)
    january = lake._state(name)["date_part=2023-01-01"].paths
    # A newer copy of a transaction with another amount, one of a new month, an account with another owner
    # and no transactions, a malformed mail and an account without a customer.
    arrive(tmp_path / "in", "second", {
        "customer": [customer(3, "Toronto", "nowhere")],
        "account": [account(30, "Active"), "ACCT-031,CUST-777,Savings,Active,,2023-01-01,2023-01-01 00:00:00"],
        "transaction": [transaction(200, "2023-03-01"), "TXN-00201,ACCT-900,2023-03-02 10:00:00,Fee,1.00,x"],
    })
    run(daily.incremental_run, 2)
    assert lake._state(name)["date_part=2023-01-01"].paths == january
    assert agg(lake) == full_agg(lake) != first and agg(lake, as_of=version) == first
    assert quality_counts(lake) == full_counts(lake)
    assert (full_counts(lake)["FK_ACCOUNT_REF"], full_counts(lake)["FK_CUSTOMER_REF"], full_counts(lake)["EMAIL_FORMAT"]) == (1, 1, 1)
    # A moved account, a corrected transaction, the missing parents.
    arrive(tmp_path / "in", "third", {
        "customer": [customer(777, "Toronto"), customer(3, "Toronto")],
        "account": ["ACCT-001,CUST-002,Savings,Active,,2023-01-01,2023-01-01 00:00:00", account(900, "Active")],
        "transaction": ["TXN-00005,ACCT-005,2023-01-09 10:00:00,Fee,77.00,x"],
    })
    run(daily.incremental_run, 3)
    assert agg(lake) == full_agg(lake) and quality_counts(lake) == full_counts(lake)
    assert full_counts(lake)["FK_ACCOUNT_REF"] == 0 == full_counts(lake)["FK_CUSTOMER_REF"]
    # Nothing new: nothing is built.
    before = lake.version(name)
    daily.load_agg(lake)
    assert lake.version(name) == before + 1 and lake.read(name, as_of=before).exceptAll(lake.read(name)).count() == 0


def test_late_date_can_be_replaced(loaded):
    _, lake, _, _ = loaded
    daily.load_fact(lake, date(2023, 1, 1), mode="replace_dates")
    assert lake.read("gold/fact_daily_transaction").count() == 131
    daily.load_fact(lake, mode="replace_dates")
    assert lake.read("gold/fact_daily_transaction").count() == 131
    before = sorted(map(tuple, lake.read("gold/fact_daily_agg").collect()), key=str)
    daily.load_agg(lake, date(2023, 1, 1))
    assert sorted(map(tuple, lake.read("gold/fact_daily_agg").collect()), key=str) == before
    with pytest.raises(ValueError):
        daily.load_fact(lake, mode="merge")


def test_a_failing_step_is_named(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    twice = spark.createDataFrame([("A1", "C1", "t", "s", "CAD")] * 2, DIM_ACCOUNT)
    daily.from_tables({"t_account": twice}, 1, datetime(2024, 1, 1))(lake)
    with pytest.raises(daily.StepFailed, match="account merge") as failure:
        daily.daily_run(lake, DAY1)
    assert isinstance(failure.value.__cause__, dimensions.DuplicateKeyError)


def test_tables_and_files_load_alike(spark, tmp_path):
    arrive(tmp_path / "in", "history", HISTORY)
    streamed, direct = Lake(spark, f"{tmp_path}/a"), Lake(spark, f"{tmp_path}/b")
    at = datetime(2024, 1, 1)
    daily.from_csv_folders(f"{tmp_path}/in", f"{tmp_path}/cp", lambda: at)(streamed)
    tables = {t: streamed.read(f"bronze/{t}").drop("_loaded_at", "_load_id") for t in daily.DELIVERED}
    daily.from_tables(tables, 1, at)(direct)
    for name in daily.LOADED:
        assert streamed.read(name).exceptAll(direct.read(name)).count() == 0
        assert direct.read(name).exceptAll(streamed.read(name)).count() == 0


def test_one_file_per_batch_gives_one_load_each(spark, tmp_path):
    arrive(tmp_path / "in", "history", HISTORY)
    arrive(tmp_path / "in", "increment", INCREMENT)
    lake = Lake(spark, f"{tmp_path}/lake")
    n = ingest(lake, "bronze/t_customer", f"{tmp_path}/in/customer", f"{tmp_path}/cp", files_per_batch=1)
    loads = lake.read("bronze/t_customer").groupBy("_load_id").count().collect()
    assert n == 30 and sorted(r["count"] for r in loads) == [10, 20]


def test_watching_the_folders(spark, tmp_path):
    arrive(tmp_path / "in", "history", HISTORY)
    lake = Lake(spark, f"{tmp_path}/lake")
    queries = daily.watch_csv_folders(lake, f"{tmp_path}/in", f"{tmp_path}/cp", "1 second")
    try:
        for query in queries:
            query.processAllAvailable()
        assert [lake.read(name).count() for name in daily.LOADED] == [20, 30, 100]
        arrive(tmp_path / "in", "increment", INCREMENT)
        for query in queries:
            query.processAllAvailable()
        assert [lake.read(name).count() for name in daily.LOADED] == [30, 40, 131]
    finally:
        for query in queries:
            query.stop()


def test_dimension_follows_a_stream(spark, tmp_path):
    arrive(tmp_path / "in", "history", HISTORY)
    lake = Lake(spark, f"{tmp_path}/lake")

    def follow(day):
        source = csv_stream(spark, f"{tmp_path}/in/customer", CUSTOMER_FILE)
        follow_customers(lake, source, f"{tmp_path}/cp", lambda: day).awaitTermination()
        return lake.read("silver/dim_customer")

    assert follow(DAY1).count() == 20
    arrive(tmp_path / "in", "increment", INCREMENT)
    assert follow(DAY2).count() == 30
    assert follow(DAY2).count() == 30


def rows(table):
    return sorted(map(str, table.drop("_loaded_at").collect()))


def lines_of(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join("abcdefghi"), *lines]) + "\n")


def test_old_files_and_other_names_are_loaded(spark, tmp_path):
    lake, folder = Lake(spark, f"{tmp_path}/lake"), tmp_path / "in"
    lines_of(folder / "new.csv", customer(1, "Toronto"))
    assert ingest(lake, "bronze/t_customer", str(folder), f"{tmp_path}/cp") == 1
    lines_of(folder / "old.csv", customer(2, "Toronto"))
    month_ago = time.time() - 30 * 86_400
    os.utime(folder / "old.csv", (month_ago, month_ago))
    lines_of(folder / "LOUD.CSV", customer(3, "Toronto"))
    lines_of(folder / "below" / "plain.txt", customer(4, "Toronto"))
    with gzip.open(folder / "packed.csv.gz", "wt") as packed:
        packed.write("header\n" + customer(5, "Toronto") + "\n")
    assert ingest(lake, "bronze/t_customer", str(folder), f"{tmp_path}/cp") == 4
    assert lake.read("bronze/t_customer").count() == 5


def test_two_folders_and_two_progress_folders_share_a_table(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    lines_of(tmp_path / "a" / "x.csv", customer(1, "Toronto"), customer(2, "Toronto"))
    lines_of(tmp_path / "b" / "x.csv", customer(3, "Toronto"))
    assert ingest(lake, "bronze/t_customer", f"{tmp_path}/a", f"{tmp_path}/cpa") == 2
    assert ingest(lake, "bronze/t_customer", f"{tmp_path}/b", f"{tmp_path}/cpb") == 1
    assert sorted(r._load_id for r in lake.read("bronze/t_customer").collect()) == [1, 1, 2]
    one = lake.read("bronze/t_customer").limit(1)
    with pytest.raises(ValueError, match="belongs to"):
        daily.from_tables({"t_customer": one}, 1, datetime(2024, 1, 1))(lake)


def test_history_can_be_run_again(spark, tmp_path):
    arrive(tmp_path / "in", "history", HISTORY)
    lake = Lake(spark, f"{tmp_path}/lake")
    results = []
    for _ in range(2):
        load = daily.from_csv_folders(f"{tmp_path}/in", f"{tmp_path}/cp", lambda: datetime(2024, 1, 1))
        daily.historical_run(lake, load, DAY1, lambda: datetime(2024, 1, 1))
        results.append({name: rows(lake.read(name).drop("customer_key")) for name in [*daily.LOADED, *daily.BUILT]})
    assert results[0] == results[1] and len(results[0]["bronze/t_customer"]) == 20


def test_the_row_count_is_exact_however_many_batches(spark, tmp_path):
    for n in range(12):
        lines_of(tmp_path / "in" / f"{n}.csv", customer(n, "Toronto"))
    lake = Lake(spark, f"{tmp_path}/lake")
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        assert ingest(lake, "bronze/t_customer", f"{tmp_path}/in", f"{tmp_path}/cp", files_per_batch=1) == 12
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    versions = [("C1", "F", "L", "e", "p", "Old", "ON", "CA", datetime(2020, 1, 1)), ("C1", "F", "L", "e", "p", "New", "ON", "CA", datetime(2021, 1, 1))]
    batch = spark.createDataFrame(versions, CUSTOMER_FILE)
    for _ in range(2):
        apply_customers(lake, batch, 0, "stream", DAY1)
        table = lake.read("silver/dim_customer")
        assert [(r.city, r.current_flag) for r in table.collect()] == [("New", "Y")]
    apply_customers(lake, batch.where("city = 'Old'"), 1, "stream", DAY2)
    current = dimensions.current_versions(lake.read("silver/dim_customer"))
    assert [r.city for r in current.collect()] == ["Old"] and lake.read("silver/dim_customer").count() == 2


def test_deliveries_without_required_values_fail(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    bad_key = spark.createDataFrame([("A1", "C1")], "acount_id string, customer_id string")
    with pytest.raises(ValueError, match="account_id"):
        daily.from_tables({"t_account": bad_key}, 1, datetime(2024, 1, 1))(lake)
    undated = spark.createDataFrame([("T1", "A1", None)], "transaction_id string, account_id string, transaction_date timestamp_ntz")
    with pytest.raises(Exception, match="without transaction_date"):
        daily.from_tables({"t_transaction": undated}, 1, datetime(2024, 1, 1))(lake)
    assert lake.read("bronze/t_transaction").count() == 0
