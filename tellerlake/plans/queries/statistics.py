"""LST, SNP, RC and LOG: counts, snapshots, reconciliation and the event log."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.operators import event_log, load_stats, snapshots
from tellerlake.operators.facts import daily_rollups, transaction_fact
from tellerlake.plans import bank
from tellerlake.plans.registry import query
from tellerlake.schemas import TABLES
from tellerlake.sources.lake import Lake
from tellerlake.sources.workspace import new_dir

_COUNTED = {
    ("Bronze", "t_customer"): "raw_customers",
    ("Bronze", "t_account"): "raw_accounts",
    ("Bronze", "t_transaction"): "raw_transactions",
    ("Silver", "dim_customer"): "dim_now",
    ("Silver", "dim_account"): "accounts",
    ("Gold", "fact_daily_transaction"): "fact",
    ("Gold", "fact_daily_agg"): "rollups",
}
_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count FROM {view}"
    for (layer, name), view in _COUNTED.items()
)


@query("lst_01", _COUNTS)
def table_counts(spark, sf_dir):
    return load_stats.table_counts(
        {key: getattr(bank, view)(spark, sf_dir) for key, view in _COUNTED.items()}
    )


@query(
    "lst_02",
    f"""SELECT layer, CAST(SUM(row_count) AS BIGINT) AS row_count, COUNT(*) AS table_count
        FROM ({_COUNTS}) GROUP BY 1
        UNION ALL SELECT 'Total', CAST(SUM(row_count) AS BIGINT), COUNT(*) FROM ({_COUNTS})""",
)
def layer_totals(spark, sf_dir):
    return load_stats.layer_totals(table_counts(spark, sf_dir))


@query(
    "lst_03",
    """WITH b AS (SELECT 'Bronze' AS layer, 't_customer' AS table_name, COUNT(*) AS rows_before
                  FROM raw_customers WHERE _load_id = 1
                  UNION ALL SELECT 'Bronze', 't_account', COUNT(*) FROM raw_accounts WHERE _load_id = 1
                  UNION ALL SELECT 'Silver', 'dim_customer', COUNT(*) FROM dim_prior
                  UNION ALL SELECT 'Gold', 'fact_daily_transaction', COUNT(*) FROM fact
                    WHERE date_key < DATE '1998-01-01'),
            a AS (SELECT 'Bronze' AS layer, 't_customer' AS table_name, COUNT(*) AS rows_after FROM raw_customers
                  UNION ALL SELECT 'Bronze', 't_account', COUNT(*) FROM raw_accounts
                  UNION ALL SELECT 'Silver', 'dim_customer', COUNT(*) FROM dim_now)
       SELECT b.layer, b.table_name, rows_before, coalesce(rows_after, 0) AS rows_after,
              coalesce(rows_after, 0) - rows_before AS delta
       FROM b LEFT JOIN a ON b.layer = a.layer AND b.table_name = a.table_name""",
)
def load_deltas(spark, sf_dir):
    """Growth since the history; the fact has no count now and shows as emptied."""
    customers, accounts = bank.raw_customers(spark, sf_dir), bank.raw_accounts(spark, sf_dir)
    before = load_stats.table_counts(
        {
            ("Bronze", "t_customer"): snapshots.as_of_load(customers, 1),
            ("Bronze", "t_account"): snapshots.as_of_load(accounts, 1),
            ("Silver", "dim_customer"): bank.dim_prior(spark, sf_dir),
            ("Gold", "fact_daily_transaction"): bank.fact_before_cutoff(spark, sf_dir),
        }
    )
    after = load_stats.table_counts(
        {
            ("Bronze", "t_customer"): customers,
            ("Bronze", "t_account"): accounts,
            ("Silver", "dim_customer"): bank.dim_now(spark, sf_dir),
        }
    )
    return load_stats.load_deltas(before, after)


@query(
    "snp_01",
    """SELECT _load_id, COUNT(*) AS row_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
       FROM raw_transactions WHERE _load_id <= 1998 GROUP BY 1""",
)
def as_of_load(spark, sf_dir):
    seen = snapshots.as_of_load(bank.raw_transactions(spark, sf_dir), 1998)
    return seen.groupBy("_load_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("total_amount")
    )


def _loaded_tables(spark, sf_dir):
    return {
        "t_customer": bank.raw_customers(spark, sf_dir),
        "t_account": bank.raw_accounts(spark, sf_dir),
        "t_transaction": bank.raw_transactions(spark, sf_dir),
    }


_ADDED = "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, _load_id AS load_id, COUNT(*) AS rows_added FROM {view} GROUP BY 2"
    for table, view in (
        ("t_customer", "raw_customers"),
        ("t_account", "raw_accounts"),
        ("t_transaction", "raw_transactions"),
    )
)


@query(
    "snp_02",
    f"""SELECT table_name, row_number() OVER (PARTITION BY table_name ORDER BY load_id) AS snapshot_no, load_id,
               rows_added,
               CAST(SUM(rows_added) OVER (PARTITION BY table_name ORDER BY load_id) AS BIGINT) AS cumulative_rows
        FROM ({_ADDED})""",
)
def timeline(spark, sf_dir):
    return snapshots.snapshot_timeline(_loaded_tables(spark, sf_dir))


def _snapshot_lake(spark, sf_dir) -> Lake:
    lake = Lake(spark, new_dir(spark, "snapshots"))
    for table, df in _loaded_tables(spark, sf_dir).items():
        lake.append(f"snapshots/{table}", df)
    return lake


# File names and sizes differ from run to run; what can be checked is what each
# load's files add up to.
@query(
    "snp_03",
    """SELECT CASE WHEN _load_id = 1 THEN 'History' ELSE 'Incremental' END AS load_type,
              COUNT(*) AS row_count, 0 AS files_without_size
       FROM raw_accounts GROUP BY 1""",
)
def data_files(spark, sf_dir):
    per_file = snapshots.file_inventory(_snapshot_lake(spark, sf_dir).read("snapshots/t_account"))
    return per_file.groupBy("load_type").agg(
        F.sum("row_count").alias("row_count"),
        F.count_if(F.col("size_bytes") <= 0).alias("files_without_size"),
    )


_WIDTH = {t: len(TABLES[f"bronze/{t}"][0]) - 2 for t in ("t_customer", "t_account", "t_transaction")}


@query(
    "snp_04",
    "SELECT table_name, CASE table_name "
    + " ".join(f"WHEN '{t}' THEN {n}" for t, n in _WIDTH.items())
    + f""" END AS column_count, CAST(SUM(rows_added) AS BIGINT) AS total_rows,
          CAST(SUM(CASE WHEN load_id IN (1, 1995) THEN rows_added ELSE 0 END) AS BIGINT) AS history_rows,
          CAST(SUM(CASE WHEN load_id IN (1, 1995) THEN 0 ELSE rows_added END) AS BIGINT) AS incremental_rows,
          COUNT(*) AS snapshots
       FROM ({_ADDED}) GROUP BY 1""",
)
def overview(spark, sf_dir):
    tables = _loaded_tables(spark, sf_dir)
    yearly = {"t_transaction": tables.pop("t_transaction")}
    return snapshots.table_overview(tables).unionByName(snapshots.table_overview(yearly, first_load=1995))


@query(
    "snp_05",
    """SELECT 'loaded by 1998-06-15' AS state, COUNT(*) AS row_count FROM raw_transactions
       WHERE _loaded_at <= TIMESTAMP '1998-06-15 00:00:00'
       UNION ALL SELECT 'valid on 2023-06-01', COUNT(*) FROM dim_now
       WHERE DATE '2023-06-01' BETWEEN start_date AND end_date
       UNION ALL SELECT 'valid on 2024-06-01', COUNT(*) FROM dim_now
       WHERE DATE '2024-06-01' BETWEEN start_date AND end_date""",
)
def point_in_time(spark, sf_dir):
    dim = bank.dim_now(spark, sf_dir)
    states = {
        "loaded by 1998-06-15": snapshots.as_of_time(bank.raw_transactions(spark, sf_dir), datetime(1998, 6, 15)),
        "valid on 2023-06-01": snapshots.versions_as_of(dim, date(2023, 6, 1)),
        "valid on 2024-06-01": snapshots.versions_as_of(dim, date(2024, 6, 1)),
    }
    counts = load_stats.table_counts({("", name): df for name, df in states.items()})
    return counts.select(F.col("table_name").alias("state"), "row_count")


@query(
    "snp_05_versions",
    """SELECT 'customers' AS table_name, 1 AS version, COUNT(*) AS row_count FROM dim_prior
       UNION ALL SELECT 'customers', 2, COUNT(*) FROM dim_now
       UNION ALL SELECT 'rollups', 1, COUNT(*) FROM rollups WHERE date_key < DATE '1998-01-01'
       UNION ALL SELECT 'rollups', 2, COUNT(*) FROM rollups
       UNION ALL SELECT 'rollups', 3, COUNT(*) FROM rollups WHERE date_key <> DATE '1998-06-13'""",
)
def states_of_rewritten_tables(spark, sf_dir):
    """What the dimension and the aggregate held after each rewrite, read once all are done."""
    lake, dim, agg = Lake(spark, new_dir(spark, "versions")), "silver/dim_customer", "gold/fact_daily_agg"
    for state in (bank.dim_prior(spark, sf_dir), bank.dim_now(spark, sf_dir)):
        lake.replace(dim, state.withColumn("customer_key", F.lit(None).cast("long")))
    early, rollups = F.col("date_key") < F.lit(bank.CUTOFF), bank.rollups(spark, sf_dir)
    lake.replace(agg, rollups.where(early))
    lake.replace_dates(agg, rollups.where(~early))
    lake.replace_date(agg, rollups.limit(0), bank.REPORT_DAY)
    states = [("customers", dim, 2), ("rollups", agg, 3)]
    counts = [
        lake.read(name, as_of=version).agg(F.lit(shown).alias("table_name"), F.lit(version).alias("version"), F.count(F.lit(1)).alias("row_count"))
        for shown, name, last in states
        for version in range(1, last + 1)
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "snp_06",
    """SELECT account_id, customer_id, account_type, status FROM raw_accounts WHERE _load_id = 2
       ORDER BY account_id LIMIT 5""",
)
def preview(spark, sf_dir):
    shown = snapshots.load_preview(bank.raw_accounts(spark, sf_dir), 2, "account_id")
    return shown.select("account_id", "customer_id", "account_type", "status")


# The fact was loaded when only shipments with status F were known, so it misses the
# late O rows of its dates, and the aggregate has them.
_LOADED_FACT = """(SELECT t.transaction_date AS date_key, t.amount
  FROM transactions t JOIN accounts a ON t.account_id = a.account_id WHERE t.description = 'F')"""


def _fact_without_late_rows(spark, sf_dir):
    known = bank.transactions(spark, sf_dir).where(F.col("description") == "F")
    return transaction_fact(known, bank.accounts(spark, sf_dir))


@query(
    "rc_01",
    f"""SELECT b.n AS bronze_rows, f.n AS fact_rows, CAST(b.s AS DOUBLE) AS bronze_amount,
               CAST(f.s AS DOUBLE) AS fact_amount, b.n - f.n AS missing_rows,
               CAST(b.s - f.s AS DOUBLE) AS missing_amount
        FROM (SELECT COUNT(*) AS n, SUM(amount) AS s FROM transactions) b,
             (SELECT COUNT(*) AS n, SUM(amount) AS s FROM {_LOADED_FACT}) f""",
)
def bronze_against_fact(spark, sf_dir):
    return load_stats.layer_reconciliation(
        bank.transactions(spark, sf_dir), _fact_without_late_rows(spark, sf_dir)
    )


@query(
    "rc_02",
    f"""SELECT CAST(CAST(coalesce(f.date_key, g.date_key) AS DATE) AS VARCHAR) AS date_key,
               coalesce(f.n, 0) AS fact_rows, coalesce(g.n, 0) AS agg_rows,
               CAST(coalesce(f.s, 0) AS DOUBLE) AS fact_amount, CAST(coalesce(g.s, 0) AS DOUBLE) AS agg_amount,
               coalesce(g.n, 0) - coalesce(f.n, 0) AS late_rows,
               CAST(coalesce(g.s, 0) - coalesce(f.s, 0) AS DOUBLE) AS late_amount
        FROM (SELECT date_key, COUNT(*) AS n, SUM(amount) AS s FROM {_LOADED_FACT} GROUP BY 1) f
        FULL JOIN (SELECT date_key, CAST(SUM(transaction_count) AS BIGINT) AS n, SUM(total_amount) AS s
                   FROM rollups WHERE rollup_level = 1 GROUP BY 1) g
        ON f.date_key = g.date_key""",
)
def fact_against_rollup(spark, sf_dir):
    agg = daily_rollups(bank.transactions(spark, sf_dir), bank.accounts(spark, sf_dir), levels=(1,))
    return load_stats.fact_against_rollup(_fact_without_late_rows(spark, sf_dir), agg)


@query(
    "log_01",
    """SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_id, event_type, props, value
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS newest
             FROM events WHERE event_type <> 'error')
       WHERE newest = 1""",
)
def latest_event(spark, sf_dir):
    log = bank.table(spark, sf_dir, "events")
    return event_log.latest_entries(log, "user_id", ["ts", "event_id"], F.col("event_type") != "error")
