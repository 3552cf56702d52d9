"""SNK: each query writes lake tables and reads them back."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tellerlake.operators import dimensions as dim
from tellerlake.plans import bank
from tellerlake.plans.registry import query
from tellerlake.sources.lake import Lake
from tellerlake.sources.workspace import new_dir

_FACT = "gold/fact_daily_transaction"
_BY_DAY = """SELECT CAST(date_key AS VARCHAR) AS date_key, COUNT(*) AS row_count,
  CAST(SUM(amount) AS DOUBLE) AS total_amount"""


def _lake(spark) -> Lake:
    return Lake(spark, new_dir(spark, "lake"))


def _by_day(fact):
    return fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount").alias("total_amount")
    )


@query("snk_01", f"{_BY_DAY} FROM fact GROUP BY fact.date_key")
def append(spark, sf_dir):
    lake, fact = _lake(spark), bank.fact(spark, sf_dir)
    early = F.col("date_key") < F.lit(bank.CUTOFF)
    lake.append(_FACT, fact.where(early))
    lake.append(_FACT, fact.where(~early))
    return _by_day(lake.read(_FACT))


@query(
    "snk_02",
    """SELECT rollup_level, COUNT(*) AS row_count, CAST(SUM(total_amount) AS DOUBLE) AS total_amount
       FROM rollups GROUP BY 1""",
)
def rebuild(spark, sf_dir):
    """Loaded twice over; the second load replaces the first."""
    lake, name = _lake(spark), "gold/fact_daily_agg"
    for _ in range(2):
        lake.replace(name, bank.rollups(spark, sf_dir, by_date=True), by_date=True)
    return lake.read(name).groupBy("rollup_level").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_amount").alias("total_amount")
    )


@query(
    "snk_03",
    f"""{_BY_DAY} FROM fact
        WHERE date_key <> DATE '1998-06-14' AND (date_key <> DATE '1998-06-13' OR transaction_type = 'R')
        GROUP BY fact.date_key""",
)
def reload_dates(spark, sf_dir):
    """One date is reloaded with its returns only, the next with nothing, and comes out empty."""
    lake, fact = _lake(spark), bank.fact(spark, sf_dir)
    lake.append(_FACT, fact)
    lake.replace_date(_FACT, fact.where(F.col("transaction_type") == "R"), bank.REPORT_DAY)
    lake.replace_date(_FACT, fact.where(F.col("transaction_id").isNull()), bank.REPORT_DAY + timedelta(days=1))
    return _by_day(lake.read(_FACT))


@query(
    "snk_04",
    f"""{_BY_DAY} FROM fact WHERE date_key BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
        GROUP BY fact.date_key""",
)
def clustered_by_date(spark, sf_dir):
    """Written by date; reading a year touches that year's partitions only."""
    lake = _lake(spark)
    lake.replace(_FACT, bank.fact(spark, sf_dir))
    return _by_day(lake.read(_FACT, bank.CUTOFF, date(1998, 12, 31)))


@query(
    "snk_05",
    """SELECT account_id, customer_id, account_type, status, currency_code FROM accounts
       WHERE status <> 'P'""",
)
def update_merge_delete(spark, sf_dir):
    """A table rewritten from itself: opened, merged with the new statuses, the pending deleted."""
    lake, name = _lake(spark), "silver/dim_account"
    opened = bank.tidy(bank.account_history(spark, sf_dir), "t_account")
    lake.replace(name, opened)
    lake.replace(name, dim.upsert(lake.read(name), bank.account_increment(spark, sf_dir)))
    lake.replace(name, lake.read(name).where(F.col("status") != "P"))
    return lake.read(name)
