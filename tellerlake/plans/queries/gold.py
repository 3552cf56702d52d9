"""FCT and VW: facts, rollups and the views over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellerlake.operators import distinct_sets, facts
from tellerlake.plans import bank
from tellerlake.plans.daily import kept_trend, load_trend
from tellerlake.plans.registry import query
from tellerlake.sources.lake import Lake
from tellerlake.sources.workspace import new_dir

_FACT = """CAST(date_key AS VARCHAR) AS date_key, customer_id, account_id, transaction_id, transaction_type,
  CAST(amount AS DOUBLE) AS amount"""
_AGG = """CAST(date_key AS VARCHAR) AS date_key, customer_id, account_id, transaction_type,
  CAST(total_amount AS DOUBLE) AS total_amount, transaction_count, rollup_level"""


@query("fct_01", f"SELECT {_FACT} FROM fact")
def fact(spark, sf_dir):
    return bank.fact(spark, sf_dir)


@query("fct_02", f"SELECT {_FACT} FROM fact WHERE date_key = DATE '1998-06-13'")
def fact_of_day(spark, sf_dir):
    return facts.transaction_fact(
        bank.transactions(spark, sf_dir), bank.accounts(spark, sf_dir), bank.REPORT_DAY
    )


@query(
    "fct_03",
    f"""SELECT {_FACT} FROM fact
        WHERE date_key NOT IN (SELECT DISTINCT date_key FROM fact WHERE date_key < DATE '1998-01-01')""",
)
def fact_of_new_dates(spark, sf_dir):
    return facts.transaction_fact(
        bank.transactions(spark, sf_dir),
        bank.accounts(spark, sf_dir),
        already_loaded=bank.fact_before_cutoff(spark, sf_dir),
    )


def _level(level: int):
    def build(spark, sf_dir):
        return facts.daily_rollups(
            bank.transactions(spark, sf_dir), bank.accounts(spark, sf_dir), levels=(level,)
        )

    return build


for _number in facts.GRAINS:
    query(f"fct_0{3 + _number}", f"SELECT {_AGG} FROM rollups WHERE rollup_level = {_number}")(_level(_number))


@query("fct_08", f"SELECT {_AGG} FROM rollups")
def rollups(spark, sf_dir):
    return bank.rollups(spark, sf_dir)


@query("fct_09", f"SELECT {_AGG} FROM rollups WHERE date_key = DATE '1998-06-13'")
def rollups_of_day(spark, sf_dir):
    return facts.daily_rollups(
        bank.transactions(spark, sf_dir), bank.accounts(spark, sf_dir), bank.REPORT_DAY
    )


@query("vw_01", "SELECT * REPLACE (CAST(month_key AS VARCHAR) AS month_key) FROM spend")
def monthly_spend(spark, sf_dir):
    return bank.spend(spark, sf_dir)


@query("vw_02", "SELECT * REPLACE (CAST(month_key AS VARCHAR) AS month_key) FROM trend")
def type_trend(spark, sf_dir):
    return bank.trend(spark, sf_dir)


def _kept_trend(spark, sf_dir):
    """The fact comes in two deliveries that share a month; the second changes its partitions only."""
    lake, fact = Lake(spark, new_dir(spark, "trend")), bank.fact(spark, sf_dir)
    early = F.col("date_key") < F.lit(bank.REPORT_DAY)
    for part in (fact.where(early), fact.where(~early)):
        lake.append("gold/fact_daily_transaction", part)
        load_trend(lake)
    return kept_trend(lake)


@query("vw_02_kept", "SELECT * REPLACE (CAST(month_key AS VARCHAR) AS month_key) FROM trend")
def kept_type_trend(spark, sf_dir):
    return distinct_sets.trend(*_kept_trend(spark, sf_dir))


@query(
    "ana_03_kept",
    """SELECT COUNT(*) AS total_transactions, CAST(SUM(amount) AS DOUBLE) AS total_volume,
              CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_transaction,
              COUNT(DISTINCT customer_id) AS unique_customers
       FROM fact WHERE transaction_type IS NOT NULL""",
)
def kept_kpis(spark, sf_dir):
    """Distinct customers of all months, from the sets of each."""
    counts, sets = (df.where("transaction_type IS NOT NULL") for df in _kept_trend(spark, sf_dir))
    return distinct_sets.totals(counts, sets)
