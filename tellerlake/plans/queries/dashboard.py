"""ANA: what the dashboard pages show."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tellerlake.operators import dashboard as dash
from tellerlake.operators.views import monthly_spend_profile
from tellerlake.plans import bank
from tellerlake.plans.registry import query

_DAY = "CAST(date_key AS VARCHAR) AS date_key"
_MONTH = "CAST(month_key AS VARCHAR) AS month_key"
_CHOSEN = """SELECT * FROM fact
  WHERE date_key BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND transaction_type IN ('A', 'R')"""


def _chosen(spark, sf_dir):
    return dash.filter_fact(bank.fact(spark, sf_dir), ["A", "R"], date(1996, 1, 1), date(1999, 12, 31))


@query(
    "ana_01",
    f"SELECT * REPLACE ({_DAY}, CAST(amount AS DOUBLE) AS amount) FROM ({_CHOSEN})",
)
def filtered(spark, sf_dir):
    return _chosen(spark, sf_dir)


@query(
    "ana_02",
    """SELECT 'first date' AS domain, CAST(MIN(date_key) AS VARCHAR) AS value FROM fact
       UNION ALL SELECT 'last date', CAST(MAX(date_key) AS VARCHAR) FROM fact
       UNION ALL SELECT DISTINCT 'type', transaction_type FROM fact
       UNION ALL SELECT DISTINCT 'month', CAST(month_key AS VARCHAR) FROM spend""",
)
def domains(spark, sf_dir):
    fact, spend = bank.fact(spark, sf_dir), bank.spend(spark, sf_dir)
    dates = dash.date_domain(fact).select(
        F.inline(
            F.array(
                F.struct(F.lit("first date").alias("domain"), F.col("min_date").cast("string").alias("value")),
                F.struct(F.lit("last date").alias("domain"), F.col("max_date").cast("string").alias("value")),
            )
        )
    )
    types = dash.type_domain(fact).select(F.lit("type").alias("domain"), F.col("transaction_type").alias("value"))
    months = dash.month_domain(spend).select(
        F.lit("month").alias("domain"), F.col("month_key").cast("string").alias("value")
    )
    return dates.unionByName(types).unionByName(months)


@query(
    "ana_03",
    """SELECT COUNT(*) AS total_transactions, CAST(SUM(amount) AS DOUBLE) AS total_volume,
              CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_transaction,
              COUNT(DISTINCT customer_id) AS unique_customers
       FROM fact WHERE transaction_type IS NOT NULL""",
)
def kpis(spark, sf_dir):
    """As the page opens: every date and type."""
    return dash.kpis(dash.filter_fact(bank.fact(spark, sf_dir)))


@query(
    "ana_04",
    f"""SELECT {_DAY}, COUNT(transaction_id) AS transactions, CAST(SUM(amount) AS DOUBLE) AS volume
        FROM fact WHERE transaction_type IS NOT NULL GROUP BY fact.date_key""",
)
def daily_volume(spark, sf_dir):
    return dash.daily_volume(dash.filter_fact(bank.fact(spark, sf_dir)))


@query(
    "ana_05",
    "SELECT transaction_type, COUNT(transaction_id) AS transaction_count FROM fact GROUP BY 1",
)
def per_type(spark, sf_dir):
    return dash.count_by(bank.fact(spark, sf_dir), "transaction_type")


@query(
    "ana_06",
    f"SELECT {_DAY}, COUNT(transaction_id) AS transaction_count FROM fact GROUP BY fact.date_key",
)
def per_day(spark, sf_dir):
    return dash.count_by(bank.fact(spark, sf_dir), "date_key")


def _newest_spend(spark, sf_dir):
    """Spend of the newest month only; earlier transactions are not read."""
    fact, customers = bank.fact(spark, sf_dir), bank.dim_now(spark, sf_dir)
    month = dash.newest_month(fact, customers)
    return monthly_spend_profile(dash.fact_of_month(fact, month), customers)


_NEWEST = "SELECT * FROM spend WHERE month_key = (SELECT MAX(month_key) FROM spend)"


@query(
    "ana_07",
    f"""SELECT COUNT(DISTINCT customer_id) AS unique_customers, SUM(total_spend) AS total_spend,
               SUM(total_spend) / COUNT(*) AS avg_per_customer,
               SUM(total_spend) / COUNT(DISTINCT customer_id) AS avg_spend_per_distinct_customer
        FROM (SELECT customer_id, total_spend FROM ({_NEWEST}))""".replace(
        "SUM(total_spend)", "CAST(SUM(CAST(total_spend AS DECIMAL(18, 2))) AS DOUBLE)"
    ),
)
def month_kpis(spark, sf_dir):
    return dash.month_kpis(_newest_spend(spark, sf_dir))


@query(
    "ana_08",
    f"""SELECT customer_id, first_name, last_name,
               CAST(SUM(CAST(total_spend AS DECIMAL(18, 2))) AS DOUBLE) AS total_spend,
               first_name || ' ' || last_name AS customer
        FROM ({_NEWEST}) GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1 LIMIT 15""",
)
def top_spenders(spark, sf_dir):
    return dash.top_spenders(_newest_spend(spark, sf_dir))


@query(
    "ana_09",
    """SELECT customer_id, first_name, last_name, city, transaction_type, transaction_count, total_spend,
              avg_transaction
       FROM spend WHERE month_key = DATE '1998-06-01'
       ORDER BY total_spend DESC, customer_id, transaction_type""",
)
def month_detail(spark, sf_dir):
    """The month is a date range of the fact, so only its transactions are read."""
    fact = dash.fact_of_month(bank.fact(spark, sf_dir), date(1998, 6, 1))
    return dash.month_detail(monthly_spend_profile(fact, bank.dim_now(spark, sf_dir)))


@query(
    "ana_10_fact",
    f"""SELECT {_DAY}, customer_id, account_id, transaction_id, transaction_type,
               CAST(amount AS DOUBLE) AS amount
        FROM fact ORDER BY fact.date_key, transaction_id""",
)
def fact_extract(spark, sf_dir):
    return dash.fact_extract(bank.fact(spark, sf_dir))


@query("ana_10_spend", f"SELECT * REPLACE ({_MONTH}) FROM spend ORDER BY spend.month_key DESC, total_spend DESC")
def spend_extract(spark, sf_dir):
    return dash.spend_extract(bank.spend(spark, sf_dir))


@query("ana_10_trend", f"SELECT * REPLACE ({_MONTH}) FROM trend ORDER BY trend.month_key")
def trend_extract(spark, sf_dir):
    return dash.trend_extract(bank.trend(spark, sf_dir))


@query(
    "ana_10_agg",
    f"""SELECT {_DAY}, customer_id, account_id, transaction_type, CAST(total_amount AS DOUBLE) AS total_amount,
               transaction_count
        FROM rollups ORDER BY rollups.date_key DESC""",
)
def agg_extract(spark, sf_dir):
    return dash.agg_extract(bank.rollups(spark, sf_dir))


_GRAIN = """CASE rollup_level WHEN 1 THEN 'By Customer' WHEN 2 THEN 'By Account'
  WHEN 3 THEN 'By Customer + Type' ELSE 'By Account + Type' END AS grain"""


@query("ana_11", f"SELECT {_GRAIN}, rollup_level, COUNT(*) AS total_rows FROM rollups GROUP BY 1, 2")
def grains(spark, sf_dir):
    named = dash.with_grain(bank.rollups(spark, sf_dir))
    return named.groupBy("grain", "rollup_level").agg(F.count(F.lit(1)).alias("total_rows"))


@query(
    "ana_12",
    f"""SELECT {_GRAIN}, COUNT(*) AS total_rows, CAST(SUM(total_amount) AS DOUBLE) AS total_amount,
               CAST(SUM(transaction_count) AS BIGINT) AS transaction_count
        FROM rollups GROUP BY 1""",
)
def rollup_kpis(spark, sf_dir):
    return dash.rollup_kpis(dash.with_grain(bank.rollups(spark, sf_dir)), "grain")


@query(
    "ana_13",
    f"""SELECT {_GRAIN}, {_DAY}, CAST(SUM(total_amount) AS DOUBLE) AS total_amount,
               CAST(SUM(transaction_count) AS BIGINT) AS transaction_count
        FROM rollups GROUP BY rollup_level, rollups.date_key""",
)
def rollup_by_date(spark, sf_dir):
    return dash.rollup_by_date(dash.with_grain(bank.rollups(spark, sf_dir)), "grain")


@query(
    "ana_14",
    f"""SELECT {_DAY}, customer_id, transaction_type, CAST(total_amount AS DOUBLE) AS total_amount,
               transaction_count
        FROM rollups WHERE rollup_level = 3
        ORDER BY rollups.date_key DESC, customer_id, transaction_type LIMIT 100""",
)
def newest_rows(spark, sf_dir):
    view = dash.one_grain(bank.rollups(spark, sf_dir), 3)
    return dash.newest_rows(view).drop("account_id", "rollup_level")
