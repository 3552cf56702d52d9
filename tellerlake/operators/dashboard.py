"""Aggregates behind the dashboard pages.

Groups whose key is NULL are left out, as the reports have always done.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.dates import month_start
from tellerlake.functions.numbers import ratio
from tellerlake.functions.text import full_name
from tellerlake.operators.dimensions import current_versions
from tellerlake.operators.facts import GRAIN_NAMES, grain_of
from tellerlake.operators.joins import in_order


def filter_fact(
    fact: DataFrame, types: list[str] | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Date range and chosen types. No choice means every type, and still drops NULL types."""
    chosen = F.col("transaction_type")
    kept = fact.where(chosen.isNotNull() if types is None else chosen.isin(types))
    if start is not None and end is not None:
        kept = kept.where(F.col("date_key").between(F.lit(start), F.lit(end)))
    return kept


def date_domain(fact: DataFrame) -> DataFrame:
    return fact.agg(F.min("date_key").alias("min_date"), F.max("date_key").alias("max_date"))


def type_domain(fact: DataFrame) -> DataFrame:
    return fact.select("transaction_type").where(F.col("transaction_type").isNotNull()).distinct().orderBy(
        "transaction_type"
    )


def month_domain(spend: DataFrame) -> DataFrame:
    return spend.select("month_key").distinct().orderBy(F.col("month_key").desc())


def kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").alias("total_volume"),
        ratio(F.sum("amount"), F.count("amount")).alias("avg_transaction"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def daily_volume(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("date_key").isNotNull())
        .groupBy("date_key")
        .agg(F.count("transaction_id").alias("transactions"), F.sum("amount").alias("volume"))
    )


def count_by(fact: DataFrame, column: str) -> DataFrame:
    """Transactions with an id, per type or per day."""
    return (
        fact.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("transaction_id").alias("transaction_count"))
    )


def one_month(spend: DataFrame, month: date) -> DataFrame:
    return spend.where(F.col("month_key") == F.lit(month))


def newest_month(fact: DataFrame, dim_customer: DataFrame) -> date | None:
    """The month the spend page opens on: the last one in which a current customer has
    transactions. The fact is folded to one row per customer before the join, and one
    row reaches the driver."""
    last = fact.groupBy("customer_id").agg(F.max("date_key").alias("last_day"))
    held = last.join(current_versions(dim_customer).select("customer_id"), "customer_id", "left_semi")
    return held.agg(month_start(F.max("last_day")).alias("month")).first().month


def fact_of_month(fact: DataFrame, month: date) -> DataFrame:
    """The month's rows, as a plain date range that reaches the scan."""
    return fact.where(F.col("date_key").between(F.lit(month), F.last_day(F.lit(month))))


def month_kpis(spend_month: DataFrame) -> DataFrame:
    """``avg_per_customer`` is the mean over customer and type rows; the mean over
    customers is given beside it."""
    total, people = F.sum("total_spend"), F.count_distinct("customer_id")
    return spend_month.agg(
        people.alias("unique_customers"),
        total.alias("total_spend"),
        ratio(total, F.count("total_spend")).alias("avg_per_customer"),
        ratio(total, people).alias("avg_spend_per_distinct_customer"),
    )


def top_spenders(spend_month: DataFrame, n: int = 15) -> DataFrame:
    """Greatest totals; the customer id settles ties."""
    who = ["customer_id", "first_name", "last_name"]
    named = spend_month
    for column in who:
        named = named.where(F.col(column).isNotNull())
    return (
        named.groupBy(*who)
        .agg(F.coalesce(F.sum("total_spend"), F.lit(0)).alias("total_spend"))
        .orderBy(F.col("total_spend").desc(), "customer_id")
        .limit(n)
        .withColumn("customer", full_name(F.col("first_name"), F.col("last_name")))
    )


def month_detail(spend_month: DataFrame) -> DataFrame:
    return spend_month.select(
        "customer_id",
        "first_name",
        "last_name",
        "city",
        "transaction_type",
        "transaction_count",
        "total_spend",
        "avg_transaction",
    ).orderBy(F.col("total_spend").desc(), "customer_id", "transaction_type")


# Ordered extracts. The keys after the reported order settle most ties; what is
# left, equal rows above all, is spread by ``in_order``.


def fact_extract(fact: DataFrame) -> DataFrame:
    rows = fact.select("date_key", "customer_id", "account_id", "transaction_id", "transaction_type", "amount")
    return in_order(rows, "date_key", "transaction_id", "account_id")


def spend_extract(spend: DataFrame) -> DataFrame:
    return in_order(spend, F.col("month_key").desc(), F.col("total_spend").desc(), "customer_id", "transaction_type")


def trend_extract(trend: DataFrame) -> DataFrame:
    return in_order(trend, "month_key", "transaction_type")


def _agg_order() -> list:
    return [F.col("date_key").desc(), F.col("customer_id"), F.col("account_id"), F.col("transaction_type")]


def agg_extract(agg: DataFrame) -> DataFrame:
    """A rollup level has one row a key, so at most one row a level shares all sort keys: nothing is left to
    spread, and rows that come from a plan are sorted without being written first."""
    rows = agg.select("date_key", "customer_id", "account_id", "transaction_type", "total_amount", "transaction_count")
    return rows.orderBy(*_agg_order())


def with_grain(agg: DataFrame) -> DataFrame:
    return agg.withColumn("grain", grain_of())


def one_grain(agg: DataFrame, level: int) -> DataFrame:
    return agg.where(grain_of() == GRAIN_NAMES[level])


def rollup_kpis(view: DataFrame, *by: str) -> DataFrame:
    return view.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("transaction_count").alias("transaction_count"),
    )


def rollup_by_date(view: DataFrame, *by: str) -> DataFrame:
    return (
        view.where(F.col("date_key").isNotNull())
        .groupBy(*by, "date_key")
        .agg(F.sum("total_amount").alias("total_amount"), F.sum("transaction_count").alias("transaction_count"))
    )


def newest_rows(view: DataFrame, n: int = 100) -> DataFrame:
    return view.orderBy(*_agg_order()).limit(n)
