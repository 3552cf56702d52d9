"""Gold views over the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.dates import month_start
from tellerlake.functions.numbers import ratio
from tellerlake.operators.dimensions import current_versions

_PROFILE = ["customer_id", "first_name", "last_name", "city", "state_province"]


def monthly_spend_profile(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Spend per current customer, month and type, history included under today's attributes.

    The fact is folded to customer+month+type before the join: a join keyed on
    the group's own key cannot be split by AQE, and folded, a hot customer is a
    handful of rows.
    """
    folded = (
        fact.groupBy("customer_id", "transaction_type", month_start(F.col("date_key")).alias("month_key"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("amount").alias("n_amounts"),
            F.sum("amount").alias("total"),
            F.min("amount").alias("low"),
            F.max("amount").alias("high"),
        )
    )
    people = current_versions(dim_customer).select(*_PROFILE)
    return (
        folded.join(people, "customer_id")
        .groupBy(*_PROFILE, "transaction_type", "month_key")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("total").alias("total_spend"),
            ratio(F.sum("total"), F.sum("n_amounts")).alias("avg_transaction"),
            F.min("low").alias("min_transaction"),
            F.max("high").alias("max_transaction"),
        )
    )


def type_trend(fact: DataFrame) -> DataFrame:
    """Month by type, with exact distinct customers and accounts.

    Folded to one row per account, month and type first: counting two distinct
    columns copies its input once per column, and the folded input is far
    smaller. Spark then spreads each month's distinct values over the cluster
    before it counts them, so one huge month is not one task.
    """
    folded = fact.groupBy(
        "transaction_type", month_start(F.col("date_key")).alias("month_key"), "customer_id", "account_id"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("amount").alias("n_amounts"),
        F.sum("amount").alias("total"),
    )
    customers = F.count_distinct("customer_id")
    return folded.groupBy("transaction_type", "month_key").agg(
        F.sum("n").alias("transaction_count"),
        F.sum("total").alias("total_amount"),
        ratio(F.sum("total"), F.sum("n_amounts")).alias("avg_amount"),
        customers.alias("unique_customers"),
        F.count_distinct("account_id").alias("unique_accounts"),
        ratio(F.sum("total"), customers).alias("avg_spend_per_customer"),
    )
