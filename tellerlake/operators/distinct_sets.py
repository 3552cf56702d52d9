"""Exact distinct counts that add up: sets of dense numbers as bitmaps.

A distinct count cannot be added to another one, so a view over all history has
to read all history again. A set can: every value gets a number once, a month's
values become bitmaps of these numbers, 32,768 to a bitmap, and the bitmaps of
several months or loads are merged by OR. Numbers are dense within the task that
gave them, so bitmaps are well filled; nothing is estimated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.dates import month_start
from tellerlake.functions.numbers import ratio
from tellerlake.operators.joins import on_hot_key

#: Columns whose distinct values are counted, by the kind of value they hold.
KINDS = {"customer": "customer_id", "account": "account_id"}
GROUP = ["month_key", "transaction_type"]


def new_numbers(held: DataFrame, fact: DataFrame) -> DataFrame:
    """(kind, value, number) of the values of ``fact`` that ``held`` has not numbered.

    Write the result before it is read twice: a plan that is run again may number otherwise.
    """
    highest = held.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    seen = reduce(
        DataFrame.unionByName,
        [fact.select(F.lit(kind).alias("kind"), F.col(column).alias("value")) for kind, column in KINDS.items()],
    )
    fresh = seen.where("value IS NOT NULL").distinct().join(held, ["kind", "value"], "left_anti")
    return fresh.withColumn("number", F.monotonically_increasing_id() + highest + 1)


def counts_of(fact: DataFrame) -> DataFrame:
    """What adds up anyway: rows, amounts and their sum by month and type."""
    return fact.groupBy(month_start(F.col("date_key")).alias("month_key"), "transaction_type").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count("amount").alias("amount_count"),
        F.sum("amount").cast("decimal(38,2)").alias("total_amount"),
    )


def sets_of(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """(month_key, transaction_type, kind, bucket, bits): the values of each month and type.

    The fact is folded to distinct values before it meets the numbers, so a hot
    customer is a row a month and type.
    """
    parts = []
    for kind, column in KINDS.items():
        found = fact.where(F.col(column).isNotNull()).select(
            month_start(F.col("date_key")).alias("month_key"), "transaction_type", F.col(column).alias("found")
        )
        own = numbers.where(F.col("kind") == kind).select("kind", F.col("value").alias("own"), "number")
        parts.append(found.distinct().join(own, on_hot_key("found", "own")))
    numbered = reduce(DataFrame.unionByName, parts)
    return numbered.groupBy(*GROUP, "kind", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def merged_counts(*parts: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast(kind).alias(c) for c, kind in (("transaction_count", "bigint"), ("amount_count", "bigint"), ("total_amount", "decimal(38,2)"))]
    return reduce(DataFrame.unionByName, parts).groupBy(*GROUP).agg(*sums)


def merged_sets(sets: DataFrame, *by: str) -> DataFrame:
    """Sets over fewer columns, such as all months of a type; ``by`` are those that stay."""
    return sets.groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def sizes(sets: DataFrame, *by: str) -> DataFrame:
    """The number of distinct values of each kind, a column a kind."""
    columns = [
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0)).alias(f"unique_{kind}s")
        for kind in KINDS
    ]
    return merged_sets(sets, *by).groupBy(*by).agg(*columns)


def trend(counts: DataFrame, sets: DataFrame) -> DataFrame:
    """The monthly trend by type, from kept counts and sets."""
    found = sizes(sets, *GROUP).withColumnsRenamed({c: f"_{c}" for c in GROUP})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in GROUP])
    rows = counts.join(found, same, "left")
    customers = F.coalesce("unique_customers", F.lit(0))
    return rows.select(
        "transaction_type",
        "month_key",
        "transaction_count",
        "total_amount",
        ratio(F.col("total_amount"), F.col("amount_count")).alias("avg_amount"),
        customers.alias("unique_customers"),
        F.coalesce("unique_accounts", F.lit(0)).alias("unique_accounts"),
        ratio(F.col("total_amount"), customers).alias("avg_spend_per_customer"),
    )


def totals(counts: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows, sum, average and distinct customers over all that was kept, in one row."""
    sums = counts.select("transaction_count", "amount_count", "total_amount", F.lit(0).alias("unique_customers"))
    found = sizes(sets).select("unique_customers")
    every = sums.unionByName(found, allowMissingColumns=True)
    return every.agg(
        F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("total_transactions"),
        F.sum("total_amount").alias("total_volume"),
        ratio(F.sum("total_amount"), F.sum("amount_count")).alias("avg_transaction"),
        F.sum("unique_customers").alias("unique_customers"),
    )
