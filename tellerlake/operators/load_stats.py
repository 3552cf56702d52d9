"""Row counts per table and layer, load deltas and layer reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, row_count) for each named table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for (layer, name), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def layer_totals(counts: DataFrame) -> DataFrame:
    """Rows and tables per layer, and over all under the name 'Total'."""
    return (
        counts.rollup("layer")
        .agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("table_count"), F.grouping("layer").alias("g"))
        .select(F.when(F.col("g") == 1, "Total").otherwise(F.col("layer")).alias("layer"), "row_count", "table_count")
    )


def load_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """Growth of each table of the baseline; a table without a count now has 0 rows."""
    then = before.select("layer", "table_name", F.col("row_count").alias("rows_before"))
    now = after.select("layer", "table_name", F.col("row_count").alias("rows_after"))
    joined = then.join(now, ["layer", "table_name"], "left")
    rows_after = F.coalesce(F.col("rows_after"), F.lit(0))
    return joined.select(
        "layer",
        "table_name",
        "rows_before",
        rows_after.alias("rows_after"),
        (rows_after - F.col("rows_before")).alias("delta"),
    )


def _measures(df: DataFrame, name: str, amount: str, count) -> DataFrame:
    return df.agg(count.alias("row_count"), F.sum(amount).cast("decimal(38,2)").alias("total_amount")).select(
        F.lit(name).alias("measured"), "row_count", "total_amount"
    )


def layer_reconciliation(transactions: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows and amount of bronze against the fact, with the difference."""
    rows = F.count(F.lit(1))
    both = _measures(transactions, "bronze", "amount", rows).unionByName(_measures(fact, "fact", "amount", rows))

    def pick(side: str, column: str):
        return F.coalesce(F.max(F.when(F.col("measured") == side, F.col(column))), F.lit(0))

    one = both.agg(
        pick("bronze", "row_count").alias("bronze_rows"),
        pick("fact", "row_count").alias("fact_rows"),
        pick("bronze", "total_amount").alias("bronze_amount"),
        pick("fact", "total_amount").alias("fact_amount"),
    )
    return one.withColumns(
        {
            "missing_rows": F.col("bronze_rows") - F.col("fact_rows"),
            "missing_amount": F.col("bronze_amount") - F.col("fact_amount"),
        }
    )


def fact_against_rollup(fact: DataFrame, agg: DataFrame) -> DataFrame:
    """Per date, the fact against rollup level 1. Both read the same account join, so they
    differ only where rows arrived after the fact took their date."""
    from_fact = fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("amount").alias("fact_amount")
    )
    from_agg = (
        agg.where(F.col("rollup_level") == 1)
        .groupBy("date_key")
        .agg(F.sum("transaction_count").alias("agg_rows"), F.sum("total_amount").alias("agg_amount"))
    )
    zero = F.lit(0)
    filled = from_fact.join(from_agg, "date_key", "full").select(
        "date_key",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("fact_rows", "agg_rows", "fact_amount", "agg_amount")],
    )
    return filled.withColumns(
        {
            "late_rows": F.col("agg_rows") - F.col("fact_rows"),
            "late_amount": F.col("agg_amount") - F.col("fact_amount"),
        }
    )
