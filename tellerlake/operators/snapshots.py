"""Reads and accounting over append-only tables whose rows carry ``_load_id``."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_load(df: DataFrame, load_id: int) -> DataFrame:
    """The table after that load; on a table partitioned by _load_id this prunes partitions."""
    return df.where(F.col("_load_id") <= load_id)


def as_of_time(df: DataFrame, moment: datetime) -> DataFrame:
    return df.where(F.col("_loaded_at") <= F.lit(moment).cast("timestamp_ntz"))


def versions_as_of(dim: DataFrame, day: date) -> DataFrame:
    """The dimension versions that were valid on a day."""
    return dim.where(F.lit(day).between(F.col("start_date"), F.col("end_date")))


def snapshot_timeline(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows added and running total per load. The window sees one row per load."""
    added = [
        df.groupBy("_load_id").agg(F.count(F.lit(1)).alias("rows_added")).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    in_order = Window.partitionBy("table_name").orderBy("_load_id")
    running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return reduce(DataFrame.unionByName, added).select(
        "table_name",
        F.row_number().over(in_order).alias("snapshot_no"),
        F.col("_load_id").alias("load_id"),
        "rows_added",
        F.sum("rows_added").over(running).alias("cumulative_rows"),
    )


def load_label(first_load: int = 1):
    return F.when(F.col("_load_id") == first_load, "History").otherwise("Incremental")


def file_inventory(df: DataFrame, first_load: int = 1) -> DataFrame:
    """Rows and size of every data file, and whether the first load or a later one wrote it."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size_bytes"),
        load_label(first_load).alias("load_type"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


def table_overview(tables: dict[str, DataFrame], first_load: int = 1) -> DataFrame:
    """Columns, rows, first and later rows, and number of loads of each table."""
    parts = []
    for name, df in tables.items():
        n_columns = len([c for c in df.columns if not c.startswith("_load")])
        history = F.col("_load_id") == first_load
        per_load = df.groupBy("_load_id").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_load.agg(
                F.sum("n").alias("total_rows"),
                F.sum(F.when(history, F.col("n")).otherwise(0)).alias("history_rows"),
                F.sum(F.when(~history, F.col("n")).otherwise(0)).alias("incremental_rows"),
                F.count(F.lit(1)).alias("snapshots"),
            ).select(F.lit(name).alias("table_name"), F.lit(n_columns).alias("column_count"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def load_preview(df: DataFrame, load_id: int, *order: str, n: int = 5) -> DataFrame:
    return df.where(F.col("_load_id") == load_id).orderBy(*order).limit(n)
