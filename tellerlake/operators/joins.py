"""Helpers for keys that may be hot, in joins and sorts, and for tables that are written before they are used twice."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.sources.workspace import scratch_dir, shuffles_removed


def on_hot_key(left: str, right: str) -> Column:
    """Equality of two columns, for a join whose left side may hold many rows of one key.

    The hashes add nothing to the result. AQE splits a hot key only where both
    sides were shuffled for this very join and no later step counts on its
    partitioning. A plain key often breaks that, as a grouping by the same key
    before or after the join shares the shuffle. With the hash as another key the
    join has its own shuffle, and a grouping after it combines before its own.
    The hash comes first: the sort before a merge join then compares eight bytes
    that differ, where ids begin alike and would be compared in full.
    """
    a, b = F.col(left), F.col(right)
    return (F.xxhash64(a) == F.xxhash64(b)) & (a == b)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    What reads it twice computes it once, lineage ends there, and Catalyst knows
    its size in bytes when it plans a join with it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: What the analyser says of rows that do not come from one table of files.
NO_PLACE = ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "AMBIGUOUS_REFERENCE", "FIELD_NOT_FOUND")


def in_order(df: DataFrame, *keys: Column | str) -> DataFrame:
    """``df`` sorted by ``keys`` over all its partitions, rows with equal keys over as many as their number asks for.

    A sort cuts its range where a key changes, so however many rows share one
    key would be one task. Here the place of a row in its file comes after the
    keys: it is part of what was written, so a task that is run again cuts where
    the first one did. A table read from files is sorted as it stands, anything
    else is written first.
    """
    try:
        located = df.select("*", _place().alias("_place"))
    except AnalysisException as error:
        if error.getCondition() not in NO_PLACE:
            raise
        located = written(df, "unordered").select("*", _place().alias("_place"))
    return located.orderBy(*keys, "_place").drop("_place")


def _place() -> Column:
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")
