"""Latest entry per key of an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_entries(log: DataFrame, key: str, order: list[str], success: Column | None = None) -> DataFrame:
    """The newest accepted entry of each key.

    The greatest order value per key is a hash aggregate over two columns; whole
    rows are then only filtered by it. Rows that tie on one order column go on to
    the next, and rows that tie on all of them are settled by their JSON text, so
    map columns are no obstacle and the pick is repeatable.
    """
    kept = log if success is None else log.where(success)
    for column in order:
        top = kept.groupBy(F.col(key).alias("_key")).agg(F.max(column).alias("_top"))
        # The hash gives the join a shuffle of its own, which AQE may split on a hot key.
        same = F.col(key).eqNullSafe(F.col("_key")) & (F.xxhash64(key) == F.xxhash64("_key"))
        kept = kept.join(top, same & F.col(column).eqNullSafe(F.col("_top")), "left_semi")
    rest = [c for c in log.columns if c != key]
    entry = F.struct(*rest)
    picked = kept.groupBy(key).agg(F.max_by(entry, F.to_json(entry)).alias("_entry"))
    return picked.select(key, *[F.col(f"_entry.{c}").alias(c) for c in [*order, *[c for c in rest if c not in order]]])
