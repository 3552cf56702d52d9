"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def day_of_week(day: Column, base: int = 0) -> Column:
    """Sunday is ``base``; Spark's own numbering starts at 1."""
    return (F.dayofweek(day) - F.lit(1 - base)).cast("int")


def calendar_columns(day: Column, dow_base: int = 0) -> list[Column]:
    return [
        day.alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        day_of_week(day, dow_base).alias("day_of_week"),
    ]


def from_epoch_micros(micros: Column) -> Column:
    """Wall-clock time of an epoch count; independent of the session zone if that is UTC."""
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def run_stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd_HHmmss")
