"""Slowly changing dimensions, code lookups and the calendar."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerlake.functions.dates import calendar_columns
from tellerlake.operators.joins import on_hot_key, written
from tellerlake.schemas import OPEN_END, TRACKED


def is_current() -> Column:
    return F.col("current_flag") == F.lit("Y")


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(is_current())


def _differs(left: str, right: str, null_safe: bool) -> Column:
    a, b = F.col(left), F.col(right)
    # Plain <> is NULL when either side is, so NULL <-> value is no change by default.
    return ~a.eqNullSafe(b) if null_safe else a != b


def outdated_versions(
    dim: DataFrame,
    source: DataFrame,
    key: str = "customer_id",
    tracked: list[str] = TRACKED,
    null_safe: bool = False,
) -> DataFrame:
    """Distinct (key, attributes) of the current versions some source row contradicts.

    The source is the left side: a heavily copied source key can then be split
    by AQE, and the distinct combines its copies map-side.
    """
    held = current_versions(dim).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in tracked]
    )
    changed = reduce(lambda a, b: a | b, [_differs(c, f"_old_{c}", null_safe) for c in tracked])
    return (
        source.select(key, *tracked)
        .join(held, on_hot_key(key, "_key"))
        .where(changed)
        .select("_key", *[f"_old_{c}" for c in tracked])
        .distinct()
    )


def _same_version(key: str, tracked: list[str]) -> Column:
    """A version equals one of ``outdated_versions``."""
    return reduce(
        lambda a, b: a & b,
        [F.col(key) == F.col("_key"), *[F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in tracked]],
    )


def close_versions(
    dim: DataFrame,
    source: DataFrame,
    as_of: date,
    key: str = "customer_id",
    tracked: list[str] = TRACKED,
    null_safe: bool = False,
    outdated: DataFrame | None = None,
) -> DataFrame:
    """Expire contradicted current versions the day before ``as_of``; other rows pass through."""
    if outdated is None:
        outdated = outdated_versions(dim, source, key, tracked, null_safe)
    closes = is_current() & F.col("_key").isNotNull()
    joined = dim.join(outdated, _same_version(key, tracked), "left")
    return joined.select(
        *[
            F.when(closes, F.date_sub(F.lit(as_of), 1)).otherwise(F.col(c)).alias(c)
            if c == "end_date"
            else F.when(closes, F.lit("N")).otherwise(F.col(c)).alias(c)
            if c == "current_flag"
            else F.col(c)
            for c in dim.columns
        ]
    )


def new_versions(
    dim: DataFrame,
    source: DataFrame,
    as_of: date,
    key: str = "customer_id",
    tracked: list[str] = TRACKED,
) -> DataFrame:
    """Source rows without a current version in an already closed ``dim``; copies all enter."""
    return _inserted(current_versions(dim).select(F.col(key).alias("_held")), source, as_of, key, tracked)


def _inserted(held: DataFrame, source: DataFrame, as_of: date, key: str, tracked: list[str]) -> DataFrame:
    """Source rows whose key is not ``_held``, as new current versions."""
    return source.join(held, on_hot_key(key, "_held"), "left_anti").select(
        key,
        *tracked,
        F.lit(as_of).alias("start_date"),
        F.lit(OPEN_END).cast("date").alias("end_date"),
        F.lit("Y").alias("current_flag"),
    )


def apply_scd2(
    dim: DataFrame,
    source: DataFrame,
    as_of: date,
    key: str = "customer_id",
    tracked: list[str] = TRACKED,
    null_safe: bool = False,
) -> DataFrame:
    """Close and insert. New rows get a NULL surrogate if ``dim`` has one.

    What the source contradicts is found and written once; both halves start
    from it, so source and versions are compared a single time.
    """
    outdated = written(outdated_versions(dim, source, key, tracked, null_safe), "outdated")
    closed = close_versions(dim, source, as_of, key, tracked, null_safe, outdated)
    remaining = current_versions(dim).join(outdated, _same_version(key, tracked), "left_anti")
    fresh = _inserted(remaining.select(F.col(key).alias("_held")), source, as_of, key, tracked)
    return closed.unionByName(fresh, allowMissingColumns=True)


def apply_history(
    dim: DataFrame,
    events: DataFrame,
    key: str = "customer_id",
    tracked: list[str] = TRACKED,
    at: str = "created_timestamp",
) -> DataFrame:
    """Every version that ``events`` tell of, each from the day it happened to the day before the next.

    Unlike ``apply_scd2``, which knows the state of one day only, a batch may hold
    several states of a key, and states from before those the dimension has. For
    the keys it names, states and events are put in order, equal neighbours are
    one version, and intervals follow from the order; a late event takes its place
    and shortens the version it falls into. The result does not depend on how the
    events were cut into batches, and a batch that comes again changes nothing.

    Versions count days: of a key's events on one day the last is its state, and
    where a version starts on that day already, the event's state replaces it. A
    change to or from NULL is a change. Versions that stay keep their surrogate,
    new ones have NULL. Other keys pass through; an event without a time fails.
    """
    state = [F.col(c) for c in tracked]
    dated = F.coalesce(F.col(at), F.raise_error(F.lit("cannot place an event without a time")).cast("timestamp_ntz"))
    # One row a key and day, combined before the shuffle: a hot key has as many rows as days.
    daily = events.select(key, dated.alias("_at"), F.struct(*state).alias("_state"))
    daily = daily.groupBy(key, F.to_date("_at").alias("_day")).agg(F.max(F.struct("_at", "_state")).alias("_last"))
    daily = written(daily.select(key, "_day", F.col("_last._state").alias("_state")), "daily-states")
    touched = daily.select(F.col(key).alias("_touched")).distinct()
    others = dim.join(touched, on_hot_key(key, "_touched"), "left_anti")
    held = dim.join(touched, on_hot_key(key, "_touched"), "left_semi")
    extra = [c for c in dim.columns if c not in (key, *tracked, "start_date", "end_date", "current_flag")]
    # Of several versions of one day the one that lasted longest is its state.
    held = held.groupBy(key, F.col("start_date").alias("_day")).agg(
        F.max(F.struct("end_date", F.struct(*state).alias("_state"), F.struct(*extra, F.lit(0)).alias("_extra"))).alias("_last")
    )
    both = held.select(key, "_day", F.col("_last._state").alias("_held"), F.col("_last._extra").alias("_extra")).join(
        daily.withColumnsRenamed({key: "_key", "_day": "_on"}), (F.col(key) == F.col("_key")) & (F.col("_day") == F.col("_on")), "full"
    )
    both = both.select(
        F.coalesce(key, "_key").alias(key),
        F.coalesce("_day", "_on").alias("_day"),
        F.coalesce("_state", "_held").alias("_state"),
        F.when(F.col("_state").isNull() | F.col("_state").eqNullSafe(F.col("_held")), F.col("_extra")).alias("_extra"),
    )
    in_time = Window.partitionBy(key).orderBy("_day")
    runs = both.withColumn("_before", F.lag("_state").over(in_time)).where(~F.col("_state").eqNullSafe(F.col("_before")))
    runs = runs.withColumn("_next", F.lead("_day").over(in_time))
    columns = {
        **{c: F.col(f"_state.{c}") for c in tracked},
        **{c: F.col(f"_extra.{c}") for c in extra},
        "start_date": F.col("_day"),
        "end_date": F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END).cast("date")),
        "current_flag": F.when(F.col("_next").isNull(), "Y").otherwise("N"),
        key: F.col(key),
    }
    return others.unionByName(runs.select(*[columns[c].alias(c) for c in dim.columns]))


def fill_surrogates(df: DataFrame, column: str = "customer_key", highest: int = 0) -> DataFrame:
    """Number the rows whose surrogate is NULL above ``highest``; unique, with gaps.

    No global ordering and no single-partition window. Write the result before
    reading it twice: a recomputed plan may hand out other numbers.
    """
    fresh = F.lit(highest + 1) + F.monotonically_increasing_id()
    return df.withColumn(column, F.coalesce(F.col(column), fresh))


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise if a key repeats or is NULL. Reads one column and combines map-side."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    broken = counts.where((F.col("n") > 1) | F.col(key).isNull()).limit(3).collect()
    if broken:
        shown = ", ".join(f"{row[key]!r} x{row['n']}" for row in broken)
        raise DuplicateKeyError(f"{key} must be unique and not NULL in a merge source, found {shown}")


def latest_per_key(df: DataFrame, key: str, columns: list[str], order: str = "_loaded_at") -> DataFrame:
    """One row per key: greatest load time, then greatest attributes, so the pick is repeatable."""
    picked = F.max(F.struct(order, *columns)).alias("_picked")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"_picked.{c}").alias(c) for c in columns])


def upsert(
    dim: DataFrame,
    source: DataFrame,
    key: str = "account_id",
    on_duplicate: str = "fail",
) -> DataFrame:
    """Type-1 merge: source values win, keys only ``dim`` has stay as they are."""
    values = [c for c in dim.columns if c != key]
    if on_duplicate == "latest":
        source = latest_per_key(source, key, values)
    elif on_duplicate == "fail":
        assert_unique(source, key)
    else:
        raise ValueError(f"on_duplicate must be 'fail' or 'latest', not {on_duplicate!r}")
    incoming = source.select(*dim.columns)
    kept = dim.join(incoming.select(key), key, "left_anti").select(*dim.columns)
    return kept.unionByName(incoming)


def new_codes(dim: DataFrame, source: DataFrame, code: str = "transaction_type") -> DataFrame:
    """Codes ``dim`` lacks, described by themselves. NULL is not a code."""
    seen = source.where(F.col(code).isNotNull()).select(code).distinct()
    return seen.join(dim.select(code), code, "left_anti").select(code, F.col(code).alias("description"))


def insert_codes(dim: DataFrame, source: DataFrame, code: str = "transaction_type") -> DataFrame:
    """Known codes keep their description, whatever it says now."""
    return dim.select(code, "description").unionByName(new_codes(dim, source, code))


def calendar(spark: SparkSession, start: date, end: date, dow_base: int = 0) -> DataFrame:
    days = spark.range((end - start).days + 1)
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return days.select(*calendar_columns(day, dow_base))


def calendar_spanning(df: DataFrame, day_column: str, dow_base: int = 0) -> DataFrame:
    """Every day from the first to the last in ``df``; the span is one aggregate row."""
    span = df.agg(F.min(day_column).cast("date").alias("lo"), F.max(day_column).cast("date").alias("hi"))
    days = span.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("_day"))
    return days.select(*calendar_columns(F.col("_day"), dow_base))


def extend_calendar(dim_date: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add the days ``dim_date`` lacks, so a repeated fill adds nothing."""
    return dim_date.unionByName(wanted.join(dim_date.select("date_key"), "date_key", "left_anti"))
