"""Trimming, defaults and latest-load deduplication of the bronze tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.joins import on_hot_key

# Fixed value: the currency of an account that names none.
DEFAULT_CURRENCY = "CAD"

# The trimmed columns of each table; the first is its key.
TRIMMED = {
    "t_customer": [
        "customer_id",
        "first_name",
        "last_name",
        "email_address",
        "phone_number",
        "city",
        "state_province",
        "country",
    ],
    "t_account": ["account_id", "customer_id", "account_type", "status", "currency_code"],
    "t_transaction": ["transaction_id", "account_id", "transaction_type", "description"],
}
KEYS = {table: columns[0] for table, columns in TRIMMED.items()}


def _clean(column: str) -> Column:
    trimmed = F.trim(F.col(column))
    if column == "email_address":
        return F.lower(trimmed)
    if column == "currency_code":
        return F.coalesce(trimmed, F.lit(DEFAULT_CURRENCY))
    return trimmed


def tidy(df: DataFrame, table: str) -> DataFrame:
    """One projection; rows that are already clean come out unchanged."""
    return df.withColumns({c: _clean(c) for c in TRIMMED[table]})


def needs_tidying(table: str) -> Column:
    """True for the rows ``tidy`` would alter."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(c).eqNullSafe(_clean(c)) for c in TRIMMED[table]],
    )


def count_untidy(df: DataFrame, table: str) -> DataFrame:
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count_if(needs_tidying(table)).alias("rows_to_change"),
    )


def stale_keys(df: DataFrame, key: str, loaded_at: str = "_loaded_at", load: str | None = None) -> DataFrame:
    """Keys that have copies from more than one load, with their newest load time.

    Reads two columns and combines map-side, so one heavily copied key costs
    one row per task and not one giant group. With ``load``, the column of load
    ids, ``_oldest_load`` names a load that holds a superseded copy of the key.
    """
    witness = [F.min_by(load, loaded_at).alias("_oldest_load")] if load else []
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_stale_key"))
        .agg(F.max(loaded_at).alias("_newest"), F.min(loaded_at).alias("_oldest"), *witness)
        .where(F.col("_oldest") < F.col("_newest"))
        .drop("_oldest")
    )


def _older(key: str, loaded_at: str) -> Column:
    return on_hot_key(key, "_stale_key") & (F.col(loaded_at) < F.col("_newest"))


def drop_stale(df: DataFrame, stale: DataFrame, key: str, loaded_at: str = "_loaded_at") -> DataFrame:
    """Drop rows older than their key's newest load; ties and NULL keys or times stay.

    ``df`` is the left side of an anti join, which AQE can split when a key is
    hot. With a written ``stale`` (``joins.written``) Catalyst knows its bytes, and
    if they are few the wide rows are not shuffled at all.
    """
    return df.join(stale, _older(key, loaded_at), "left_anti")


def superseded_rows(df: DataFrame, stale: DataFrame, key: str, loaded_at: str = "_loaded_at") -> DataFrame:
    """The rows ``drop_stale`` drops."""
    return df.join(stale, _older(key, loaded_at), "left_semi")


def keep_latest(df: DataFrame, key: str, loaded_at: str = "_loaded_at") -> DataFrame:
    return drop_stale(df, stale_keys(df, key, loaded_at), key, loaded_at)


def cleanse(df: DataFrame, table: str) -> DataFrame:
    """Trim first, so that keys that differ only by blanks are one key in the dedupe."""
    return keep_latest(tidy(df, table), KEYS[table])
