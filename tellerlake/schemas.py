"""Declared table schemas, column groups and lake layout."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)


# A delivered row without a value here fails its load.
REQUIRED = {"required": True}


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True, *rest) for name, kind, *rest in fields])


def is_required(field: StructField) -> bool:
    return bool(field.metadata.get("required"))


_S, _D, _TS = StringType(), DateType(), TimestampNTZType()

# What a delivered file holds, in file order.
CUSTOMER_FILE = _struct(
    ("customer_id", _S, REQUIRED),
    ("first_name", _S),
    ("last_name", _S),
    ("email_address", _S),
    ("phone_number", _S),
    ("city", _S),
    ("state_province", _S),
    ("country", _S),
    ("created_timestamp", _TS),
)
ACCOUNT_FILE = _struct(
    ("account_id", _S, REQUIRED),
    ("customer_id", _S, REQUIRED),
    ("account_type", _S),
    ("status", _S),
    ("currency_code", _S),
    ("open_date", _D),
    ("created_timestamp", _TS),
)
TRANSACTION_FILE = _struct(
    ("transaction_id", _S, REQUIRED),
    ("account_id", _S, REQUIRED),
    ("transaction_date", _TS, REQUIRED),
    ("transaction_type", _S),
    ("amount", MONEY),
    ("description", _S),
)

# Every load adds these two; _load_id is also the bronze partition column.
LOAD_AUDIT = _struct(("_loaded_at", _TS), ("_load_id", IntegerType()))


def with_audit(schema: StructType) -> StructType:
    return StructType(schema.fields + LOAD_AUDIT.fields)


DIM_CUSTOMER = _struct(
    ("customer_key", LongType()),
    ("customer_id", _S),
    ("first_name", _S),
    ("last_name", _S),
    ("email_address", _S),
    ("city", _S),
    ("state_province", _S),
    ("country", _S),
    ("start_date", _D),
    ("end_date", _D),
    ("current_flag", _S),
)
DIM_ACCOUNT = _struct(
    ("account_id", _S),
    ("customer_id", _S),
    ("account_type", _S),
    ("status", _S),
    ("currency_code", _S),
)
DIM_TRANSACTION_TYPE = _struct(("transaction_type", _S), ("description", _S))
DIM_DATE = _struct(
    ("date_key", _D),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
    ("day_of_week", IntegerType()),
)
FACT_TRANSACTION = _struct(
    ("customer_id", _S),
    ("account_id", _S),
    ("transaction_id", _S),
    ("transaction_type", _S),
    ("amount", MONEY),
    ("date_key", _D),
)
FACT_DAILY_AGG = _struct(
    ("customer_id", _S),
    ("account_id", _S),
    ("transaction_type", _S),
    ("total_amount", MONEY),
    ("transaction_count", LongType()),
    ("rollup_level", IntegerType()),
    ("date_key", _D),
)
DATA_QUALITY_LOG = _struct(
    ("log_id", LongType()),
    ("run_id", _S),
    ("check_timestamp", _TS),
    ("table_name", _S),
    ("check_name", _S),
    ("severity", _S),
    ("records_failed", LongType()),
    ("sample_ids", _S),
    ("details", _S),
)

# What the monthly trend keeps: sums, sets of numbered values as bitmaps, and the numbers. date_key is the month.
TREND_COUNTS = _struct(
    ("transaction_type", _S),
    ("transaction_count", LongType()),
    ("amount_count", LongType()),
    ("total_amount", DecimalType(38, 2)),
    ("date_key", _D),
)
TREND_SETS = _struct(
    ("transaction_type", _S),
    ("kind", _S),
    ("bucket", LongType()),
    ("bits", BinaryType()),
    ("date_key", _D),
)
VALUE_NUMBERS = _struct(("kind", _S), ("value", _S), ("number", LongType()))

# Snapshot tables hold amounts as DOUBLE, as the columnar deliveries do.
TRANSACTION_SNAPSHOT = StructType(
    [StructField("amount", DoubleType(), True) if f.name == "amount" else f for f in TRANSACTION_FILE.fields]
)

# Partition column of the dated tables: the day, month or year of date_key.
DATE_PART = "date_part"

# Lake tables: layer/table -> (schema, partition columns).
TABLES: dict[str, tuple[StructType, list[str]]] = {
    "snapshots/t_customer": (with_audit(CUSTOMER_FILE), ["_load_id"]),
    "snapshots/t_account": (with_audit(ACCOUNT_FILE), ["_load_id"]),
    "snapshots/t_transaction": (with_audit(TRANSACTION_SNAPSHOT), ["_load_id"]),
    "bronze/t_customer": (with_audit(CUSTOMER_FILE), ["_load_id"]),
    "bronze/t_account": (with_audit(ACCOUNT_FILE), ["_load_id"]),
    "bronze/t_transaction": (with_audit(TRANSACTION_FILE), ["_load_id"]),
    "silver/dim_customer": (DIM_CUSTOMER, []),
    "silver/dim_account": (DIM_ACCOUNT, []),
    "silver/dim_transaction_type": (DIM_TRANSACTION_TYPE, []),
    "silver/dim_date": (DIM_DATE, []),
    "gold/fact_daily_transaction": (FACT_TRANSACTION, [DATE_PART]),
    "gold/fact_daily_agg": (FACT_DAILY_AGG, [DATE_PART]),
    "gold/trend_counts": (TREND_COUNTS, [DATE_PART]),
    "gold/trend_sets": (TREND_SETS, [DATE_PART]),
    "gold/value_numbers": (VALUE_NUMBERS, []),
    "governance/data_quality_log": (DATA_QUALITY_LOG, []),
}

# The customer attributes whose change opens a new version.
TRACKED = ["first_name", "last_name", "email_address", "city", "state_province", "country"]

# Fixed value: the open end of a current version.
OPEN_END = "9999-12-31"
