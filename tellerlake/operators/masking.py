"""Role-aware masking of protected columns. Mask last: joins need the clear keys."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.masks import POLICIES

# Roles that read clear text.
CLEAR_ROLES = {"SYSADMIN", "ACCOUNTADMIN"}

# Layer, table, column and policy of every protected column.
ASSIGNMENTS = [
    ("bronze", "t_customer", "first_name", "MASK_NAME"),
    ("bronze", "t_customer", "last_name", "MASK_NAME"),
    ("bronze", "t_customer", "email_address", "MASK_EMAIL"),
    ("bronze", "t_customer", "phone_number", "MASK_PHONE"),
    ("bronze", "t_customer", "city", "MASK_LOCATION"),
    ("bronze", "t_customer", "state_province", "MASK_LOCATION"),
    ("bronze", "t_account", "account_id", "MASK_FINANCIAL_ID"),
    ("bronze", "t_transaction", "amount", "MASK_AMOUNT"),
    ("silver", "dim_customer", "first_name", "MASK_NAME"),
    ("silver", "dim_customer", "last_name", "MASK_NAME"),
    ("silver", "dim_customer", "email_address", "MASK_EMAIL"),
    ("silver", "dim_customer", "city", "MASK_LOCATION"),
    ("silver", "dim_customer", "state_province", "MASK_LOCATION"),
    ("gold", "fact_daily_transaction", "amount", "MASK_AMOUNT"),
    ("gold", "fact_daily_agg", "total_amount", "MASK_AMOUNT"),
]

# The category each policy is reported under.
CATEGORIES = {
    "MASK_NAME": "PII - Identity",
    "MASK_EMAIL": "PII - Contact",
    "MASK_PHONE": "PII - Contact",
    "MASK_LOCATION": "PII - Location",
    "MASK_FINANCIAL_ID": "Financial - Identifier",
    "MASK_AMOUNT": "Financial - Amount",
}


def assigned(table: str) -> dict[str, str]:
    """Policy by protected column of one table."""
    return {column: policy for _, t, column, policy in ASSIGNMENTS if t == table}


def apply_masks(df: DataFrame, table: str, roles: Iterable[str] = ()) -> DataFrame:
    """The table as ``roles`` may see it; one projection."""
    if CLEAR_ROLES & {role.upper() for role in roles}:
        return df
    masked = {c: POLICIES[p](F.col(c)) for c, p in assigned(table).items() if c in df.columns}
    return df.withColumns(masked) if masked else df


def publish_masked_view(df: DataFrame, table: str, view: str, roles: Iterable[str] = ()) -> None:
    apply_masks(df, table, roles).createOrReplaceTempView(view)


def column_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """Per protected column: rows, non-null values and values its mask changes."""
    parts = []
    for table, df in tables.items():
        cells, measures = [], []
        for layer, t, column, policy in ASSIGNMENTS:
            if t != table:
                continue
            clear = F.col(column)
            masked = POLICIES[policy](clear)
            measures += [
                F.count(clear).alias(f"{column}_present"),
                F.count_if(~clear.eqNullSafe(masked)).alias(f"{column}_changed"),
            ]
            cells.append(
                F.struct(
                    F.lit(layer).alias("layer"),
                    F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.lit(policy).alias("policy"),
                    F.lit(CATEGORIES[policy]).alias("category"),
                    F.col("n").alias("total_rows"),
                    F.col(f"{column}_present").alias("present_values"),
                    F.col(f"{column}_changed").alias("masked_values"),
                )
            )
        one_row = df.agg(F.count(F.lit(1)).alias("n"), *measures)
        parts.append(one_row.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def coverage_by(coverage: DataFrame, *columns: str) -> DataFrame:
    """Coverage folded by policy, layer or category."""
    return coverage.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("protected_columns"),
        F.count_distinct("table_name").alias("protected_tables"),
        F.sum("present_values").alias("present_values"),
        F.sum("masked_values").alias("masked_values"),
    )


def masked_sample(df: DataFrame, table: str, key: str, roles: Iterable[str] = (), n: int = 5) -> DataFrame:
    """First ``n`` rows in key order, picked on clear values and masked after."""
    return apply_masks(df.orderBy(key).limit(n), table, roles)
