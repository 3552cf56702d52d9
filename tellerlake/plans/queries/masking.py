"""MSK: the policies, their assignments and their coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellerlake.functions import masks
from tellerlake.operators import masking
from tellerlake.plans import bank
from tellerlake.plans.registry import query

_FIRST = "left({0}, 1) || '***'"
_EMAIL = "left({0}, 1) || '***@' || split_part({0}, '@', 2)"
_PHONE = "'***-***-' || right({0}, 4)"
_ID = "split_part({0}, '-', 1) || '-***'"


def _masked(name: str, policy: str, column: str, template: str) -> None:
    @query(name, f"SELECT customer_id, {template.format(column)} AS {column} FROM people")
    def build(spark, sf_dir):
        masked = masks.POLICIES[policy](F.col(column)).alias(column)
        return bank.people(spark, sf_dir).select("customer_id", masked)


_masked("msk_01", "MASK_NAME", "last_name", _FIRST)
_masked("msk_02", "MASK_EMAIL", "email_address", _EMAIL)
_masked("msk_03", "MASK_PHONE", "phone_number", _PHONE)
_masked("msk_04", "MASK_LOCATION", "city", _FIRST)


@query("msk_05", f"SELECT {_ID.format('account_id')} AS account_id, customer_id FROM accounts")
def identifiers(spark, sf_dir):
    return masking.apply_masks(bank.accounts(spark, sf_dir), "t_account").select("account_id", "customer_id")


@query("msk_06", "SELECT transaction_id, CAST(0 AS DOUBLE) AS amount FROM transactions")
def amounts(spark, sf_dir):
    return masking.apply_masks(bank.transactions(spark, sf_dir), "t_transaction").select(
        "transaction_id", "amount"
    )


@query(
    "msk_07",
    f"""SELECT 'ANALYST' AS role, customer_id, {_FIRST.format('first_name')} AS first_name,
               {_FIRST.format('last_name')} AS last_name, {_EMAIL.format('email_address')} AS email_address,
               {_FIRST.format('city')} AS city, {_FIRST.format('state_province')} AS state_province, country,
               current_flag
        FROM dim_now
        UNION ALL
        SELECT 'SYSADMIN', customer_id, first_name, last_name, email_address, city, state_province, country,
               current_flag
        FROM dim_now""",
)
def per_role(spark, sf_dir):
    dim = bank.dim_now(spark, sf_dir).drop("start_date", "end_date")
    views = [
        masking.apply_masks(dim, "dim_customer", [role]).withColumn("role", F.lit(role))
        for role in ("ANALYST", "SYSADMIN")
    ]
    return views[0].unionByName(views[1])


_COVERAGE_SOURCES = {
    "t_customer": "raw_customers",
    "t_account": "raw_accounts",
    "t_transaction": "raw_transactions",
    "dim_customer": "dim_now",
    "fact_daily_transaction": "fact",
    "fact_daily_agg": "rollups",
}
_MASK_SQL = {
    "MASK_NAME": _FIRST,
    "MASK_EMAIL": _EMAIL,
    "MASK_PHONE": _PHONE,
    "MASK_LOCATION": _FIRST,
    "MASK_FINANCIAL_ID": _ID,
    "MASK_AMOUNT": "CAST(0 AS DECIMAL(18, 2))",
}


def _coverage_sql() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{layer}' AS layer, '{table}' AS table_name, '{column}' AS column_name,
  '{policy}' AS policy, '{masking.CATEGORIES[policy]}' AS category, COUNT(*) AS total_rows,
  COUNT({column}) AS present_values,
  COUNT(*) FILTER (WHERE {column} IS DISTINCT FROM {_MASK_SQL[policy].format(column)}) AS masked_values
FROM {_COVERAGE_SOURCES[table]}"""
        for layer, table, column, policy in masking.ASSIGNMENTS
    )


@query("msk_08", _coverage_sql())
def coverage(spark, sf_dir):
    tables = {t: getattr(bank, source)(spark, sf_dir) for t, source in _COVERAGE_SOURCES.items()}
    return masking.column_coverage(tables)


@query(
    "msk_08_by_policy",
    f"""SELECT policy, category, COUNT(*) AS protected_columns, COUNT(DISTINCT table_name) AS protected_tables,
               CAST(SUM(present_values) AS BIGINT) AS present_values,
               CAST(SUM(masked_values) AS BIGINT) AS masked_values
        FROM ({_coverage_sql()}) GROUP BY 1, 2""",
)
def coverage_by_policy(spark, sf_dir):
    return masking.coverage_by(coverage(spark, sf_dir), "policy", "category")


@query(
    "msk_08_by_layer",
    f"""SELECT layer, COUNT(*) AS protected_columns, COUNT(DISTINCT table_name) AS protected_tables,
               CAST(SUM(present_values) AS BIGINT) AS present_values,
               CAST(SUM(masked_values) AS BIGINT) AS masked_values
        FROM ({_coverage_sql()}) GROUP BY 1""",
)
def coverage_by_layer(spark, sf_dir):
    return masking.coverage_by(coverage(spark, sf_dir), "layer")


@query(
    "msk_09",
    f"""SELECT {_FIRST.format('first_name')} AS first_name, {_FIRST.format('last_name')} AS last_name,
               {_EMAIL.format('email_address')} AS email_address, {_PHONE.format('phone_number')} AS phone_number,
               {_FIRST.format('city')} AS city, {_FIRST.format('state_province')} AS state_province
        FROM (SELECT * FROM people ORDER BY customer_id LIMIT 5)""",
)
def sample(spark, sf_dir):
    shown = masking.masked_sample(bank.people(spark, sf_dir), "t_customer", "customer_id")
    return shown.select("first_name", "last_name", "email_address", "phone_number", "city", "state_province")
