"""CLN: trimming, defaults, guards and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellerlake.operators.cleanse import TRIMMED, count_untidy, keep_latest, tidy
from tellerlake.plans import bank
from tellerlake.plans.registry import query

_CUSTOMER = "customer_id, first_name, last_name, email_address, phone_number, city, state_province, country"
_ACCOUNT = "account_id, customer_id, account_type, status, currency_code"
_TRANSACTION = "transaction_id, account_id, transaction_type, description"


@query("cln_01", f"SELECT {_CUSTOMER}, _load_id FROM tidy_customers")
def customers(spark, sf_dir):
    return tidy(bank.raw_customers(spark, sf_dir), "t_customer").drop("created_timestamp", "_loaded_at")


@query("cln_02", f"SELECT {_ACCOUNT}, _load_id FROM tidy_accounts")
def accounts(spark, sf_dir):
    return tidy(bank.raw_accounts(spark, sf_dir), "t_account").drop(
        "open_date", "created_timestamp", "_loaded_at"
    )


@query(
    "cln_03",
    """SELECT coalesce(trim(currency_code), 'CAD') AS currency_code, COUNT(*) AS row_count
       FROM raw_accounts GROUP BY 1""",
)
def default_currency(spark, sf_dir):
    tidied = tidy(bank.raw_accounts(spark, sf_dir), "t_account")
    return tidied.groupBy("currency_code").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "cln_04",
    f"""SELECT {_TRANSACTION}, CAST(transaction_date AS VARCHAR) AS transaction_date,
               CAST(amount AS DOUBLE) AS amount
        FROM tidy_transactions""",
)
def transactions(spark, sf_dir):
    return tidy(bank.raw_transactions(spark, sf_dir), "t_transaction").drop("_loaded_at", "_load_id")


def _guard_sql() -> str:
    """Rows with a column that differs from its cleaned form."""
    special = {"email_address": "lower(trim(email_address))", "currency_code": "coalesce(trim(currency_code), 'CAD')"}
    views = {"t_customer": "raw_customers", "t_account": "raw_accounts", "t_transaction": "raw_transactions"}
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNT(*) AS rows_to_change FROM {views[table]} WHERE "
        + " OR ".join(f"{c} IS DISTINCT FROM {special.get(c, f'trim({c})')}" for c in columns)
        for table, columns in TRIMMED.items()
    )


@query("cln_05", _guard_sql())
def rows_to_change(spark, sf_dir):
    return (
        count_untidy(bank.raw_customers(spark, sf_dir), "t_customer")
        .unionByName(count_untidy(bank.raw_accounts(spark, sf_dir), "t_account"))
        .unionByName(count_untidy(bank.raw_transactions(spark, sf_dir), "t_transaction"))
    )


@query("cln_06", f"SELECT {_CUSTOMER}, _load_id FROM clean_customers")
def latest_customers(spark, sf_dir):
    tidied = tidy(bank.raw_customers(spark, sf_dir), "t_customer")
    return keep_latest(tidied, "customer_id").drop("created_timestamp", "_loaded_at")


@query("cln_07", f"SELECT {_ACCOUNT}, _load_id FROM clean_accounts")
def latest_accounts(spark, sf_dir):
    tidied = tidy(bank.raw_accounts(spark, sf_dir), "t_account")
    return keep_latest(tidied, "account_id").drop("open_date", "created_timestamp", "_loaded_at")


@query(
    "cln_08",
    f"""SELECT {_TRANSACTION}, CAST(transaction_date AS VARCHAR) AS transaction_date,
               CAST(amount AS DOUBLE) AS amount
        FROM clean_transactions""",
)
def latest_transactions(spark, sf_dir):
    tidied = tidy(bank.raw_transactions(spark, sf_dir), "t_transaction")
    return keep_latest(tidied, "transaction_id").drop("_loaded_at", "_load_id")
