"""The bank's tables, derived from the whole of the given star-schema tables.

customer+nation+region are the customers, orders the accounts, lineitem the
transactions. Two deliveries exist: the history, and an incremental one that
brings the customers overdrawn today, the renamed segment and the final order
statuses. ``bank_sql`` states the same tables in SQL.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.functions.numbers import money
from tellerlake.operators.cleanse import cleanse, tidy
from tellerlake.operators.dimensions import apply_scd2
from tellerlake.operators.facts import daily_rollups, transaction_fact
from tellerlake.operators.joins import written
from tellerlake.operators.quality import run_checks
from tellerlake.operators.views import monthly_spend_profile, type_trend
from tellerlake.schemas import OPEN_END

HISTORY_AT = datetime(2023, 3, 1)
INCREMENT_AT = datetime(2024, 3, 6)
HISTORY_DAY = HISTORY_AT.date()
INCREMENT_DAY = INCREMENT_AT.date()
# Transactions before this day belong to the history delivery.
CUTOFF = date(1998, 1, 1)
REPORT_DAY = date(1998, 6, 13)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, *columns: str):
    return F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(c).cast("string") for c in columns]))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean customers; overdrawn ones gave no e-mail, FURNITURE ones a malformed one."""
    load = partial(table, spark, sf_dir)
    named = (
        load("customer")
        .join(load("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(load("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    mailbox = F.when(F.col("c_mktsegment") == "FURNITURE", F.lower("c_name")).otherwise(
        F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    )
    return named.select(
        _id("CUST-", "c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_acctbal") >= 0, F.concat(mailbox, F.lit("@mail.com"))).alias("email_address"),
        F.concat(F.lit("416-555-"), F.right("c_name", F.lit(4))).alias("phone_number"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("state_province"),
        F.col("r_name").alias("country"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_timestamp"),
        (F.col("c_acctbal") < 0).alias("overdrawn"),
    )


def _stamp(df: DataFrame, load_id: int, at: datetime) -> DataFrame:
    return df.withColumns({"_loaded_at": F.lit(at).cast("timestamp_ntz"), "_load_id": F.lit(load_id)})


def _padded(column: str, before: str = "", after: str = ""):
    return F.concat(F.lit(before), F.col(column), F.lit(after))


def untidy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, as a source with blanks and capitals delivers them."""
    return people(spark, sf_dir).withColumns(
        {
            "customer_id": _padded("customer_id", "  "),
            "first_name": _padded("first_name", " ", "  "),
            "email_address": F.concat(F.upper("email_address"), F.lit(" ")),
            "city": _padded("city", "", " "),
        }
    )


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy first delivery, without the overdrawn, under the segment's old name."""
    renamed = F.when(F.col("state_province") == "AUTOMOBILE", "VEHICLES").otherwise(F.col("state_province"))
    held = untidy_customers(spark, sf_dir).where(~F.col("overdrawn")).drop("overdrawn")
    return held.withColumn("state_province", renamed)


def customer_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrived = F.col("overdrawn") | (F.col("state_province") == "AUTOMOBILE")
    return people(spark, sf_dir).where(arrived).drop("overdrawn")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _stamp(customer_history(spark, sf_dir), 1, HISTORY_AT)
    return first.unionByName(_stamp(customer_increment(spark, sf_dir), 2, INCREMENT_AT))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean accounts, one per order."""
    return table(spark, sf_dir, "orders").select(
        _id("ACCT-", "o_orderkey").alias("account_id"),
        _id("CUST-", "o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("account_type"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "CAD").otherwise("USD").alias("currency_code"),
        F.to_date("o_orderdate").alias("open_date"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_timestamp"),
    )


def account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every account as opened: status O, untidy, the default currency left out."""
    return accounts(spark, sf_dir).withColumns(
        {
            "account_id": _padded("account_id", " "),
            "account_type": _padded("account_type", "", " "),
            "status": F.lit("O"),
            "currency_code": F.when(F.col("currency_code") == "USD", " USD "),
        }
    )


def account_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose status has moved on."""
    return accounts(spark, sf_dir).where(F.col("status") != "O")


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _stamp(account_history(spark, sf_dir), 1, HISTORY_AT)
    return first.unionByName(_stamp(account_increment(spark, sf_dir), 2, INCREMENT_AT))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean transactions, one per line item; the id repeats as order and line number do."""
    return table(spark, sf_dir, "lineitem").select(
        _id("TXN-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        _id("ACCT-", "l_orderkey").alias("account_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("transaction_date"),
        F.col("l_returnflag").alias("transaction_type"),
        money(F.col("l_extendedprice")).alias("amount"),
        F.col("l_linestatus").alias("description"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy transactions, each year's shipments being one load."""
    return transactions(spark, sf_dir).withColumns(
        {
            "account_id": _padded("account_id", " ", " "),
            "transaction_type": _padded("transaction_type", "", " "),
            "_loaded_at": F.col("transaction_date"),
            "_load_id": F.year("transaction_date"),
        }
    )


def clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(raw_customers(spark, sf_dir), "t_customer")


def clean_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(raw_accounts(spark, sf_dir), "t_account")


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(raw_transactions(spark, sf_dir), "t_transaction")


def _version(df: DataFrame, start: date, end: str, flag: str) -> DataFrame:
    return df.select(
        "customer_id",
        "first_name",
        "last_name",
        "email_address",
        "city",
        "state_province",
        "country",
        F.lit(start).alias("start_date"),
        F.lit(end).cast("date").alias("end_date"),
        F.lit(flag).alias("current_flag"),
    )


def dim_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer versions after the history; BUILDING customers moved once before."""
    held = tidy(customer_history(spark, sf_dir), "t_customer")
    moved = held.where(F.col("state_province") == "BUILDING").withColumn("city", F.lit("OLD TOWN"))
    return _version(held, HISTORY_DAY, OPEN_END, "Y").unionByName(
        _version(moved, date(2020, 1, 1), "2023-02-28", "N")
    )


def dim_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_scd2(dim_prior(spark, sf_dir), people(spark, sf_dir), INCREMENT_DAY)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_fact(transactions(spark, sf_dir), accounts(spark, sf_dir))


def fact_before_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).where(F.col("date_key") < F.lit(CUTOFF))


def rollups(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    return daily_rollups(transactions(spark, sf_dir), accounts(spark, sf_dir), by_date=by_date)


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_spend_profile(fact(spark, sf_dir), dim_now(spark, sf_dir))


def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_trend(fact(spark, sf_dir))


# Tables with faults in them, for the quality rules.


def faulty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries side by side; who gave no e-mail has no id either."""
    tidied = tidy(raw_customers(spark, sf_dir), "t_customer")
    return tidied.withColumn("customer_id", F.when(F.col("email_address").isNotNull(), F.col("customer_id")))


def faulty_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts without a currency have lost their id, urgent ones their customer."""
    return accounts(spark, sf_dir).withColumns(
        {
            "account_id": F.when(F.col("account_type") != "4-NOT SPECIFIED", F.col("account_id")),
            "customer_id": F.when(F.col("account_type") != "1-URGENT", F.col("customer_id")),
        }
    )


def faulty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open returns have neither id nor account."""
    lost = (F.col("transaction_type") == "R") & (F.col("description") == "O")
    return transactions(spark, sf_dir).withColumns(
        {c: F.when(~lost, F.col(c)) for c in ("transaction_id", "account_id")}
    )


def faulty_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New versions added without closing the old ones."""
    return dim_prior(spark, sf_dir).unionByName(
        _version(people(spark, sf_dir).where(F.col("state_province") == "AUTOMOBILE"), INCREMENT_DAY, OPEN_END, "Y")
    )


def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over the clean tables, one over the faulty ones, written as a log is."""
    clean = run_checks(
        people(spark, sf_dir),
        accounts(spark, sf_dir),
        transactions(spark, sf_dir),
        dim_prior(spark, sf_dir),
        HISTORY_AT,
    )
    return written(clean.unionByName(faulty_run(spark, sf_dir)), "quality-log")


def faulty_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_checks(
        faulty_customers(spark, sf_dir),
        faulty_accounts(spark, sf_dir),
        faulty_transactions(spark, sf_dir),
        faulty_dim(spark, sf_dir),
        INCREMENT_AT,
        first_log_id=9,
    )
