"""SRC: each query exports a given table as files with Spark and loads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tellerlake.plans import bank
from tellerlake.plans.daily import append_snapshot
from tellerlake.plans.registry import query
from tellerlake.schemas import ACCOUNT_FILE, TRANSACTION_FILE
from tellerlake.sources import files
from tellerlake.sources.lake import Lake
from tellerlake.sources.workspace import new_dir
from tellerlake.streaming.file_ingest import ingest

_ACCOUNTS = """account_id, customer_id, account_type, status, currency_code, CAST(open_date AS VARCHAR) AS open_date,
  strftime(created_timestamp, '%Y-%m-%d %H:%M:%S') AS created_timestamp"""


def _export_csv(df: DataFrame, path: str | None = None, mode: str = "error") -> str:
    path = path or new_dir(df.sparkSession, "csv")
    text = df.select(
        *[
            F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
            if f.dataType.typeName() == "timestamp_ntz"
            else F.col(f.name).cast("string")
            for f in df.schema.fields
        ]
    )
    text.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def _text_columns(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


@query("src_01", f"SELECT {_ACCOUNTS} FROM accounts")
def csv_scan(spark, sf_dir):
    return files.read_csv(spark, _export_csv(bank.accounts(spark, sf_dir)), ACCOUNT_FILE)


@query(
    "src_02",
    """SELECT CASE WHEN status <> 'P' THEN status END AS status,
              CASE WHEN account_type <> '5-LOW' THEN account_type END AS account_type, COUNT(*) AS row_count
       FROM accounts GROUP BY 1, 2""",
)
def null_tokens(spark, sf_dir):
    """Pending accounts are delivered as NULL, low priority as a quoted empty field."""
    delivered = bank.accounts(spark, sf_dir).select(
        "account_id",
        F.when(F.col("account_type") == "5-LOW", "").otherwise(F.col("account_type")).alias("account_type"),
        F.when(F.col("status") == "P", "NULL").otherwise(F.col("status")).alias("status"),
    )
    schema = _text_columns("account_id", "account_type", "status")
    loaded = files.read_csv(spark, _export_csv(delivered), schema)
    return loaded.groupBy("status", "account_type").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "src_03",
    """SELECT account_id, status || ', "' || account_type || '"' || chr(10) || account_id AS remark, customer_id
       FROM accounts""",
)
def quoted_fields(spark, sf_dir):
    """A remark holds the delimiter, quotes and line breaks."""
    remark = F.concat("status", F.lit(', "'), "account_type", F.lit('"\n'), "account_id").alias("remark")
    delivered = bank.accounts(spark, sf_dir).select("account_id", remark, "customer_id")
    return files.read_csv(spark, _export_csv(delivered), _text_columns("account_id", "remark", "customer_id"))


@query(
    "src_04",
    """SELECT account_id, customer_id, CASE WHEN status <> 'O' THEN account_type END AS account_type,
              CASE WHEN status <> 'O' THEN status END AS status
       FROM accounts""",
)
def ragged_rows(spark, sf_dir):
    """Open accounts come two fields short, pending ones with a field too many."""
    fields = [F.col("account_id"), F.col("customer_id")]
    more = F.when(F.col("status") != "O", F.concat_ws(",", "account_type", "status"))
    surplus = F.when(F.col("status") == "P", F.lit("surplus"))
    path = new_dir(spark, "ragged")
    bank.accounts(spark, sf_dir).select(F.concat_ws(",", *fields, more, surplus)).write.text(path)
    schema = _text_columns("account_id", "customer_id", "account_type", "status")
    return files.read_csv(spark, path, schema, header=False)


_BY_TYPE = """SELECT transaction_type, COUNT(*) AS row_count, CAST(SUM(amount) AS DOUBLE) AS total_amount,
  strftime(MIN(transaction_date), '%Y-%m-%d %H:%M:%S') AS first_at,
  strftime(MAX(transaction_date), '%Y-%m-%d %H:%M:%S') AS last_at
FROM transactions GROUP BY 1"""


def _by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("amount").alias("total_amount"),
        F.min("transaction_date").alias("first_at"),
        F.max("transaction_date").alias("last_at"),
    )


@query("src_05", _BY_TYPE)
def typed_load(spark, sf_dir):
    return _by_type(files.read_csv(spark, _export_csv(bank.transactions(spark, sf_dir)), TRANSACTION_FILE))


@query(
    "src_06",
    """SELECT account_id, '2023-03-01 00:00:00' AS created_timestamp, '2023-03-01 00:00:00' AS _loaded_at,
              1 AS _load_id
       FROM accounts""",
)
def load_audit(spark, sf_dir):
    schema = StructType(ACCOUNT_FILE.fields[:-1])
    path = _export_csv(bank.accounts(spark, sf_dir).drop("created_timestamp"))
    stamped = files.with_load_audit(files.read_csv(spark, path, schema), 1, bank.HISTORY_AT)
    return stamped.select("account_id", "created_timestamp", "_loaded_at", "_load_id")


@query("src_07", f"SELECT {_ACCOUNTS} FROM accounts")
def parquet_by_name(spark, sf_dir):
    """Columns lie in another order and case, beside one the table does not have."""
    delivered = bank.accounts(spark, sf_dir).select(
        F.lit("x").alias("Batch"),
        *[F.col(c).alias(c.title()) for c in reversed(ACCOUNT_FILE.fieldNames())],
    )
    path = new_dir(spark, "parquet")
    delivered.write.parquet(path)
    return files.read_parquet(spark, path, ACCOUNT_FILE)


@query("src_08", f"SELECT {_ACCOUNTS} FROM accounts")
def epoch_micros(spark, sf_dir):
    micros = F.unix_micros(F.col("created_timestamp").cast("timestamp"))
    path = new_dir(spark, "micros")
    bank.accounts(spark, sf_dir).withColumn("created_timestamp", micros).write.parquet(path)
    return files.read_parquet(spark, path, ACCOUNT_FILE)


@query("src_09", _BY_TYPE)
def double_to_money(spark, sf_dir):
    path = new_dir(spark, "doubles")
    bank.transactions(spark, sf_dir).withColumn("amount", F.col("amount").cast("double")).write.parquet(path)
    return _by_type(files.read_parquet(spark, path, TRANSACTION_FILE))


@query("src_10", f"SELECT {_ACCOUNTS} FROM accounts WHERE status <> 'O'")
def load_once(spark, sf_dir):
    """The folder still holds the first delivery when the second is loaded."""
    folder = _export_csv(bank.account_history(spark, sf_dir))
    first_files = new_dir(spark, "load-log")
    files.list_files(spark, folder).select("path").write.parquet(first_files)
    load_log = spark.read.parquet(first_files)
    _export_csv(bank.account_increment(spark, sf_dir), folder, "append")
    rows, _ = files.read_new_csv(spark, folder, ACCOUNT_FILE, load_log)
    return rows


@query("src_11", "SELECT _load_id, COUNT(*) AS row_count, COUNT(DISTINCT account_id) AS account_count "
                 "FROM raw_accounts GROUP BY 1")
def file_stream(spark, sf_dir):
    """Two deliveries arrive and are streamed in; a third poll finds nothing."""
    root = new_dir(spark, "stream")
    lake = Lake(spark, f"{root}/lake")
    folder, checkpoint = f"{root}/in", f"{root}/checkpoint"
    for delivery in (bank.account_history, bank.account_increment):
        _export_csv(delivery(spark, sf_dir), folder, "append")
        ingest(lake, "bronze/t_account", folder, checkpoint)
    ingest(lake, "bronze/t_account", folder, checkpoint)
    return (
        lake.read("bronze/t_account")
        .groupBy("_load_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("account_id").alias("account_count"))
    )


@query(
    "src_11_reload",
    """SELECT COUNT(*) AS row_count, COUNT(DISTINCT trim(account_id)) AS account_count, 2 AS load_count FROM raw_accounts""",
)
def reload_after_reset(spark, sf_dir):
    """Two folders by two progress folders; the table is reset and both are loaded again."""
    root = new_dir(spark, "reload")
    lake, table = Lake(spark, f"{root}/lake"), "bronze/t_account"
    for part, delivery in enumerate((bank.account_history, bank.account_increment)):
        _export_csv(delivery(spark, sf_dir), f"{root}/in{part}")
    for _ in range(2):
        lake.reset(table)
        for part in range(2):
            ingest(lake, table, f"{root}/in{part}", f"{root}/progress{part}")
    return lake.read(table).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.trim("account_id")).alias("account_count"),
        F.count_distinct("_load_id").alias("load_count"),
    )


@query(
    "src_12",
    """SELECT CASE WHEN transaction_date < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END AS _load_id,
              COUNT(*) AS row_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
       FROM transactions GROUP BY 1""",
)
def csv_to_snapshots(spark, sf_dir):
    """Each CSV delivery is cast and appended to the columnar table as the next snapshot."""
    lake = Lake(spark, new_dir(spark, "snapshots"))
    delivered = bank.transactions(spark, sf_dir)
    early = F.col("transaction_date") < F.lit(bank.CUTOFF)
    for load_id, part in ((1, early), (2, ~early)):
        append_snapshot(lake, "t_transaction", _export_csv(delivered.where(part)), load_id, bank.HISTORY_AT)
    money = F.col("amount").cast("decimal(18,2)")
    return (
        lake.read("snapshots/t_transaction")
        .groupBy("_load_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(money).alias("total_amount"))
    )
