"""DIM: versioned customers, merged accounts, type codes and the calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellerlake.operators import dimensions as dim
from tellerlake.plans import bank
from tellerlake.plans.registry import query
from tellerlake.sources.lake import Lake
from tellerlake.sources.workspace import new_dir
from tellerlake.streaming.dimension_feed import apply_customers

_VERSIONS = """customer_id, first_name, last_name, email_address, city, state_province, country,
  CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, current_flag"""


@query("dim_01", f"SELECT {_VERSIONS} FROM dim_closed")
def close(spark, sf_dir):
    return dim.close_versions(bank.dim_prior(spark, sf_dir), bank.people(spark, sf_dir), bank.INCREMENT_DAY)


@query("dim_02", f"SELECT {_VERSIONS} FROM dim_fresh")
def insert(spark, sf_dir):
    source = bank.people(spark, sf_dir)
    closed = dim.close_versions(bank.dim_prior(spark, sf_dir), source, bank.INCREMENT_DAY)
    return dim.new_versions(closed, source, bank.INCREMENT_DAY)


@query("dim_03", f"SELECT {_VERSIONS} FROM dim_now")
def one_pass(spark, sf_dir):
    return bank.dim_now(spark, sf_dir)


@query("dim_03_feed", f"SELECT {_VERSIONS} FROM dim_now")
def replayed_feed(spark, sf_dir):
    """The second delivery comes as a batch with two versions of a customer, and is replayed."""
    lake = Lake(spark, new_dir(spark, "feed"))
    lake.replace("silver/dim_customer", bank.dim_prior(spark, sf_dir).withColumn("customer_key", F.lit(None).cast("long")))
    newest = bank.people(spark, sf_dir).drop("overdrawn")
    older = newest.withColumns(
        {"city": F.lit("PASSED THROUGH"), "created_timestamp": F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")}
    )
    for _ in range(2):
        apply_customers(lake, older.unionByName(newest), 0, "feed", bank.INCREMENT_DAY)
    return lake.read("silver/dim_customer").drop("customer_key")


_EVENTS = """
  SELECT customer_id, first_name, last_name, email_address, city, state_province, country, start_date AS day FROM dim_prior
  WHERE customer_id IN (SELECT customer_id FROM people)
  UNION ALL SELECT customer_id, first_name, last_name, email_address, 'PASSED THROUGH', state_province, country,
    DATE '2021-07-01' FROM people
  UNION ALL SELECT customer_id, first_name, last_name, email_address, city, state_province, country, DATE '2024-03-06' FROM people"""


@query(
    "dim_03_history",
    f"""WITH events AS ({_EVENTS}),
      runs AS (SELECT *, lag(ROW(first_name, last_name, email_address, city, state_province, country)) OVER w AS before
               FROM events WINDOW w AS (PARTITION BY customer_id ORDER BY day)),
      starts AS (SELECT * FROM runs
                 WHERE before IS NULL OR ROW(first_name, last_name, email_address, city, state_province, country)
                       IS DISTINCT FROM before),
      bounded AS (SELECT *, lead(day) OVER (PARTITION BY customer_id ORDER BY day) AS next FROM starts)
    SELECT customer_id, first_name, last_name, email_address, city, state_province, country,
      CAST(day AS VARCHAR) AS start_date, CAST(coalesce(next - 1, DATE '9999-12-31') AS VARCHAR) AS end_date,
      CASE WHEN next IS NULL THEN 'Y' ELSE 'N' END AS current_flag FROM bounded
    UNION ALL SELECT {_VERSIONS} FROM dim_prior WHERE customer_id NOT IN (SELECT customer_id FROM people)""",
)
def every_version(spark, sf_dir):
    """The states of March come first, those of two years before after them, and both come twice."""
    lake, name = Lake(spark, new_dir(spark, "history")), "silver/dim_customer"
    lake.replace(name, bank.dim_prior(spark, sf_dir).withColumn("customer_key", F.lit(None).cast("long")))
    at = F.lit("2024-03-06 08:00:00").cast("timestamp_ntz")
    newest = bank.people(spark, sf_dir).drop("overdrawn").withColumn("created_timestamp", at)
    late = newest.withColumns(
        {"city": F.lit("PASSED THROUGH"), "created_timestamp": F.lit("2021-07-01 09:00:00").cast("timestamp_ntz")}
    )
    for batch in (newest, late, newest.unionByName(late)):
        lake.replace(name, dim.apply_history(lake.read(name), batch))
    return lake.read(name).drop("customer_key")


# Surrogate values are arbitrary; what can be checked is that each is given once.
@query(
    "dim_04",
    """SELECT COUNT(*) AS version_count, COUNT(*) AS distinct_keys, 0 AS missing_keys FROM dim_now""",
)
def surrogates(spark, sf_dir):
    numbered = dim.fill_surrogates(
        bank.dim_now(spark, sf_dir).withColumn("customer_key", F.lit(None).cast("long"))
    )
    path = new_dir(spark, "dim-customer")
    numbered.write.parquet(path)
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("version_count"),
        F.count_distinct("customer_key").alias("distinct_keys"),
        F.count_if(F.col("customer_key").isNull()).alias("missing_keys"),
    )


@query("dim_05", f"SELECT {_VERSIONS} FROM dim_now WHERE current_flag = 'Y'")
def current(spark, sf_dir):
    return dim.current_versions(bank.dim_now(spark, sf_dir))


@query(
    "dim_06",
    """SELECT account_id, customer_id, account_type, status, currency_code FROM clean_accounts""",
)
def account_merge(spark, sf_dir):
    columns = ["account_id", "customer_id", "account_type", "status", "currency_code"]
    opened = bank.tidy(bank.account_history(spark, sf_dir), "t_account").select(*columns)
    return dim.upsert(opened, bank.account_increment(spark, sf_dir))


@query(
    "dim_07",
    """SELECT DISTINCT transaction_type,
              CASE WHEN transaction_type = 'R' THEN 'edited by hand' ELSE transaction_type END AS description
       FROM transactions""",
)
def type_codes(spark, sf_dir):
    source = bank.transactions(spark, sf_dir)
    known = source.where(F.col("transaction_type") == "R").select("transaction_type").distinct()
    return dim.insert_codes(known.withColumn("description", F.lit("edited by hand")), source)


_DAYS = """
  SELECT CAST(d AS DATE) AS day
  FROM (SELECT unnest(generate_series(MIN(l_shipdate), MAX(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem)"""


@query(
    "dim_08",
    f"""SELECT CAST(day AS VARCHAR) AS date_key, year(day) AS year, month(day) AS month, day(day) AS day,
               dayofweek(day) AS day_of_week
        FROM ({_DAYS})""",
)
def calendar(spark, sf_dir):
    """Filled for the first half, then for all: a day known already is not added again."""
    source = bank.transactions(spark, sf_dir)
    early = dim.calendar_spanning(source.where(F.col("transaction_date") < F.lit(bank.CUTOFF)), "transaction_date")
    return dim.extend_calendar(early, dim.calendar_spanning(source, "transaction_date"))


@query(
    "dim_09",
    """SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, day(l_shipdate) AS day,
              dayofweek(l_shipdate) + 1 AS day_of_week, COUNT(*) AS row_count
       FROM lineitem GROUP BY ALL""",
)
def day_parts(spark, sf_dir):
    day = F.to_date("transaction_date")
    parts = bank.transactions(spark, sf_dir).select(*dim.calendar_columns(day, dow_base=1))
    return parts.groupBy("year", "month", "day", "day_of_week").agg(F.count(F.lit(1)).alias("row_count"))
