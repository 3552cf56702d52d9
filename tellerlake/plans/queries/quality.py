"""DQ: the rules, the log and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellerlake.operators import quality as dq
from tellerlake.operators.dimensions import current_versions
from tellerlake.plans import bank
from tellerlake.plans.registry import query


def _rule(number: int) -> str:
    return f"SELECT rule_no, n AS records_failed FROM faulty_counts WHERE rule_no = {number}"


@query("dq_01", _rule(1))
def customers_without_id(spark, sf_dir):
    return dq.null_rows(bank.faulty_customers(spark, sf_dir), "customer_id", 1)


@query("dq_02", _rule(2))
def accounts_without_id(spark, sf_dir):
    return dq.null_rows(bank.faulty_accounts(spark, sf_dir), "account_id", 2)


@query("dq_03", _rule(3))
def transactions_without_id(spark, sf_dir):
    return dq.null_rows(bank.faulty_transactions(spark, sf_dir), "transaction_id", 3)


@query("dq_04", _rule(4))
def repeated_customers(spark, sf_dir):
    return dq.repeated_key_count(bank.faulty_customers(spark, sf_dir), "customer_id", 4)


@query("dq_05", _rule(5))
def malformed_email(spark, sf_dir):
    checks = dq.customer_row_checks(bank.faulty_customers(spark, sf_dir))
    return checks.where(F.col("rule_no") == 5)


@query("dq_06", _rule(6))
def accounts_without_customer(spark, sf_dir):
    return dq.orphan_count(
        bank.faulty_accounts(spark, sf_dir), "customer_id",
        bank.faulty_customers(spark, sf_dir), "customer_id", 6,
    )


@query("dq_07", _rule(7))
def transactions_without_account(spark, sf_dir):
    return dq.orphan_count(
        bank.faulty_transactions(spark, sf_dir), "account_id",
        bank.faulty_accounts(spark, sf_dir), "account_id", 7,
    )


@query("dq_08", _rule(8))
def several_current_versions(spark, sf_dir):
    return dq.repeated_key_count(current_versions(bank.faulty_dim(spark, sf_dir)), "customer_id", 8)


_LOG = """log_id, run_id, strftime(check_timestamp, '%Y-%m-%d %H:%M:%S') AS check_timestamp, table_name,
  check_name, severity, records_failed, details"""


@query("dq_09", f"SELECT {_LOG} FROM faulty_run")
def log_of_run(spark, sf_dir):
    return bank.faulty_run(spark, sf_dir).drop("sample_ids")


@query(
    "dq_10",
    "SELECT COUNT(*) AS total_checks, CAST(SUM(records_failed) AS BIGINT) AS total_failures FROM faulty_run",
)
def run_summary(spark, sf_dir):
    return dq.run_summary(bank.faulty_run(spark, sf_dir))


@query(
    "dq_11",
    """SELECT severity, COUNT(*) AS check_count, CAST(SUM(records_failed) AS BIGINT) AS total_failures
       FROM quality_log WHERE run_id = (SELECT MAX(run_id) FROM quality_log) GROUP BY severity""",
)
def latest_by_severity(spark, sf_dir):
    return dq.severity_summary(dq.latest_run(bank.quality_log(spark, sf_dir)))


@query(
    "dq_12",
    """SELECT table_name, check_name, severity, records_failed, details FROM quality_log
       WHERE run_id = (SELECT MAX(run_id) FROM quality_log) AND records_failed > 0""",
)
def latest_failures(spark, sf_dir):
    return dq.failing_checks(dq.latest_run(bank.quality_log(spark, sf_dir)))


@query("dq_13", "SELECT run_id FROM quality_log ORDER BY check_timestamp DESC LIMIT 1")
def latest_by_time(spark, sf_dir):
    return dq.latest_run_id(bank.quality_log(spark, sf_dir))


@query(
    "dq_14",
    """SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE records_failed = 0) AS passed,
              COUNT(*) FILTER (WHERE severity = 'WARNING') AS warnings,
              COUNT(*) FILTER (WHERE severity = 'ERROR') AS errors,
              CAST(SUM(records_failed) AS BIGINT) AS total_flagged,
              CASE WHEN COUNT(*) FILTER (WHERE severity = 'ERROR') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
       FROM faulty_run""",
)
def latest_kpis(spark, sf_dir):
    return dq.run_kpis(dq.latest_run(bank.quality_log(spark, sf_dir), by="check_timestamp"))


@query("dq_15", "SELECT run_id, severity, COUNT(*) AS check_count FROM quality_log GROUP BY 1, 2")
def checks_per_run(spark, sf_dir):
    return dq.checks_per_run(bank.quality_log(spark, sf_dir))


@query(
    "dq_16",
    "SELECT run_id, CAST(SUM(records_failed) AS BIGINT) AS records_flagged FROM quality_log GROUP BY 1",
)
def flagged_per_run(spark, sf_dir):
    return dq.flagged_per_run(bank.quality_log(spark, sf_dir))


@query(
    "dq_17",
    """SELECT table_name, COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE severity = 'ERROR') AS errors,
              COUNT(*) FILTER (WHERE severity = 'WARNING') AS warnings,
              CAST(SUM(records_failed) AS BIGINT) AS records_flagged
       FROM faulty_run GROUP BY 1""",
)
def per_table(spark, sf_dir):
    return dq.table_summary(bank.faulty_run(spark, sf_dir))


@query("dq_18", "SELECT severity, COUNT(*) AS check_count FROM faulty_run GROUP BY 1")
def severities(spark, sf_dir):
    return dq.severity_distribution(bank.faulty_run(spark, sf_dir))


@query(
    "dq_19",
    """SELECT check_name, table_name, severity, records_failed, details FROM faulty_run
       WHERE severity IN ('ERROR', 'WARNING') AND table_name IN ('BRONZE.T_Customer', 'SILVER.DimCustomer')""",
)
def filtered(spark, sf_dir):
    chosen = dq.filter_results(
        bank.faulty_run(spark, sf_dir), ["ERROR", "WARNING"], ["BRONZE.T_Customer", "SILVER.DimCustomer"]
    )
    return chosen.select("check_name", "table_name", "severity", "records_failed", "details")


@query("dq_20", f"SELECT {_LOG} FROM quality_log")
def whole_log(spark, sf_dir):
    return dq.newest_first(bank.quality_log(spark, sf_dir)).drop("sample_ids")
