"""Data-quality rules, their log and the reports over it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.text import bad_email
from tellerlake.operators.dimensions import current_versions
from tellerlake.operators.joins import written


@dataclass(frozen=True)
class Rule:
    number: int
    table: str
    check: str
    level: str
    failed: str
    passed: str


# Rule names, levels and texts as they appear in the log.
RULES = [
    Rule(1, "BRONZE.T_Customer", "NULL_CHECK_Customer_ID", "ERROR",
         "records with NULL Customer_ID", "All records have Customer_ID"),
    Rule(2, "BRONZE.T_Account", "NULL_CHECK_Account_ID", "ERROR",
         "records with NULL Account_ID", "All records have Account_ID"),
    Rule(3, "BRONZE.T_Transaction", "NULL_CHECK_Transaction_ID", "ERROR",
         "records with NULL Transaction_ID", "All records have Transaction_ID"),
    Rule(4, "BRONZE.T_Customer", "DUPLICATE_PK", "WARNING",
         "duplicate Customer_IDs found", "No duplicate Customer_IDs"),
    Rule(5, "BRONZE.T_Customer", "EMAIL_FORMAT", "WARNING",
         "records with invalid email format", "All email addresses are valid"),
    Rule(6, "BRONZE.T_Account", "FK_CUSTOMER_REF", "ERROR",
         "accounts reference non-existent customers", "All accounts reference valid customers"),
    Rule(7, "BRONZE.T_Transaction", "FK_ACCOUNT_REF", "ERROR",
         "transactions reference non-existent accounts", "All transactions reference valid accounts"),
    Rule(8, "SILVER.DimCustomer", "SCD2_SINGLE_ACTIVE", "ERROR",
         "customers with multiple active records", "SCD-2 integrity OK"),
]
SEVERITIES = ["ERROR", "WARNING", "INFO"]


def _tall(one_row: DataFrame, counts: dict[int, Column]) -> DataFrame:
    """(rule_no, records_failed) rows from one row of aggregates."""
    cells = [F.struct(F.lit(no).alias("rule_no"), n.alias("records_failed")) for no, n in counts.items()]
    return one_row.select(F.inline(F.array(*cells)))


def null_rows(df: DataFrame, column: str, rule_no: int) -> DataFrame:
    return _tall(df.agg(F.count_if(F.col(column).isNull()).alias("n")), {rule_no: F.col("n")})


def customer_row_checks(customers: DataFrame) -> DataFrame:
    """Rules 1 and 5 in one scan."""
    found = customers.agg(
        F.count_if(F.col("customer_id").isNull()).alias("no_id"),
        F.count_if(bad_email(F.col("email_address"))).alias("bad_email"),
    )
    return _tall(found, {1: F.col("no_id"), 5: F.col("bad_email")})


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, NULL being one key; counts keys, not surplus rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def repeated_key_count(df: DataFrame, key: str, rule_no: int) -> DataFrame:
    return _tall(repeated_keys(df, key).agg(F.count(F.lit(1)).alias("n")), {rule_no: F.col("n")})


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str, rule_no: int) -> DataFrame:
    """Child rows without a parent, NULL references included.

    Children are folded to one row per reference and parents to distinct keys
    before they meet, so neither a hot reference nor a much-copied parent
    reaches one task whole.
    """
    references = child.groupBy(F.col(fk).alias("_ref")).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(pk).alias("_ref")).distinct()
    missing = references.join(known, "_ref", "left_anti")
    return _tall(missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")), {rule_no: F.col("n")})


def failure_counts(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            customer_row_checks(customers),
            null_rows(accounts, "account_id", 2),
            null_rows(transactions, "transaction_id", 3),
            repeated_key_count(customers, "customer_id", 4),
            orphan_count(accounts, "customer_id", customers, "customer_id", 6),
            orphan_count(transactions, "account_id", accounts, "account_id", 7),
            active_version_check(dim_customer),
        ],
    )


@dataclass(frozen=True)
class Change:
    """A loaded table between two checks: the rows that stayed, and those of changed loads then and now."""

    rest: DataFrame
    then: DataFrame
    now: DataFrame

    def sides(self, *columns: str) -> DataFrame:
        """What changed: ``before`` and ``after`` are 1 for a row that was, or is, there."""
        then = self.then.select(*columns, F.lit(1).alias("before"), F.lit(0).alias("after"))
        return then.unionByName(self.now.select(*columns, F.lit(0).alias("before"), F.lit(1).alias("after")))


def _among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is one of ``keys`` (_key), NULL being one; only the few written keys move."""
    return rows.join(keys, F.col(column).eqNullSafe(F.col("_key")), "left_semi")


def row_check_change(table: Change, tests: dict[int, tuple[str, Column]]) -> DataFrame:
    """How many more rows than before fail each test of one column."""
    sides = table.sides(*dict.fromkeys(column for column, _ in tests.values()))
    moved = F.col("after") - F.col("before")
    counts = {no: F.coalesce(F.sum(F.when(test, moved)), F.lit(0)) for no, (_, test) in tests.items()}
    found = sides.agg(*[n.alias(f"n{no}") for no, n in counts.items()])
    return _tall(found, {no: F.col(f"n{no}") for no in tests})


def repeated_key_change(table: Change, key: str, rule_no: int) -> DataFrame:
    """How many more keys than before are on more than one row.

    Only keys of the changed loads can have begun or ceased to repeat, so only
    their copies are counted in the rest of the table.
    """
    moved = table.sides(key).groupBy(F.col(key).alias("_key")).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    moved = written(moved, "moved-keys")
    others = _among(table.rest.select(key), key, moved.select("_key")).groupBy(F.col(key).alias("_other"))
    copies = moved.join(others.agg(F.count(F.lit(1)).alias("others")), F.col("_key").eqNullSafe(F.col("_other")), "left")
    others = F.coalesce("others", F.lit(0))
    change = (F.col("after") + others > 1).cast("int") - (F.col("before") + others > 1).cast("int")
    return _tall(copies.agg(F.coalesce(F.sum(change), F.lit(0)).alias("n")), {rule_no: F.col("n")})


def orphan_change(child: Change, fk: str, parent: Change, pk: str, rule_no: int) -> DataFrame:
    """How many more child rows than before have no parent.

    Children of changed loads are looked up among the parents of their time.
    Children that stayed change sides only if their parent came or went for good.
    """
    keys = parent.sides(pk).groupBy(F.col(pk).alias("_key")).agg(F.max("before").alias("before"), F.max("after").alias("after"))
    keys = written(keys.where("_key IS NOT NULL AND before <> after"), "moved-parents")
    staying = _among(parent.rest.select(pk), pk, keys.select("_key")).select(F.col(pk).alias("_key")).distinct()
    flips = written(keys.join(staying, "_key", "left_anti"), "flipped-parents")
    stayed = child.rest.select(F.col(fk).alias("_ref")).join(flips, F.col("_ref") == F.col("_key"))
    stayed = stayed.agg(F.coalesce(F.sum(F.col("before") - F.col("after")), F.lit(0)).alias("n"))

    refs = child.sides(fk).groupBy(F.col(fk).alias("_ref")).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    refs = written(refs, "moved-references")
    wanted = refs.select(F.col("_ref").alias("_key"))
    known = _among(parent.rest.select(pk), pk, wanted).select(F.col(pk).alias("_known")).distinct().withColumns({"was": F.lit(1), "is": F.lit(1)})
    own = _among(parent.sides(pk), pk, wanted).select(F.col(pk).alias("_known"), F.col("before").alias("was"), F.col("after").alias("is"))
    known = known.unionByName(own).groupBy("_known").agg(F.max("was").alias("was"), F.max("is").alias("is"))
    # A NULL reference equals no parent.
    met = refs.join(known, F.col("_ref") == F.col("_known"), "left")
    lacking = F.when(F.coalesce("is", F.lit(0)) == 0, F.col("after")).otherwise(0)
    lacked = F.when(F.coalesce("was", F.lit(0)) == 0, F.col("before")).otherwise(0)
    changed = met.agg(F.coalesce(F.sum(lacking - lacked), F.lit(0)).alias("n"))
    return _tall(stayed.union(changed).agg(F.sum("n").alias("n")), {rule_no: F.col("n")})


def count_changes(customers: Change | None, accounts: Change | None, transactions: Change | None) -> list[DataFrame]:
    """(rule_no, records_failed) of what the loaded tables' changes add to their rules; None for an unchanged table.

    A rule over two tables needs both as Change, with nothing changed in one of them.
    """
    parts = []
    if customers:
        email = {5: ("email_address", bad_email(F.col("email_address")))}
        parts.append(row_check_change(customers, {1: ("customer_id", F.col("customer_id").isNull()), **email}))
        parts.append(repeated_key_change(customers, "customer_id", 4))
    if accounts:
        parts.append(row_check_change(accounts, {2: ("account_id", F.col("account_id").isNull())}))
    if transactions:
        parts.append(row_check_change(transactions, {3: ("transaction_id", F.col("transaction_id").isNull())}))
    if accounts and customers:
        parts.append(orphan_change(accounts, "customer_id", customers, "customer_id", 6))
    if transactions and accounts:
        parts.append(orphan_change(transactions, "account_id", accounts, "account_id", 7))
    return parts


def kept_counts(run: DataFrame) -> DataFrame:
    """(rule_no, records_failed) of a run's log rows."""
    numbers = F.create_map(*[F.lit(x) for rule in RULES for x in (f"{rule.table} {rule.check}", rule.number)])
    return run.select(numbers[F.concat_ws(" ", "table_name", "check_name")].alias("rule_no"), "records_failed")


def added_up(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("rule_no").agg(F.sum("records_failed").alias("records_failed"))


def active_version_check(dim_customer: DataFrame) -> DataFrame:
    return repeated_key_count(current_versions(dim_customer), "customer_id", 8)


def _by_rule(attribute: str) -> Column:
    pairs = [F.lit(x) for rule in RULES for x in (rule.number, getattr(rule, attribute))]
    return F.create_map(*pairs)[F.col("rule_no")]


def log_rows(counts: DataFrame, run_id: str, checked_at: datetime, first_log_id: int = 1) -> DataFrame:
    """Log entries for one run; a rule without failures is logged as INFO."""
    n = F.col("records_failed")
    return counts.select(
        (F.lit(first_log_id - 1).cast("bigint") + F.col("rule_no")).alias("log_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(checked_at).cast("timestamp_ntz").alias("check_timestamp"),
        _by_rule("table").alias("table_name"),
        _by_rule("check").alias("check_name"),
        F.when(n > 0, _by_rule("level")).otherwise("INFO").alias("severity"),
        n.cast("bigint").alias("records_failed"),
        F.lit(None).cast("string").alias("sample_ids"),
        F.when(n > 0, F.concat(n.cast("string"), F.lit(" "), _by_rule("failed")))
        .otherwise(_by_rule("passed"))
        .alias("details"),
    )


def run_id_at(moment: datetime) -> str:
    return moment.strftime("%Y%m%d_%H%M%S")


def run_checks(
    customers: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    dim_customer: DataFrame,
    checked_at: datetime,
    run_id: str | None = None,
    first_log_id: int = 1,
) -> DataFrame:
    counts = failure_counts(customers, accounts, transactions, dim_customer)
    return log_rows(counts, run_id or run_id_at(checked_at), checked_at, first_log_id)


# Reports. The log has a few rows per run, so these are small whatever the tables' size.


def run_summary(run: DataFrame) -> DataFrame:
    return run.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.coalesce(F.sum("records_failed"), F.lit(0)).alias("total_failures"),
    )


def latest_run(log: DataFrame, by: str = "run_id") -> DataFrame:
    """Entries of the newest run: greatest run id, or the run of the newest timestamp."""
    order = {"run_id": F.col("run_id"), "check_timestamp": F.struct("check_timestamp", "run_id")}[by]
    newest = log.agg(F.max_by("run_id", order).alias("run_id"))
    return log.join(newest, "run_id", "left_semi")


def _severity_rank() -> Column:
    return F.when(F.col("severity") == "ERROR", 1).when(F.col("severity") == "WARNING", 2).otherwise(3)


def severity_summary(run: DataFrame) -> DataFrame:
    return (
        run.groupBy("severity")
        .agg(F.count(F.lit(1)).alias("check_count"), F.sum("records_failed").alias("total_failures"))
        .orderBy(_severity_rank())
    )


def failing_checks(run: DataFrame) -> DataFrame:
    return (
        run.where(F.col("records_failed") > 0)
        .select("table_name", "check_name", "severity", "records_failed", "details")
        .orderBy(_severity_rank(), "table_name", "check_name")
    )


def latest_run_id(log: DataFrame) -> DataFrame:
    return log.orderBy(F.col("check_timestamp").desc(), F.col("run_id").desc()).select("run_id").limit(1)


def run_kpis(run: DataFrame) -> DataFrame:
    errors = F.count_if(F.col("severity") == "ERROR")
    return run.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("records_failed") == 0).alias("passed"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"),
        errors.alias("errors"),
        F.coalesce(F.sum("records_failed"), F.lit(0)).alias("total_flagged"),
        F.when(errors == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def checks_per_run(log: DataFrame) -> DataFrame:
    return log.groupBy("run_id", "severity").agg(F.count(F.lit(1)).alias("check_count"))


def flagged_per_run(log: DataFrame) -> DataFrame:
    return log.groupBy("run_id").agg(F.sum("records_failed").alias("records_flagged"))


def table_summary(run: DataFrame) -> DataFrame:
    return run.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"),
        F.sum("records_failed").alias("records_flagged"),
    )


def severity_distribution(run: DataFrame) -> DataFrame:
    return run.groupBy("severity").agg(F.count(F.lit(1)).alias("check_count"))


def filter_results(run: DataFrame, severities: list[str], tables: list[str]) -> DataFrame:
    return run.where(F.col("severity").isin(severities) & F.col("table_name").isin(tables))


def newest_first(log: DataFrame) -> DataFrame:
    return log.orderBy(F.col("check_timestamp").desc(), F.col("log_id").desc())
