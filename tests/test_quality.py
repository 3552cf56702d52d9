import random
from datetime import date, datetime

import pytest

from tellerlake.operators import quality as dq
from tellerlake.schemas import ACCOUNT_FILE, CUSTOMER_FILE, DIM_CUSTOMER, TRANSACTION_FILE

AT = datetime(2024, 3, 6, 1, 2, 3)


@pytest.fixture(scope="module")
def tables(spark):
    def rows(schema, *found):
        width = len(schema.fields)
        return spark.createDataFrame([tuple(row) + (None,) * (width - len(row)) for row in found], schema)

    customers = rows(
        CUSTOMER_FILE,
        ("C1", "a", "b", "good@x.com"),
        ("C2", "a", "b", "bad"),
        ("C2", "a", "b", None),
        ("C3", "a", "b", "also bad@x.com"),
        ("C3", "a", "b", "x@y.org"),
        (None, "a", "b", None),
        (None, "a", "b", None),
    )
    accounts = rows(ACCOUNT_FILE, ("A1", "C1"), ("A2", "C9"), ("A3", None), (None, "C2"))
    transactions = rows(TRANSACTION_FILE, ("T1", "A1"), ("T2", "A8"), ("T3", None), (None, "A2"))
    day = date(2024, 1, 1)
    version = ("f", "l", "e", "c", "s", "c", day, day)
    dim = spark.createDataFrame(
        [(1, "C1", *version, "Y"), (2, "C1", *version, "N"), (3, "C2", *version, "Y"), (4, "C2", *version, "Y"),
         (5, "C2", *version, "Y"), (6, "C3", *version, "N"), (7, "C3", *version, "N")],
        DIM_CUSTOMER,
    )
    return customers, accounts, transactions, dim


def test_every_rule(tables):
    counts = {r.rule_no: r.records_failed for r in dq.failure_counts(*tables).collect()}
    # NULL is one repeated customer id; a NULL reference is an orphan.
    assert counts == {1: 2, 2: 1, 3: 1, 4: 3, 5: 2, 6: 2, 7: 2, 8: 1}


def test_log_rows(tables):
    rows = {r.check_name: r for r in dq.run_checks(*tables, AT, first_log_id=9).collect()}
    assert len(rows) == 8 and sorted(r.log_id for r in rows.values()) == list(range(9, 17))
    assert {r.run_id for r in rows.values()} == {"20240306_010203"}
    duplicate = rows["DUPLICATE_PK"]
    assert (duplicate.severity, duplicate.details) == ("WARNING", "3 duplicate Customer_IDs found")
    assert rows["FK_ACCOUNT_REF"].severity == "ERROR"


def test_empty_tables_pass(tables):
    empty = [t.limit(0) for t in tables]
    rows = dq.run_checks(*empty, AT).collect()
    assert {(r.severity, r.records_failed) for r in rows} == {("INFO", 0)}
    assert "SCD-2 integrity OK" in {r.details for r in rows}


def test_newest_run_by_id_and_by_time(spark):
    log = spark.createDataFrame(
        [("20240102_000000", datetime(2024, 1, 1), "ERROR", 3), ("20240101_000000", datetime(2024, 1, 2), "INFO", 0)],
        "run_id string, check_timestamp timestamp_ntz, severity string, records_failed long",
    )
    assert dq.latest_run(log).first().run_id == "20240102_000000"
    assert dq.latest_run(log, by="check_timestamp").first().run_id == "20240101_000000"
    assert dq.latest_run_id(log).first().run_id == "20240101_000000"


def test_reports(tables, spark):
    run = dq.run_checks(*tables, AT)
    kpis = dq.run_kpis(run).first()
    assert (kpis.total_checks, kpis.passed, kpis.warnings, kpis.errors, kpis.status) == (8, 0, 2, 6, "FAIL")
    assert kpis.total_flagged == 14 == dq.run_summary(run).first().total_failures
    assert [r.severity for r in dq.severity_summary(run).collect()] == ["ERROR", "WARNING"]
    assert dq.run_kpis(run.limit(0)).first().status == "PASS"


def test_changes_add_up_to_a_full_check(spark):
    """Random tables before and after: loads that stayed, went, came and were rewritten, with NULL keys."""
    rng = random.Random(8)
    key = lambda: rng.choice([None, *map(str, range(14))])
    mail = lambda: rng.choice([None, "a@b.com", "nowhere"])
    kinds = {
        "c": ("customer_id string, email_address string", lambda: (key(), mail())),
        "a": ("account_id string, customer_id string", lambda: (key(), key())),
        "t": ("transaction_id string, account_id string", lambda: (key(), key())),
    }
    dim = spark.createDataFrame([], "customer_id string, current_flag string")
    for _ in range(4):
        changes, before, after = [], [], []
        for schema, row in kinds.values():
            rest, then, now = ([row() for _ in range(rng.choice([0, 4, 9]))] for _ in range(3))
            made = [spark.createDataFrame(rows, schema) for rows in (rest, then, now)]
            changes.append(dq.Change(*made))
            before.append(made[0].union(made[1]))
            after.append(made[0].union(made[2]))
        full = lambda tables: {r.rule_no: r.records_failed for r in dq.failure_counts(*tables, dim).collect()}
        kept = spark.createDataFrame(list(full(before).items()), "rule_no int, records_failed bigint")
        merged = dq.added_up([kept, *dq.count_changes(*changes)])
        assert {r.rule_no: r.records_failed for r in merged.collect()} == full(after)
