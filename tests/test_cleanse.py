from collections import defaultdict
from datetime import datetime
from random import Random

from tellerlake.operators import cleanse
from tellerlake.schemas import ACCOUNT_FILE, CUSTOMER_FILE, with_audit

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def customers(spark, *rows):
    full = [(i, f, None, e, None, None, None, None, None, at, 1) for i, f, e, at in rows]
    return spark.createDataFrame(full, with_audit(CUSTOMER_FILE))


def test_tidy_customers(spark):
    df = customers(spark, ("  C1 ", "\tAnn ", " A@B.COM ", T1), ("C2", None, None, T1))
    got = [(r.customer_id, r.first_name, r.email_address) for r in cleanse.tidy(df, "t_customer").collect()]
    # Only blanks are trimmed: the tab stays.
    assert got == [("C1", "\tAnn", "a@b.com"), ("C2", None, None)]


def test_default_currency_is_for_null_only(spark):
    rows = [("A1", "C1", None, None, c, None, None, T1, 1) for c in (None, "  ", " USD ", "CAD")]
    df = spark.createDataFrame(rows, with_audit(ACCOUNT_FILE))
    assert [r.currency_code for r in cleanse.tidy(df, "t_account").collect()] == ["CAD", "", "USD", "CAD"]
    assert cleanse.count_untidy(df, "t_account").first().rows_to_change == 3


def test_tidy_twice_is_tidy_once(spark):
    df = customers(spark, (" C1", " Ann", "X@Y.Z ", T1), ("C2", "Bob", None, T1))
    once = cleanse.tidy(df, "t_customer")
    assert cleanse.count_untidy(once, "t_customer").first().rows_to_change == 0


def test_keys_that_differ_by_blanks_are_one_key(spark):
    df = customers(spark, ("C1", "old", None, T1), ("C1 ", "new", None, T2))
    assert [r.first_name for r in cleanse.cleanse(df, "t_customer").collect()] == ["new"]


def test_ties_null_keys_and_null_times_stay(spark):
    df = customers(
        spark,
        ("C1", "older", None, T1),
        ("C1", "tie a", None, T2),
        ("C1", "tie b", None, T2),
        ("C1", "no time", None, None),
        (None, "n1", None, T1),
        (None, "n2", None, T2),
        ("C2", "single", None, T1),
    )
    kept = {r.first_name for r in cleanse.keep_latest(df, "customer_id").collect()}
    assert kept == {"tie a", "tie b", "no time", "n1", "n2", "single"}


def test_keep_latest_against_brute_force(spark):
    rng = Random(7)
    rows = [
        # A third of the rows share one key.
        ("hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", "d", None]), str(n), None,
         rng.choice([T1, T2, datetime(2024, 1, 3), None]))
        for n in range(300)
    ]
    newest = defaultdict(lambda: datetime.min)
    for key, _, _, at in rows:
        if at is not None:
            newest[key] = max(newest[key], at)
    wanted = {n for key, n, _, at in rows if key is None or at is None or at >= newest[key]}
    got = {r.first_name for r in cleanse.keep_latest(customers(spark, *rows), "customer_id").collect()}
    assert got == wanted


def test_superseded_rows_are_what_is_dropped(spark):
    df = customers(spark, ("C1", "x", None, T1), ("C1", "y", None, T2), ("C2", "z", None, T1))
    stale = cleanse.stale_keys(df, "customer_id")
    hit = cleanse.superseded_rows(df, stale, "customer_id")
    assert {r.first_name for r in hit.collect()} == {"x"} and hit.columns == df.columns
