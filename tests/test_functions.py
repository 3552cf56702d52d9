from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tellerlake.functions import dates, masks, numbers, text


def one(spark, value, kind, build):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("r")).first().r


def test_masks(spark):
    cases = [
        ("MASK_NAME", "James", "J***"),
        ("MASK_NAME", "", "***"),
        ("MASK_NAME", None, None),
        ("MASK_EMAIL", "james.anderson@email.com", "j***@email.com"),
        ("MASK_EMAIL", "no-at-sign", "n***@"),
        ("MASK_EMAIL", None, None),
        ("MASK_PHONE", "416-555-0101", "***-***-0101"),
        ("MASK_PHONE", "12", "***-***-12"),
        ("MASK_LOCATION", "Toronto", "T***"),
        ("MASK_FINANCIAL_ID", "ACCT-1001", "ACCT-***"),
        ("MASK_FINANCIAL_ID", "1001", "1001-***"),
        ("MASK_FINANCIAL_ID", None, None),
    ]
    for policy, clear, wanted in cases:
        assert one(spark, clear, "string", masks.POLICIES[policy]) == wanted, (policy, clear)


def test_amount_mask_zeroes_null_too(spark):
    for value in (Decimal("2500.00"), None):
        assert one(spark, value, "decimal(18,2)", masks.amount) == Decimal("0.00")


def test_day_of_week_bases(spark):
    sunday = date(2024, 3, 3)
    assert one(spark, sunday, "date", dates.day_of_week) == 0
    assert one(spark, sunday, "date", lambda c: dates.day_of_week(c, base=1)) == 1
    assert one(spark, date(2024, 3, 9), "date", dates.day_of_week) == 6


def test_month_start_and_epoch(spark):
    assert one(spark, date(2024, 2, 29), "date", dates.month_start) == date(2024, 2, 1)
    assert one(spark, 1_700_000_000_123_456, "bigint", dates.from_epoch_micros) == datetime(
        2023, 11, 14, 22, 13, 20, 123456
    )
    assert one(spark, datetime(2024, 3, 6, 1, 2, 3), "timestamp_ntz", dates.run_stamp) == "20240306_010203"


def test_email_rule(spark):
    good = ["a@b.co", "first.last+tag@sub.example.org", "A_1%-x@ex-ample.com"]
    bad = ["", "a@b", "a b@c.com", "a@b.c", "@b.com", "a@b.com ", "a@@b.com"]
    for value in good:
        assert one(spark, value, "string", text.bad_email) is False, value
    for value in bad:
        assert one(spark, value, "string", text.bad_email) is True, value
    assert one(spark, None, "string", text.bad_email) is False


def test_names_and_ratio(spark):
    df = spark.createDataFrame([("Ann", "Lee", Decimal("10.00"), 4), ("Ann", None, None, 0)],
                               "f string, l string, t decimal(18,2), n int")
    rows = df.select(
        text.full_name(F.col("f"), F.col("l")).alias("name"), numbers.ratio(F.col("t"), F.col("n")).alias("r")
    ).collect()
    assert [tuple(r) for r in rows] == [("Ann Lee", 2.5), (None, None)]
