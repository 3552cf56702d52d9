from datetime import date, datetime
from random import Random

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import dimensions as dim
from tellerlake.operators.joins import written
from tellerlake.schemas import DIM_CUSTOMER, TRACKED

D0, D1, D2 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
OPEN = date(9999, 12, 31)


def source(spark, *rows):
    """Rows of (id, city, phone); the other attributes are constant."""
    full = [(i, "f", "l", "e@x.com", city, "s", "c", phone) for i, city, phone in rows]
    return spark.createDataFrame(
        full, "customer_id string, " + ", ".join(f"{c} string" for c in TRACKED) + ", phone_number string"
    )


def versions(spark, *rows):
    """Rows of (key, id, city, start, end, flag)."""
    full = [(k, i, "f", "l", "e@x.com", city, "s", "c", a, b, flag) for k, i, city, a, b, flag in rows]
    return spark.createDataFrame(full, DIM_CUSTOMER)


def state(df):
    return sorted(
        ((r.customer_id, r.city, r.start_date, r.end_date, r.current_flag) for r in df.collect()),
        key=str,
    )


def two_step(held, incoming, as_of):
    """Close, then insert, row by row, with SQL's <> (NULL on either side is no difference)."""
    def differs(a, b):
        return a is not None and b is not None and a != b

    closed = []
    for key, city, start, end, flag in held:
        if flag == "Y" and any(key is not None and k == key and differs(city, c) for k, c in incoming):
            end, flag = date.fromordinal(as_of.toordinal() - 1), "N"
        closed.append((key, city, start, end, flag))
    result = list(closed)
    for k, c in incoming:
        matches = [row for row in closed if k is not None and row[0] == k and row[4] == "Y"]
        if not matches or any(differs(row[1], c) for row in matches):
            result.append((k, c, as_of, OPEN, "Y"))
    return sorted(result, key=str)


def test_changed_new_unchanged_and_history(spark):
    held = versions(
        spark,
        (1, "same", "Rome", D0, OPEN, "Y"),
        (2, "moved", "Oslo", D0, OPEN, "Y"),
        (3, "moved", "Bern", date(2020, 1, 1), date(2023, 12, 31), "N"),
        (4, "gone", "Kyiv", D0, OPEN, "Y"),
    )
    incoming = source(spark, ("same", "Rome", "new phone"), ("moved", "Lima", None), ("new", "Cork", None))
    got = dim.apply_scd2(held, incoming, D1)
    assert state(got) == sorted(
        [
            ("same", "Rome", D0, OPEN, "Y"),
            ("moved", "Oslo", D0, date(2024, 1, 31), "N"),
            ("moved", "Bern", date(2020, 1, 1), date(2023, 12, 31), "N"),
            ("moved", "Lima", D1, OPEN, "Y"),
            ("gone", "Kyiv", D0, OPEN, "Y"),
            ("new", "Cork", D1, OPEN, "Y"),
        ],
        key=str,
    )
    keys = {r.customer_id: r.customer_key for r in got.where("current_flag = 'Y'").collect()}
    assert keys["same"] == 1 and keys["new"] is None and keys["moved"] is None


def test_null_changes_only_count_when_asked(spark):
    held = versions(spark, (1, "a", None, D0, OPEN, "Y"), (2, "b", "Rome", D0, OPEN, "Y"))
    incoming = source(spark, ("a", "Rome", None), ("b", None, None))
    assert state(dim.apply_scd2(held, incoming, D1)) == state(held)
    assert len(state(dim.apply_scd2(held, incoming, D1, null_safe=True))) == 4


def test_unchanged_source_changes_nothing(spark):
    held = versions(spark, (1, "a", "Rome", D0, OPEN, "Y"))
    once = dim.apply_scd2(held, source(spark, ("a", "Oslo", None)), D1)
    again = dim.apply_scd2(once, source(spark, ("a", "Oslo", None)), D2)
    assert state(again) == state(once)


def test_two_changes_on_one_day_leave_an_interval_that_ends_before_it_starts(spark):
    held = versions(spark, (1, "a", "Rome", D0, OPEN, "Y"))
    once = dim.apply_scd2(held, source(spark, ("a", "Oslo", None)), D1)
    twice = dim.apply_scd2(once, source(spark, ("a", "Lima", None)), D1)
    assert ("a", "Oslo", D1, date(2024, 1, 31), "N") in state(twice)
    assert ("a", "Lima", D1, OPEN, "Y") in state(twice)


@pytest.mark.parametrize("seed", range(6))
def test_one_pass_equals_two_steps(spark, seed):
    """Copies of a key on either side, NULL keys, NULL attributes, closed versions, a hot key."""
    rng = Random(seed)

    def pick_key():
        return "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", "d", "e", None])

    def pick_city():
        return rng.choice(["Rome", "Oslo", None])

    held = [(pick_key(), pick_city(), D0, OPEN, rng.choice("YYN")) for _ in range(12)]
    incoming = [(pick_key(), pick_city()) for _ in range(12)]
    got = dim.apply_scd2(
        versions(spark, *[(n, *row) for n, row in enumerate(held)]),
        source(spark, *[(k, c, None) for k, c in incoming]),
        D1,
    )
    assert state(got) == two_step(held, incoming, D1)


def test_surrogates_are_unique_and_old_ones_stay(spark):
    old = spark.range(5).select(F.col("id").alias("customer_key"))
    fresh = spark.range(1000).repartition(4).select(F.lit(None).cast("long").alias("customer_key"))
    rows = [r.customer_key for r in dim.fill_surrogates(old.union(fresh), highest=4).collect()]
    assert len(set(rows)) == 1005 and {0, 1, 2, 3, 4} <= set(rows) and min(set(rows) - {0, 1, 2, 3, 4}) > 4


ACCOUNT = "account_id string, customer_id string, account_type string, status string, currency_code string"


def test_upsert(spark):
    held = spark.createDataFrame([("A1", "C1", "t", "Active", "CAD"), ("A2", "C1", "t", "Active", "CAD")], ACCOUNT)
    incoming = spark.createDataFrame([("A2", "C2", "t", None, "USD"), ("A3", "C3", "t", "New", "CAD")], ACCOUNT)
    assert sorted(tuple(r) for r in dim.upsert(held, incoming).collect()) == [
        ("A1", "C1", "t", "Active", "CAD"),
        ("A2", "C2", "t", None, "USD"),
        ("A3", "C3", "t", "New", "CAD"),
    ]


def test_upsert_refuses_or_resolves_repeated_keys(spark):
    held = spark.createDataFrame([], ACCOUNT)
    incoming = spark.createDataFrame(
        [("A1", "C1", "t", "Old", "CAD", 1), ("A1", "C1", "t", "New", "CAD", 2)], ACCOUNT + ", _loaded_at int"
    )
    with pytest.raises(dim.DuplicateKeyError, match="A1"):
        dim.upsert(held, incoming)
    assert [r.status for r in dim.upsert(held, incoming, on_duplicate="latest").collect()] == ["New"]
    with pytest.raises(ValueError):
        dim.upsert(held, incoming, on_duplicate="any")


def test_codes(spark):
    held = spark.createDataFrame([("Fee", "edited")], "transaction_type string, description string")
    incoming = spark.createDataFrame([("Fee",), ("Cash",), ("Cash",), (None,)], "transaction_type string")
    assert sorted(tuple(r) for r in dim.insert_codes(held, incoming).collect()) == [
        ("Cash", "Cash"),
        ("Fee", "edited"),
    ]


def test_calendar(spark):
    days = dim.calendar(spark, date(2023, 12, 30), date(2024, 3, 1))
    assert days.count() == 63
    leap = days.where(F.col("date_key") == F.lit(date(2024, 2, 29))).first()
    assert (leap.year, leap.month, leap.day, leap.day_of_week) == (2024, 2, 29, 4)
    assert dim.calendar(spark, D0, D0).count() == 1
    assert dim.calendar(spark, date(2020, 1, 1), date(2030, 12, 31)).count() == 4018


def test_calendar_refill_adds_only_missing_days(spark):
    first = dim.calendar(spark, D0, date(2024, 1, 10))
    more = dim.extend_calendar(first, dim.calendar(spark, date(2024, 1, 8), date(2024, 1, 12)))
    assert more.count() == 12 and more.select("date_key").distinct().count() == 12
    assert dim.extend_calendar(first, first).count() == 10


EVENT = "customer_id string, " + ", ".join(f"{c} string" for c in TRACKED) + ", created_timestamp timestamp_ntz"


def events(spark, *rows):
    """Rows of (id, city, time)."""
    return spark.createDataFrame([(i, "f", "l", "e@x.com", city, "s", "c", at) for i, city, at in rows], EVENT)


def history(rows):
    """Versions of (id, city, time) rows: the last state of a day, equal neighbours as one."""
    out = []
    for key in {r[0] for r in rows}:
        days = {}
        for _, city, at in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1] or "")):
            days[at.date()] = city
        runs = [(d, c) for n, (d, c) in enumerate(sorted(days.items())) if n == 0 or sorted(days.items())[n - 1][1] != c]
        for n, (day, city) in enumerate(runs):
            last = n + 1 == len(runs)
            end = OPEN if last else date.fromordinal(runs[n + 1][0].toordinal() - 1)
            out.append((key, city, day, end, "Y" if last else "N"))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_history_does_not_depend_on_how_events_are_batched(spark, seed):
    rng = Random(seed)
    # One event a key and time; several a day, in batches that are late against each other.
    rows = list({(i, d, h): (i, rng.choice(["a", "b", None]), datetime(2024, 1, d, h))
                 for i, d, h in [(f"c{rng.randrange(5)}", rng.randrange(1, 9), rng.randrange(3)) for _ in range(60)]}.values())
    by_day = {}
    for row in rows:
        by_day.setdefault((row[0], row[2].date()), []).append(row)
    batches = [[], [], []]
    for same_day in by_day.values():
        rng.choice(batches).extend(same_day)
    held = versions(spark, (7, "other", "x", D0, D1, "N"), (8, "other", "y", D1, OPEN, "Y"))
    for batch in [*batches, batches[0], rows]:
        held = written(dim.apply_history(held, events(spark, *batch)), "held")
    kept = [("other", "x", D0, D1, "N"), ("other", "y", D1, OPEN, "Y")]
    assert state(held) == sorted(history(rows) + kept, key=str)
    current = dim.current_versions(held).groupBy("customer_id").count()
    assert current.where("count > 1").count() == 0


def test_late_events_take_their_place_and_versions_keep_their_surrogate(spark):
    held = versions(spark, (1, "c", "old", D0, date(2024, 2, 29), "N"), (2, "c", "new", D2, OPEN, "Y"))
    at = lambda day: datetime.combine(day, datetime.min.time())
    late = dim.apply_history(held, events(spark, ("c", "between", at(D1)), ("d", "first", at(D1))))
    assert state(late) == [
        ("c", "between", D1, date(2024, 2, 29), "N"), ("c", "new", D2, OPEN, "Y"), ("c", "old", D0, date(2024, 1, 31), "N"),
        ("d", "first", D1, OPEN, "Y"),
    ]
    assert {r.city: r.customer_key for r in late.collect()} == {"old": 1, "between": None, "new": 2, "first": None}
    assert state(dim.apply_history(held, events(spark, ("c", "old", at(D1))))) == state(held)
    assert state(dim.apply_history(held, events(spark))) == state(held)
    with pytest.raises(Exception, match="without a time"):
        dim.apply_history(held, events(spark, ("c", "x", None))).collect()
