import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import StringType, StructField, StructType

from tellerlake.schemas import ACCOUNT_FILE, TRANSACTION_FILE
from tellerlake.sources import files, quoted

ABC = StructType([StructField(c, StringType()) for c in "abc"])


def write(path, text):
    path.write_text(text)
    return str(path)


def test_ragged_quoted_and_null_fields(spark, tmp_path):
    path = write(
        tmp_path / "x.csv",
        'Wrong,Header,Names\n1,x\n2,y,z,extra,more\n3,"a, b",c\n4,,NULL\n5,"NULL",""\n6,"say ""hi""",null\n',
    )
    got = [tuple(r) for r in files.read_csv(spark, path, ABC).orderBy("a").collect()]
    assert got == [
        ("1", "x", None),
        ("2", "y", "z"),
        ("3", "a, b", "c"),
        ("4", None, None),
        ("5", None, None),
        ("6", 'say "hi"', "null"),
    ]


def test_typed_load(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        "a,b,c,d,e,f\nT1,A1,2024-02-29 09:15:22,Fee,2500.5,x\nT2,A1,2024-03-01 00:00:00,,,NULL\n",
    )
    rows = files.read_csv(spark, path, TRANSACTION_FILE).orderBy("transaction_id").collect()
    assert rows[0].transaction_date == datetime(2024, 2, 29, 9, 15, 22) and rows[0].amount == Decimal("2500.50")
    assert (rows[1].transaction_type, rows[1].amount, rows[1].description) == (None, None, None)


@pytest.mark.parametrize("bad", ["2024-02-30 00:00:00,Fee,1.00", "2024-02-28 00:00:00,Fee,1O.00"])
def test_a_bad_value_aborts_and_leaves_nothing(spark, tmp_path, bad):
    good = "T1,A1,2024-02-28 00:00:00,Fee,1.00,x\n"
    path = write(tmp_path / "t.csv", f"a,b,c,d,e,f\n{good}T2,A1,{bad},x\n")
    with pytest.raises(PySparkException, match="cannot load"):
        files.read_csv(spark, path, TRANSACTION_FILE).write.parquet(f"{tmp_path}/out")
    assert not (tmp_path / "out" / "_SUCCESS").exists()


def test_conform_by_name(spark):
    df = spark.createDataFrame(
        [(1_700_000_000_000_000, 12.345, "A1", "T1", "junk")],
        "Transaction_Date bigint, AMOUNT double, Account_ID string, Transaction_ID string, other string",
    )
    row = files.conform(df, TRANSACTION_FILE).first()
    assert row.transaction_date == datetime(2023, 11, 14, 22, 13, 20)
    assert (row.amount, row.transaction_type) == (Decimal("12.35"), None)


def test_audit_columns(spark):
    at = datetime(2024, 1, 1, 5)
    df = spark.createDataFrame([("A1", date(2024, 1, 1))], "account_id string, open_date date")
    row = files.with_load_audit(df, 3, at).first()
    assert (row._loaded_at, row._load_id, row.created_timestamp) == (at, 3, at)
    txn = spark.createDataFrame([("T1",)], "transaction_id string")
    assert "created_timestamp" not in files.with_load_audit(txn, 3, at).columns


def test_only_new_files_are_read(spark, tmp_path):
    line = "A1,C1,t,s,CAD,2024-01-01,2024-01-01 00:00:00\n"
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "one.csv", "h\n" + line)
    write(tmp_path / "in" / "note.txt", "not a delivery")
    log = spark.createDataFrame([], "path string")
    rows, loaded = files.read_new_csv(spark, f"{tmp_path}/in", ACCOUNT_FILE, log)
    assert rows.count() == 1
    write(tmp_path / "in" / "two.csv", "h\n" + line.replace("A1", "A2") * 2)
    rows, more = files.read_new_csv(spark, f"{tmp_path}/in", ACCOUNT_FILE, loaded)
    assert [r.account_id for r in rows.collect()] == ["A2", "A2"]
    rows, none = files.read_new_csv(spark, f"{tmp_path}/in", ACCOUNT_FILE, loaded.union(more))
    assert rows.count() == 0 and none.count() == 0


def test_line_breaks_inside_quotes_stay_in_their_field(spark, tmp_path):
    path = write(tmp_path / "x.csv", 'a,b\nT1,"two\nlines"\nT2,ok\n')
    schema = StructType([StructField(c, StringType()) for c in "ab"])
    assert [tuple(r) for r in files.read_csv(spark, path, schema).collect()] == [("T1", "two\nlines"), ("T2", "ok")]
    assert files.read_csv(spark, path, schema, multi_line=False).count() == 3


@pytest.mark.parametrize("bad", [",A1,2024-02-28 00:00:00", "T2,,2024-02-28 00:00:00", "T2,A1,"])
def test_a_row_without_a_required_value_aborts(spark, tmp_path, bad):
    path = write(tmp_path / "t.csv", f"a,b,c,d,e,f\nT1,A1,2024-02-28 00:00:00,Fee,1.00,x\n{bad},Fee,1.00,x\n")
    with pytest.raises(PySparkException, match="cannot load a row without"):
        files.read_csv(spark, path, TRANSACTION_FILE).write.parquet(f"{tmp_path}/out")


def test_only_files_not_loaded_yet_are_read(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "one.csv", "a,b,c\n1,x,y\n")
    log = files.list_files(spark, str(folder)).select("path")
    known = spark.createDataFrame(log.collect(), log.schema)
    write(folder / "TWO.TXT", "a,b,c\n2,x,y\n")
    rows, entries = files.read_new_csv(spark, str(folder), ABC, known)
    assert [r.a for r in rows.collect()] == ["2"]
    assert [r.path.rpartition("/")[2] for r in entries.collect()] == ["TWO.TXT"]


def test_the_content_of_loaded_files_is_never_opened(spark, tmp_path):
    """The loaded files are broken by now, and one has a name that is a pattern."""
    folder = tmp_path / "in"
    (folder / "below").mkdir(parents=True)
    for name in ("one.csv.gz", "two.csv"):
        write(folder / name, "a,b,c\n1,x,y\n")
    log = files.list_files(spark, str(folder)).select("path")
    known = spark.createDataFrame(log.collect(), log.schema)
    (folder / "one.csv.gz").write_bytes(b"\x1f\x8b not gzip")
    for n, name in enumerate(["new [1].csv", "n*w {2}.csv", "below/three.csv", "four.csv", "five.csv"]):
        write(folder / name, f"a,b,c\n{n},x,y\n{n},x,y\n")
    rows, entries = files.read_new_csv(spark, str(folder), ABC, known, per_block=2)
    assert sorted(r.a for r in rows.collect()) == sorted("01234" * 2)
    assert len(rows.inputFiles()) == 5 == entries.count()
    rows, entries = files.read_new_csv(spark, str(folder), ABC, known.union(entries))
    assert (rows.count(), rows.schema, entries.count()) == (0, ABC, 0)


def quoted_files(folder, seed, n=300):
    rng = random.Random(seed)
    quoted = ['"two\nlines"', '"a, b"', '"say ""hi"""', '"\n\n"', '"""\n"""', '"x\r\ny"', '""']
    plain = ["plain", "", "NULL", "5", "word word"]
    folder.mkdir()
    for k in range(3):
        end = "\r\n" if k == 1 else "\n"
        lines = ['"mul\nti",b,c' if k == 0 else "a,b,c"]
        for row in range(n):
            some = plain if k == 2 else quoted + plain
            lines += [",".join([str(row), *rng.choices(some, k=rng.choice([0, 1, 2, 2, 3]))])] + [""] * (rng.random() < 0.05)
        with open(folder / f"f {k} [é].csv", "w", newline="") as out:
            out.write(end.join(lines) + end * (k != 2))


@pytest.mark.parametrize("range_bytes", [200, 2_000, 128 << 20])
def test_quoted_line_breaks_are_read_by_many_tasks_as_by_one(spark, tmp_path, range_bytes):
    quoted_files(tmp_path / "in", range_bytes)
    want = spark.read.schema(ABC).options(**files.csv_options()).csv(f"{tmp_path}/in")
    names = {"spark.sql.files.maxPartitionBytes": str(range_bytes), "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        got = quoted.read_quoted(spark, f"{tmp_path}/in", ABC, files.csv_options(), True)
        ranges = quoted.lines_of(spark, f"{tmp_path}/in").select("file", "block").distinct().count()
        assert ranges > 60 if range_bytes == 200 else ranges >= 3
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_files_without_such_breaks_are_left_to_the_plain_reader(spark, tmp_path):
    path = write(tmp_path / "x.csv", 'a,b,c\n1,"x, y","say ""hi"""\n')
    got = files.csv_text(spark, path, ABC)
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.collect()] == [("1", "x, y", 'say "hi"')]


@pytest.mark.parametrize("broken, message", [('1,"x,y\n2,z,z\n', "unclosed quote"), ('1,5" pipe,y\n2,6" pipe,z\n', "stray quote")])
def test_broken_quotes_fail_the_load(spark, tmp_path, broken, message):
    path = write(tmp_path / "x.csv", "a,b,c\n" + broken)
    with pytest.raises(PySparkException, match=message):
        files.read_csv(spark, path, ABC).collect()
