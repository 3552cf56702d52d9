"""The transaction fact and its daily rollups."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.numbers import money
from tellerlake.operators.joins import on_hot_key

# Grain of each rollup level, besides the date.
GRAINS = {
    1: ["customer_id"],
    2: ["account_id"],
    3: ["customer_id", "transaction_type"],
    4: ["account_id", "transaction_type"],
}
GRAIN_NAMES = {1: "By Customer", 2: "By Account", 3: "By Customer + Type", 4: "By Account + Type"}
AGG_COLUMNS = [
    "date_key",
    "customer_id",
    "account_id",
    "transaction_type",
    "total_amount",
    "transaction_count",
    "rollup_level",
]


def _dated(transactions: DataFrame, report_date: date | None) -> DataFrame:
    """Add date_key. The date filter stays on the raw timestamp's date, which Catalyst
    turns into a timestamp range and pushes into the scan."""
    if report_date is not None:
        transactions = transactions.where(F.to_date("transaction_date") == F.lit(report_date))
    return transactions.withColumn("date_key", F.to_date("transaction_date"))


def loaded_dates(fact: DataFrame) -> DataFrame:
    """Distinct dates of a fact. A DATE has under 3.7 million values, so this set is
    small enough to broadcast however large the fact grows."""
    return F.broadcast(fact.select("date_key").where(F.col("date_key").isNotNull()).distinct())


def missing_dates(transactions: DataFrame, fact: DataFrame, report_date: date | None = None) -> DataFrame:
    """Transaction dates the fact does not hold; reads one column of either table."""
    days = _dated(transactions, report_date).select("date_key").where(F.col("date_key").isNotNull()).distinct()
    return days.join(loaded_dates(fact), "date_key", "left_anti")


def transaction_fact(
    transactions: DataFrame,
    accounts: DataFrame,
    report_date: date | None = None,
    already_loaded: DataFrame | None = None,
) -> DataFrame:
    """Transactions with their account's customer.

    Rows of a date that ``already_loaded`` holds are skipped, late ones too.
    Transactions without an account drop out; a duplicated account fans out. One
    without a date, which no load lets in, keeps its row and a NULL date.
    """
    rows = _dated(transactions, report_date)
    if already_loaded is not None:
        # Filter before the account join. Broadcasting the dates spares the rows a
        # shuffle on date, where one busy day would be one task.
        rows = rows.join(loaded_dates(already_loaded), "date_key", "left_anti")
    owners = accounts.select(F.col("account_id").alias("_owned"), "customer_id")
    # Transactions on the left: AQE splits a hot account's rows over several tasks.
    owned = rows.join(owners, on_hot_key("account_id", "_owned"))
    return owned.select("date_key", "customer_id", "account_id", "transaction_id", "transaction_type", "amount")


def dates_that_differ(then: DataFrame, now: DataFrame) -> DataFrame:
    """Dates whose transactions, as far as the rollups read them, are not the same in both.

    Every date folds to a count and a sum of row hashes on either side, with
    partial sums before the shuffle; no row meets its earlier self.
    """
    row = F.xxhash64("transaction_date", "account_id", "transaction_type", "amount").cast("decimal(38,0)")
    sides = [df.select(F.to_date("transaction_date").alias("date_key"), row.alias("row"), F.lit(s).alias("sign"))
             for df, s in ((then, -1), (now, 1))]
    folded = sides[0].unionByName(sides[1]).groupBy("date_key")
    folded = folded.agg(F.sum("sign").alias("rows"), F.sum(F.col("sign") * F.col("row")).alias("digest"))
    return folded.where((F.col("rows") != 0) | (F.col("digest") != 0)).select("date_key")


def owners_that_differ(then: DataFrame, now: DataFrame) -> DataFrame:
    """Accounts whose owners, with their number of copies, are not the same in both."""
    sides = [df.select("account_id", "customer_id", F.lit(s).alias("sign")) for df, s in ((then, -1), (now, 1))]
    folded = sides[0].unionByName(sides[1]).groupBy("account_id", "customer_id").agg(F.sum("sign").alias("copies"))
    return folded.where("copies <> 0 AND account_id IS NOT NULL").select("account_id").distinct()


def dates_of(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Dates on which one of ``accounts`` has a transaction; reads two columns."""
    days = transactions.select("account_id", F.to_date("transaction_date").alias("date_key"))
    owned = accounts.select(F.col("account_id").alias("_owned"))
    return days.join(owned, on_hot_key("account_id", "_owned"), "left_semi").select("date_key").distinct()


def on_dates(transactions: DataFrame, days: DataFrame) -> DataFrame:
    """Transactions of these dates. Dates are bounded by their type, so they may broadcast;
    their range reaches the scan."""
    first, last = days.agg(F.min("date_key"), F.max("date_key")).first()
    day = F.to_date("transaction_date")
    ranged = transactions.where(day.between(F.lit(first), F.lit(last)))
    wanted = F.broadcast(days.select(F.col("date_key").alias("_wanted")))
    return ranged.join(wanted, day == F.col("_wanted"), "left_semi")


def _fold(df: DataFrame, *keys: str, extra: Column | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("total_amount").alias("total_amount"),
        F.sum("transaction_count").alias("transaction_count"),
        *([] if extra is None else [extra]),
    )


def _finest(transactions: DataFrame, report_date: date | None) -> DataFrame:
    return _dated(transactions, report_date).groupBy("date_key", "account_id", "transaction_type").agg(
        F.sum("amount").alias("total_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def _side(df: DataFrame, level: int) -> DataFrame:
    """Rows of the finer level of a customer or an account, its id as ``_id``."""
    sums = ["transaction_type", "total_amount", "transaction_count"]
    return df.select("date_key", F.lit(level).alias("_level"), F.col(GRAINS[level][0]).alias("_id"), *sums)


def _leveled(df: DataFrame, level: Column) -> DataFrame:
    """The table's columns; ``level`` tells whose id ``_id`` is."""

    def owner(name: str) -> Column:
        mine = [n for n, grain in GRAINS.items() if name in grain]
        return F.when(level.isin(mine), F.col("_id")).alias(name)

    return df.select(
        "date_key",
        owner("customer_id"),
        owner("account_id"),
        "transaction_type",
        money(F.col("total_amount")).alias("total_amount"),
        "transaction_count",
        level.alias("rollup_level"),
    )


def daily_rollups(
    transactions: DataFrame,
    accounts: DataFrame,
    report_date: date | None = None,
    levels: tuple[int, ...] = (1, 2, 3, 4),
    by_date: bool = False,
) -> DataFrame:
    """The daily aggregate table: date by customer, account, customer+type, account+type.

    Raw transactions are read and shuffled once, into date+account+type, so a hot
    account is one row per date and type from there on. These rows, and the same
    ones as their customers', are spread by date and id in one shuffle, which all
    levels read and fold where the rows lie. Customer levels drop transactions
    without an account; account levels keep them.

    With ``by_date`` that shuffle cuts ranges of dates, and of ids within a busy
    date: a task then holds few dates, and a table that is clustered by date can be
    written without a shuffle of all four levels (``Lake.replace(..., by_date=True)``).

    Rows without an account id go their own way: the join would push a not-null
    filter into its copy of the plan only, and the levels could no longer share
    one shuffle. Where the column has no NULLs, file statistics skip that scan.
    """
    has_account = F.col("account_id").isNotNull()
    finest = _finest(transactions.where(has_account), report_date)
    wanted, sides = {*levels}, []
    if wanted & {2, 4}:
        sides += [_side(finest, 4), _side(_finest(transactions.where(~has_account), report_date), 4)]
    if wanted & {1, 3}:
        owners = accounts.select(F.col("account_id").alias("_owned"), "customer_id")
        sides.append(_side(finest.join(owners, on_hot_key("account_id", "_owned")), 3))
    rows, place = reduce(DataFrame.unionByName, sides), ["date_key", "_id"]
    spread = rows.repartitionByRange(*place) if by_date else rows.repartition(*place)
    parts = []
    if wanted & {3, 4}:
        parts.append(_leveled(_fold(spread, *place, "_level", "transaction_type"), F.col("_level")))
    if wanted & {1, 2}:
        # A hash is never NULL, so ``_kinds`` drops no row. It keeps the type among the columns read:
        # with fewer columns than the finer levels these would get a shuffle of their own.
        kinds = F.max(F.xxhash64("transaction_type")).alias("_kinds")
        coarse = _fold(spread, *place, "_level", extra=kinds).where(F.col("_kinds").isNotNull())
        coarse = coarse.withColumn("transaction_type", F.lit(None).cast("string"))
        parts.append(_leveled(coarse, F.col("_level") - 2))
    found = reduce(DataFrame.unionByName, parts)
    made = {n for side in ({2, 4}, {1, 3}) for grain in ({3, 4}, {1, 2}) if wanted & side and wanted & grain for n in side & grain}
    return found if made == wanted else found.where(F.col("rollup_level").isin(*levels))


def grain_of(customer: str = "customer_id", account: str = "account_id", kind: str = "transaction_type") -> Column:
    """Grain read off the NULL pattern; a row whose own type is NULL looks coarser than it is."""
    c, a, t = (F.col(name).isNotNull() for name in (customer, account, kind))
    return (
        F.when(c & ~a & ~t, GRAIN_NAMES[1])
        .when(~c & a & ~t, GRAIN_NAMES[2])
        .when(c & ~a & t, GRAIN_NAMES[3])
        .when(~c & a & t, GRAIN_NAMES[4])
    )
