"""Parquet tables below one root, with a log per table that names its current directories.

Plain Parquet cannot update in place, so nothing is: every change writes a new
directory, and one row set appended to the table's log makes it current, all of
it or nothing. A lost job leaves a directory that no row names; whoever reads
sees the state before or after. A directory holds one partition (a leaf: a load,
or a month of a dated table) or, of an unpartitioned table, all rows, so a change
rewrites what it touches. Old directories stay until ``forget``; until then
``read(as_of=...)`` gives the state that an earlier version had.

Loading and cleansing one table may run beside one another, as they change
different leaves and their rows simply meet in the log; but one loader a table at
a time, since a load takes the next free id. What reaches the driver is the log's
fold: a row for every current leaf and appended directory.

Tables with a ``date_key`` are clustered by date: partitioned by its day, month
or year and sorted by date inside each file, so a date range reads only its
partitions and row groups. Choose "day" once a day fills whole files; a finer
grain than the data deserves costs a directory listing and a tiny file per day.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerlake.operators.joins import written
from tellerlake.schemas import DATE_PART, TABLES
from tellerlake.sources.workspace import exists, folders, remove, shuffles_removed

#: ``starts``: the row replaces what its leaf had; otherwise its directory is added.
_LOG = (
    "version long, leaf string, path string, starts boolean, "
    "source string, batch long, files string, cleansed boolean, built_from string"
)
_COLUMNS = [column.split()[0] for column in _LOG.split(", ")]

#: Leaf of the table as a whole: a row that starts it makes all earlier rows void.
WHOLE = "*"
#: Source of a load whose id the caller chose.
GIVEN = "given"
LOAD = "_load_id"


@dataclass
class Leaf:
    """One partition as the log has it: its directories, and what its last row says."""

    begun: int
    version: int
    paths: list[str] = field(default_factory=list)
    source: str | None = None
    batch: int | None = None
    files: str | None = None
    cleansed: bool = False
    built_from: str | None = None


def _apply(state: dict[str, Leaf], entries: list[dict]) -> None:
    """Bring a state up to date with log rows, in their order."""
    for e in entries:
        if e["starts"] and e["leaf"] == WHOLE:
            state.clear()
        before = None if e["starts"] else state.get(e["leaf"])
        leaf = Leaf(before.begun if before else e["version"], e["version"], before.paths if before else [])
        leaf.paths = leaf.paths + [e["path"]] if e["path"] else leaf.paths
        for told in ("source", "batch", "files", "cleansed", "built_from"):
            setattr(leaf, told, e[told])
        state[e["leaf"]] = leaf


def _text(built_from: dict[str, int] | None) -> str | None:
    return json.dumps(built_from, sort_keys=True) if built_from else None


class Lake:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        date_grain: str = "month",
        tables: dict[str, tuple[StructType, list[str]]] = TABLES,
    ):
        if date_grain not in ("day", "month", "year"):
            raise ValueError(f"date_grain must be day, month or year, not {date_grain!r}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.date_grain = date_grain
        self.tables = tables
        self._folded: dict[tuple[str, int | None], dict[str, Leaf]] = {}
        self._rows: dict[str, int] = {}

    # The log

    def _log(self, name: str) -> DataFrame | None:
        path = f"{self.root}/log/{name}"
        return self.spark.read.schema(_LOG).parquet(path) if exists(self.spark, path) else None

    def refresh(self, *names: str) -> None:
        """See what others have written since; without names, to any table."""
        for name in names or [held for held, _ in self._folded]:
            self._folded.pop((name, None), None)
            self._rows.pop(name, None)

    def _state(self, name: str, as_of: int | None = None) -> dict[str, Leaf]:
        """The leaves of a table now, or when ``as_of`` was its version."""
        if (name, as_of) in self._folded:
            return self._folded[name, as_of]
        log, state = self._log(name), {}
        if log is not None:
            log = log if as_of is None else log.where(F.col("version") <= as_of)
            by_leaf = log.groupBy("leaf").agg(
                F.max(F.when(F.col("starts"), F.col("version"))).alias("since"), F.collect_list(F.struct("*")).alias("entries")
            )
            # What a later row of the leaf has replaced stays behind.
            current = F.filter("entries", lambda e: e["version"] >= F.coalesce("since", F.lit(0)))
            found = [entry.asDict() for row in by_leaf.select(current.alias("e")).collect() for entry in row.e]
            _apply(state, sorted(found, key=lambda e: (e["version"], e["leaf"] != WHOLE, not e["starts"])))
        self._folded[name, as_of] = state
        return state

    def version(self, name: str) -> int:
        """Counts the changes of a table; 0 before the first."""
        return max((leaf.version for leaf in self._state(name).values()), default=0)

    def generation(self, name: str) -> int:
        """The version that last replaced or reset the whole table; loads and progress belong to it."""
        whole = self._state(name).get(WHOLE)
        return whole.begun if whole else 0

    def _commit(self, name: str, entries: list[dict]) -> None:
        """Append rows to the log; one file, so all are there or none."""
        state, log = self._state(name), self._log(name)
        version = 1 + ((log.agg(F.max("version")).first()[0] or 0) if log is not None else 0)
        entries = [{**dict.fromkeys(_COLUMNS), "starts": True, "cleansed": False, **e, "version": version} for e in entries]
        rows = self.spark.createDataFrame([tuple(e[c] for c in _COLUMNS) for e in entries], _LOG).coalesce(1)
        rows.write.mode("append").parquet(f"{self.root}/log/{name}")
        _apply(state, entries)

    def last_batch(self, name: str, source: str) -> int:
        """The last batch of a stream that a rewrite of the table has applied; -1 for none."""
        log = self._log(name)
        if log is None:
            return -1
        applied = log.where(F.col("source") == source)
        return applied.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]

    def built_from(self, name: str) -> dict[str, int] | None:
        """Versions of the tables that a whole table was last brought up to date with."""
        whole = self._state(name).get(WHOLE)
        return json.loads(whole.built_from) if whole and whole.built_from else None

    # Loads: partitions of a table, each with its source and whether it has been cleansed

    def _loads(self, name: str, as_of: int | None = None) -> dict[int, Leaf]:
        state = self._state(name, as_of)
        return {int(leaf.partition("=")[2]): entry for leaf, entry in state.items() if leaf.startswith(LOAD)}

    def load_of(self, name: str, source: str, batch: int) -> int | None:
        """The load a source's batch has become, if it has been written."""
        self.refresh(name)
        return next((n for n, leaf in self._loads(name).items() if (leaf.source, leaf.batch) == (source, batch)), None)

    def next_load(self, name: str) -> int:
        return max(self._loads(name), default=0) + 1

    def pending_loads(self, name: str) -> list[int]:
        """Loads not cleansed since they were written."""
        self.refresh(name)
        return sorted(n for n, leaf in self._loads(name).items() if not leaf.cleansed)

    def changed_leaves(self, name: str, since: int) -> list[str]:
        """Partitions whose rows are not those that version ``since`` had."""
        now, then = self._state(name), self._state(name, since)

        def paths(state, leaf):
            return state[leaf].paths if leaf in state else []

        return sorted(leaf for leaf in {*now, *then} - {WHOLE} if paths(now, leaf) != paths(then, leaf))

    def changed_loads(self, name: str, since: int) -> list[int]:
        return sorted(int(leaf.partition("=")[2]) for leaf in self.changed_leaves(name, since))

    def all_changed(self, name: str, since: int) -> bool:
        """Whether the table has loads, and none of them is what it was at a version."""
        loads = {*self._loads(name)}
        return bool(loads) and loads <= {*self.changed_loads(name, since)}

    def comparable(self, name: str, since: int) -> bool:
        """Whether what has changed since a version can be told: no reset between, and old directories still there."""
        if self.generation(name) > since:
            return False
        then = self._state(name, since)
        paths = [path for leaf in self.changed_leaves(name, since) if leaf in then for path in then[leaf].paths]
        return all(exists(self.spark, path) for path in paths)

    def loaded_files(self, name: str) -> DataFrame:
        """(path) of the files that current loads came from."""
        kept = [leaf.files for leaf in self._loads(name).values() if leaf.files]
        reader = self.spark.read.schema("path string")
        return reader.parquet(*kept) if kept else self.spark.createDataFrame([], "path string")

    # Layout

    def _new_path(self, name: str) -> str:
        return f"{self.root}/{name}/_v={uuid4().hex}"

    def _date_part(self, day: Column) -> Column:
        return day if self.date_grain == "day" else F.trunc(day, self.date_grain)

    def _shaped(self, name: str, df: DataFrame) -> DataFrame:
        schema, parts = self.tables[name]
        columns = [F.col(f.name).cast(f.dataType) for f in schema.fields]
        if DATE_PART in parts:
            columns.append(self._date_part(F.col("date_key")).alias(DATE_PART))
        return df.select(*columns)

    def _write(self, name: str, df: DataFrame, by_date: bool = False) -> tuple[dict[str, str], int]:
        """Write rows to a new directory; its leaves, and the number of rows from the write itself.

        ``by_date`` says that a task of ``df`` holds few dates already: nothing is shuffled for the write.
        """
        _, parts = self.tables[name]
        path, df = self._new_path(name), self._shaped(name, df)
        if DATE_PART in parts:
            # Whole files per partition: AQE splits a busy one and merges quiet ones.
            df = df if by_date else df.hint("rebalance", DATE_PART)
            df = df.sortWithinPartitions(DATE_PART, "date_key")
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd")
        with shuffles_removed(self.spark):
            (writer.partitionBy(*parts) if parts else writer).parquet(path)
        leaves = {leaf: f"{path}/{leaf}" for leaf in folders(self.spark, path) if "=" in leaf} if parts else {WHOLE: path}
        return leaves, counted.get.get("rows", 0)

    # Reading

    def _stored(self, name: str, state: dict[str, Leaf]) -> DataFrame:
        """A state with its partition column."""
        schema, parts = self.tables[name]
        if DATE_PART in parts:
            schema = StructType([*schema.fields]).add(DATE_PART, "date")
        paths = [path for leaf in state.values() for path in leaf.paths]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*paths).select(*schema.fieldNames())

    def read(self, name: str, start: date | None = None, end: date | None = None, as_of: int | None = None) -> DataFrame:
        """The current state or that of version ``as_of``; of a dated table the dates from ``start`` to ``end``."""
        df, part, day = self._stored(name, self._state(name, as_of)), F.col(DATE_PART), F.col("date_key")
        if start is not None:
            df = df.where((part >= self._date_part(F.lit(start))) & (day >= F.lit(start)))
        if end is not None:
            df = df.where((part <= self._date_part(F.lit(end))) & (day <= F.lit(end)))
        return df.drop(DATE_PART)

    def read_leaves(self, name: str, leaves: Iterable[str], as_of: int | None = None) -> DataFrame:
        """Only these partitions, now or as of a version; no other directory is looked into."""
        state, wanted = self._state(name, as_of), set(leaves)
        return self._stored(name, {leaf: entry for leaf, entry in state.items() if leaf in wanted}).drop(DATE_PART)

    def read_loads(self, name: str, load_ids: Iterable[int], as_of: int | None = None) -> DataFrame:
        return self.read_leaves(name, [f"{LOAD}={n}" for n in load_ids], as_of)

    def rows(self, name: str) -> int:
        """Rows of a table: counted by the writes of this lake, else by a read."""
        if name not in self._rows:
            self._rows[name] = self.read(name).count()
        return self._rows[name]

    # Writing

    def replace(
        self,
        name: str,
        df: DataFrame,
        source: str | None = None,
        batch: int | None = None,
        built_from: dict[str, int] | None = None,
        by_date: bool = False,
    ) -> None:
        """Truncate and insert. ``df`` may read the table it replaces."""
        leaves, rows = self._write(name, df, by_date)
        whole = {"leaf": WHOLE, "path": leaves.pop(WHOLE, None), "source": source, "batch": batch, "built_from": _text(built_from)}
        self._commit(name, [whole, *[{"leaf": leaf, "path": path} for leaf, path in leaves.items()]])
        self._rows[name] = rows

    def reset(self, *names: str) -> None:
        """Empty tables."""
        for name in names:
            self._commit(name, [{"leaf": WHOLE}])
            self._rows[name] = 0

    def append(self, name: str, df: DataFrame, built_from: dict[str, int] | None = None) -> None:
        """Add rows."""
        before = self._rows.pop(name, None) if self._state(name) else 0
        leaves, rows = self._write(name, df)
        entries = [{"leaf": leaf, "path": path, "starts": False} for leaf, path in leaves.items()]
        if WHOLE in leaves:
            entries[0]["built_from"] = _text(built_from)
        self._commit(name, entries)
        if before is not None:
            self._rows[name] = before + rows

    def replace_load(self, name: str, df: DataFrame, load_id: int) -> int:
        """Overwrite one load whose id the caller chose, also with no rows; a replay gives the same state.

        Returns the rows written.
        """
        owner = self._loads(name).get(load_id)
        if owner is not None and owner.source != GIVEN:
            raise ValueError(f"load {load_id} of {name} belongs to {owner.source}")
        leaves, rows = self._write(name, df.withColumn(LOAD, F.lit(load_id)))
        leaf = f"{LOAD}={load_id}"
        self._commit(name, [{"leaf": leaf, "path": leaves.get(leaf), "source": GIVEN}])
        self._rows.pop(name, None)
        return rows

    def load_batch(
        self, name: str, files: DataFrame, rows: Callable[[list[str], int], DataFrame], source: str, batch: int
    ) -> int:
        """Write what ``rows`` reads from ``files`` (path) as the next load, unless the source's batch is there already.

        Files that current loads came from are left out by name and not opened. The
        names of one batch reach the driver, as Spark's reader takes them from there.
        """
        if self.load_of(name, source, batch) is not None:
            return 0
        fresh = written(files.select("path").join(self.loaded_files(name), "path", "left_anti"), "arrived-files")
        paths = [row.path for row in fresh.collect()]
        if not paths:
            return 0
        load_id, names = self.next_load(name), f"{self.root}/files/{name}/{uuid4().hex}"
        leaves, n = self._write(name, rows(paths, load_id).withColumn(LOAD, F.lit(load_id)))
        fresh.write.parquet(names)
        leaf = f"{LOAD}={load_id}"
        self._commit(name, [{"leaf": leaf, "path": leaves.get(leaf), "source": source, "batch": batch, "files": names}])
        self._rows.pop(name, None)
        return n

    def replace_loads(self, name: str, df: DataFrame | None, load_ids: list[int], cleansed: Iterable[int] = ()) -> None:
        """Overwrite these loads with ``df``, emptying those it has no rows of, and note which are cleansed now.

        ``df`` may read the table.
        """
        leaves = self._write(name, df)[0] if df is not None else {}
        loads, entries = self._loads(name), []
        for n in sorted({*load_ids, *cleansed}):
            old, leaf = loads[n], f"{LOAD}={n}"
            same = {"leaf": leaf, "source": old.source, "batch": old.batch, "files": old.files}
            same["cleansed"] = n in cleansed or old.cleansed
            paths = [leaves.get(leaf)] if n in load_ids else old.paths or [None]
            entries += [{**same, "path": path, "starts": k == 0} for k, path in enumerate(paths)]
        if entries:
            self._commit(name, entries)
        if df is not None:
            self._rows.pop(name, None)

    def replace_date(self, name: str, df: DataFrame, day: date) -> None:
        """Delete one date and insert its rows, also if there are none.

        The other dates of the partition are carried over; with grain "day" there are none.
        """
        days = self.spark.createDataFrame([(day,)], "date_key date")
        self._replace_days(name, df.where(F.col("date_key") == F.lit(day)), days)

    def replace_dates(
        self,
        name: str,
        df: DataFrame,
        days: DataFrame | None = None,
        built_from: dict[str, int] | None = None,
        by_date: bool = False,
    ) -> None:
        """Replace the dates ``days``, or else exactly those ``df`` holds, rewriting only the partitions they lie in."""
        if days is None:
            df = written(df, "dates")
            days = df.select("date_key").distinct()
        self._replace_days(name, df, days, built_from, by_date)

    def _replace_days(
        self, name: str, df: DataFrame, days: DataFrame, built_from: dict[str, int] | None = None, by_date: bool = False
    ) -> None:
        # Sets of dates are bounded by their type: they may broadcast and their partitions come to the driver.
        parts = days.where("date_key IS NOT NULL").select(self._date_part(F.col("date_key")).alias(DATE_PART)).distinct()
        touched = [f"{DATE_PART}={row[0]}" for row in parts.collect()]
        state = self._state(name)
        inside = self._stored(name, {leaf: state[leaf] for leaf in touched if leaf in state})
        kept = inside.join(F.broadcast(days), "date_key", "left_anti")
        columns = self.tables[name][0].fieldNames()
        # Kept rows come from files of one partition each, so they are laid out by date as well.
        leaves, _ = self._write(name, df.select(*columns).unionByName(kept.select(*columns)), by_date)
        entries = [{"leaf": leaf, "path": leaves.get(leaf)} for leaf in sorted({*touched, *leaves})]
        self._commit(name, entries + self._noted(name, built_from))
        self._rows.pop(name, None)

    def _noted(self, name: str, built_from: dict[str, int] | None) -> list[dict]:
        return [{"leaf": WHOLE, "starts": False, "built_from": _text(built_from)}] if built_from else []

    def note_built(self, name: str, built_from: dict[str, int]) -> None:
        """The table as it is, is up to date with these versions."""
        self._commit(name, self._noted(name, built_from))

    # Retention

    def forget(self, name: str, before: int) -> int:
        """Remove the directories that only versions before ``before`` need; returns how many went.

        Versions from ``before`` on stay readable, and so does the log.
        """
        log = self._log(name)
        if log is None:
            return 0
        later = [row.version for row in log.where(F.col("version") >= before).select("version").distinct().collect()]
        needed = {path for v in {before, *later} for leaf in self._state(name, v).values() for path in leaf.paths}
        named = log.where("path IS NOT NULL").select("path").distinct().collect()
        gone = sorted(row.path for row in named if row.path not in needed and exists(self.spark, row.path))
        for path in gone:
            remove(self.spark, path)
        return len(gone)
