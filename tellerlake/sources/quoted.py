"""CSV whose quoted fields may hold line breaks, read by many tasks a file.

A reader that meets a line break inside quotes must know that it is inside, so
Spark gives such a file to one task. Here the file is read as lines, in as many
byte ranges as its size asks for, and the quotes say where records begin: a line
begins one if the quotes before it in the file are even in number. Each range
counts its quotes; their sums over the ranges before give the state in which a
range begins, a row a range. Then every task joins the lines of its records. A
record that a border of ranges cuts leaves a piece on either side, and only those
pieces meet in a shuffle.

Files in which every line has an even number of quotes hold no such line break:
the plain reader takes them, and nothing but the counting pass was added. In the
others quotes are taken at their word: a file with an odd number of them, or a
record in which a quote stands beside its place at either end of a field, fails
the load instead of shifting the fields of what follows.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerlake.operators.joins import written

#: Characters of a file name that a path pattern would read as its own.
_PATTERN = re.compile(r"([\\\[\]{}*?])")
# What runs in Python workers travels with the job, so executors need no copy of this module.
register_pickle_by_value(sys.modules[__name__])

_PIECES = "part string, file string, block long, first boolean, text string"
#: A record whose quotes all stand at an end of their field or are doubled inside one.
_FIELD = r'("([^"]|"")*"|[^",]*)'
_SOUND = rf"(?s)\A{_FIELD}(,{_FIELD})*\Z"


def escaped(path: str) -> str:
    """A file's name as a path that means this file only."""
    return _PATTERN.sub(r"\\\1", path)


def lines_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(text, file, block) of every line, where block is the first byte of the task's range."""
    # A carriage return stays with its line, as inside quotes it belongs to the field.
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    file, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    return lines.select(F.col("value").alias("text"), file, block)


def _quotes():
    return F.length("text") - F.length(F.replace(F.col("text"), F.lit('"'), F.lit("")))


def quote_counts(lines: DataFrame) -> DataFrame:
    """(file, block, quotes, odd): the quotes of each range, and whether a line of it has an odd number."""
    folded = lines.select("file", "block", _quotes().alias("n")).groupBy("file", "block")
    return folded.agg(F.sum("n").alias("quotes"), F.max(F.col("n") % 2).alias("odd"))


def range_starts(counts: DataFrame) -> DataFrame:
    """(file, block, inside): whether a range begins inside quotes. A row a range, few beside its bytes."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    unclosed = F.raise_error(F.concat(F.lit("cannot load a file with an unclosed quote: "), F.col("file")))
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    ends = F.sum("quotes").over(whole) % 2
    return counts.select("file", "block", F.when(ends == 0, inside).otherwise(unclosed.cast("bigint")).alias("inside"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of a task's ranges, and of cut ones the head (their end) and the tail (their beginning)."""

    def out(part: str, file: str, block: int, texts: pa.Array, first: bool) -> pa.RecordBatch:
        n = len(texts)
        firsts = pa.array(np.arange(n) == 0 if first else np.zeros(n, bool))
        columns = [pa.array([part] * n, pa.string()), pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, firsts, texts.cast(pa.string())], ["part", "file", "block", "first", "text"])

    at, inside, held, head, first = None, 0, [], False, False
    for batch in batches:
        marks = np.zeros(len(batch), bool)
        places = batch["block"].to_numpy(), batch["file"].dictionary_encode().indices.to_numpy()
        marks[1:] = (places[0][1:] != places[0][:-1]) | (places[1][1:] != places[1][:-1])
        edges = [0, *np.flatnonzero(marks).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            file, block = batch["file"][a].as_py(), batch["block"][a].as_py()
            if (file, block) != at:
                if held:
                    yield out("tail", *at, pa.array(["\n".join(held)]), first)
                at, held, first = (file, block), [], block == 0
                inside = batch["inside"][a].as_py()
                head = inside == 1
            text = batch["text"].slice(a, b - a)
            quotes = pc.count_substring(text, '"').to_numpy(zero_copy_only=False)
            before = (inside + np.cumsum(quotes) - quotes) % 2
            inside = int(inside + quotes.sum()) % 2
            begins = np.flatnonzero(before == 0)
            if not len(begins):
                held += text.to_pylist()
                continue
            held += text.slice(0, begins[0]).to_pylist()
            if held:
                # The line break after what is held ended outside quotes, so its record is over.
                yield out("head" if head else "record", file, block, pa.array(["\n".join(held)]), first and not head)
                first = first and head
            head = False
            offsets = pa.array(np.append(begins, len(text)), pa.int32())
            # The last record stays with the task until the next line shows that it is over.
            whole = pa.ListArray.from_arrays(offsets.slice(0, len(begins)), text)
            if len(whole):
                yield out("record", file, block, pc.binary_join(whole, "\n"), first)
                first = False
            held = text.slice(begins[-1]).to_pylist()
    if held and at:
        complete = inside == 0
        yield out(("head" if head else "record") if complete else ("head" if head else "tail"), *at, pa.array(["\n".join(held)]), first)


def assembled(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """(file, first, text) of every record."""
    # One row a range of a file, of many megabytes each: what is broadcast stays small.
    located = lines.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "text", "inside")
    pieces = located.mapInArrow(_pieces, _PIECES)
    cut = pieces.where("part <> 'record'").withColumn("tail", (F.col("part") == "tail").cast("int"))
    order = Window.partitionBy("file").orderBy("block", "tail")
    cut = cut.withColumn("chain", F.sum("tail").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    together = cut.groupBy("file", "chain").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "tail", "text"))).alias("texts")
    )
    joined = together.select("file", "first", F.array_join("texts.text", "\n").alias("text"))
    return pieces.where("part = 'record'").select("file", "first", "text").unionByName(joined)


def parsed(records: DataFrame, schema: StructType, options: dict[str, str], header: bool) -> DataFrame:
    """Records as rows; the first of a file is its header, empty ones are none.

    Where records end with a carriage return and a line feed, breaks inside quotes
    are that pair too and become a line feed, as the plain reader has it.
    """
    ended = F.replace(F.regexp_replace("text", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    text = F.when(F.endswith("text", F.lit("\r")), ended).otherwise(F.col("text"))
    records = records.select("first", text.alias("text")).where("text <> ''")
    records = records.where(~F.col("first")) if header else records
    broken = F.raise_error(F.concat(F.lit("cannot load a record with a stray quote: "), F.col("text")))
    sound = F.when(F.col("text").rlike(_SOUND), F.col("text")).otherwise(broken)
    row = F.from_csv(sound, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    return records.select(row.alias("row")).select("row.*")


def read_quoted(
    spark: SparkSession, paths: str | list[str], schema: StructType, options: dict[str, str], header: bool
) -> DataFrame:
    """Fields as text, as the plain reader with ``multiLine`` gives them; ``options`` are those of the plain reader."""
    lines = lines_of(spark, paths)
    counts = written(quote_counts(lines), "quote-counts")
    broken = [row.file for row in counts.where("odd = 1").select("file").distinct().collect()]
    plain = spark.read.schema(schema).options(**{**options, "multiLine": "false"}).option("recursiveFileLookup", "true")
    if not broken:
        return plain.csv(paths)
    parse = {k: v for k, v in options.items() if k not in ("header", "enforceSchema", "multiLine")}
    spanning = F.broadcast(counts.where("odd = 1").select("file").distinct())
    starts = written(range_starts(counts.join(spanning, "file", "left_semi")), "range-starts")
    rows = [parsed(assembled(lines.join(spanning, "file", "left_semi"), starts), schema, parse, header)]
    others = counts.join(spanning, "file", "left_anti").select("file").distinct()
    even = [escaped(unquote(row.file)) for row in others.collect()]
    if even:
        rows.append(plain.csv(even))
    return reduce(DataFrame.union, rows)
