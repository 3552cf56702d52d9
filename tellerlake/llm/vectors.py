"""Vectors as integers, and as blocks of many rows that numpy takes whole.

A component c becomes floor(256 * c). Rows are left out whose vector is null, is
empty, or holds a null or non-finite component, and rows whose vector is not of
the table's dimension: the length most vectors have, of several the greatest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Components in a block, so that a block and what numpy makes of it stay a few megabytes.
BLOCK_CELLS = 1 << 18
INFINITE = float("inf")


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < INFINITE))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def kept(vectors: DataFrame, id: str, vector: str, carry: list[str] | None = None) -> tuple[DataFrame, int]:
    """Rows (id, x, carried) of the usable vectors, x being their integers, and the dimension; 0 without any."""
    source = F.col(f"`{vector}`")
    rows = vectors.where(usable(source))
    sizes = rows.groupBy(F.size(source).alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    dimension = most["size"] if most else 0
    carried = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]) if carry else F.lit(None).cast("boolean")
    rows = rows.where(F.size(source) == dimension)
    return rows.select(F.col(f"`{id}`").alias("id"), integers(source).alias("x"), carried.alias("carried")), dimension


def smallest_type(x: np.ndarray) -> str:
    """The narrowest integer type that holds every component."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def packed(x: np.ndarray) -> dict:
    kind = smallest_type(x)
    return {"rows": len(x), "kind": kind, "cells": x.astype(kind).tobytes()}


def unpacked(rows: int, kind: str, cells: bytes) -> np.ndarray:
    return np.frombuffer(cells, kind).reshape(rows, -1).astype(np.int64)


PACKED = "rows int, kind string, cells binary"


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """A column of lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def in_blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of BLOCK_CELLS components, whatever the batches they came in."""
    size = max(1, BLOCK_CELLS // max(1, dimension))
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while len(batch):
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += len(part)
            batch = batch.slice(len(part))
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def pack(rows: DataFrame, dimension: int) -> DataFrame:
    """Rows with an array column ``x`` as blocks, PACKED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_blocks(batches, dimension):
            block = packed(matrix(table["x"].combine_chunks(), dimension))
            yield pa.RecordBatch.from_pylist([block], BLOCK_SCHEMA)

    return rows.select("x").mapInArrow(run, PACKED)


BLOCK_SCHEMA = pa.schema([("rows", pa.int32()), ("kind", pa.string()), ("cells", pa.binary())])


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for row in range(len(batch)):
            yield unpacked(*(batch[name][row].as_py() for name in ("rows", "kind", "cells")))


def summed(blocks: DataFrame, make: Callable[[Iterator[np.ndarray]], np.ndarray], exact: bool) -> list:
    """The sum over all blocks of an array of fixed length, one a task.

    ``make`` folds the blocks of a task into its array. Only the sum reaches the
    driver. Exact sums are of integers and come as Python integers.
    """
    kind, arrow = ("decimal(38,0)", pa.int64()) if exact else ("double", pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([make(blocks_of(batches))], pa.list_(arrow))], ["part"])

    parts = blocks.mapInArrow(run, f"part array<{'bigint' if exact else 'double'}>")
    cells = parts.select(F.posexplode("part").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    found = sorted((row["at"], row["value"]) for row in cells.collect())
    return [int(value) if exact else value for _, value in found]
