"""Product codes of vectors, by Lloyd's algorithm on cover trees.

Vectors become integers (see ``vectors``) and are cut into equal consecutive
parts. Each part position has a codebook, which starts as that part of the rows
with the smallest ids. A round assigns every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and replaces an entry by the floor of its
parts' mean; an entry without parts stays.

The rows are cut into blocks once, and every block gets a cover tree a part
position (see ``covertree``), written beside it. A round is one pass over that
table: the codebooks travel to the tasks, whole subtrees are assigned by the
triangle inequality, their sums come from cumulative sums, and only ambiguous
nodes descend to exact comparisons. A task yields one row of counts and sums an
entry; Spark adds them up, and only the sums, entries x dimension numbers,
reach the driver. All arithmetic is on integers, so codebooks and codes depend on
neither blocks nor order.

Defined results: rows with unusable vectors are left out (see ``vectors``); of
rows with equal ids the smaller vector comes first, and null ids last, when the
codebooks are begun; fewer rows than entries make fewer entries; an empty table
gives no rows and empty codebooks. Repeated rows count and are returned as often
as they occur. A dimension that the parts do not divide is an error, and so are
components beyond 2**26 after scaling, which leave squared distances no room.
Carried columns come back as they are.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tellerlake.llm import vectors
from tellerlake.llm.covertree import LARGEST, Forest
from tellerlake.operators.joins import written

PARTS, ENTRIES, ROUNDS = 16, 64, 2


def parts_of(x: np.ndarray, parts: int) -> np.ndarray:
    """The points of the first part position, then of the second, and so on."""
    rows = len(x)
    return np.ascontiguousarray(x.reshape(rows, parts, -1).transpose(1, 0, 2)).reshape(rows * parts, -1)


def stored(forest: Forest) -> bytes:
    """Places fit 32 bits; radii stay as they are."""
    out = io.BytesIO()
    arrays = {k: v if k == "radius" else v.astype("<i4") for k, v in forest.arrays().items()}
    np.savez(out, **arrays)
    return out.getvalue()


def restored(data: bytes, parts: int) -> Forest:
    with np.load(io.BytesIO(data)) as arrays:
        return Forest(parts=parts, **{k: arrays[k] if k == "radius" else arrays[k].astype(np.int64) for k in Forest.FIELDS})


def grow(rows: DataFrame, dimension: int, parts: int) -> DataFrame:
    """Blocks of rows (id, x, carried) with the forests of their parts."""
    lists = [StructField(to, ArrayType(rows.schema[of].dataType)) for to, of in (("ids", "id"), ("carried", "carried"))]
    schema = StructType([*lists, *StructType.fromDDL(f"{vectors.PACKED}, forest binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in vectors.in_blocks(batches, dimension):
            x = vectors.matrix(table["x"].combine_chunks(), dimension)
            if np.abs(x).max() > LARGEST:
                raise OverflowError(f"components beyond {LARGEST} leave no room for exact distances")
            block = vectors.packed(x)
            whole = [pa.array([0, len(x)], pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(*whole, table["id"].combine_chunks()),
                    pa.ListArray.from_arrays(*whole, table["carried"].combine_chunks()),
                    pa.array([block["rows"]], pa.int32()),
                    pa.array([block["kind"]]),
                    pa.array([block["cells"]], pa.binary()),
                    pa.array([stored(Forest.build(parts_of(x, parts), parts))], pa.binary()),
                ],
                ["ids", "carried", "rows", "kind", "cells", "forest"],
            )

    return rows.select("id", "carried", "x").mapInArrow(run, schema)


def blocks_of(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Forest]]:
    """(row of the table, vectors, forest) of every block."""
    for batch in batches:
        for at in range(len(batch)):
            row = batch.slice(at, 1)
            x = vectors.unpacked(*(row[name][0].as_py() for name in ("rows", "kind", "cells")))
            yield row, x, restored(row["forest"][0].as_py(), parts)


def first_books(rows: DataFrame, dimension: int, parts: int, entries: int) -> np.ndarray:
    """parts x entries x components, from the rows with the smallest ids; bounded by ``entries`` rows."""
    first = rows.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([row["x"] for row in first], np.int64)
    return x.reshape(len(first), parts, dimension // parts).transpose(1, 0, 2).copy()


def improved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((parts, entries, 1 + width), np.int64)
        for _, x, forest in blocks_of(batches, parts):
            out += forest.sums(parts_of(x, parts)[forest.order], books)
        yield pa.RecordBatch.from_arrays([pa.array([out.ravel()], pa.list_(pa.int64()))], ["sums"])

    sums = blocks.select("rows", "kind", "cells", "forest").mapInArrow(run, "sums array<bigint>")
    cells = sums.select(F.posexplode("sums").alias("at", "value")).groupBy("at")
    cells = cells.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    total = np.zeros(books.size // width * (1 + width), object)
    for row in cells:
        total[row["at"]] = int(row["value"])
    total = total.reshape(parts, entries, 1 + width)
    counts = total[:, :, :1]
    means = total[:, :, 1:] // np.where(counts == 0, 1, counts)
    return np.where(counts == 0, books, means).astype(np.int64)


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, carried, code, error) of every row."""
    parts = len(books)
    single = [StructField(to, blocks.schema[of].dataType.elementType) for to, of in (("id", "ids"), ("carried", "carried"))]
    schema = StructType([*single, *StructType.fromDDL("code array<int>, error bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, x, forest in blocks_of(batches, parts):
            points = parts_of(x, parts)
            code = forest.assign(points[forest.order], books)
            lost = points.reshape(parts, len(x), -1) - np.take_along_axis(books, code[:, :, None], axis=1)
            error = np.einsum("prd,prd->r", lost, lost)
            codes = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * parts, pa.int32()), pa.array(code.T.ravel().astype(np.int32))
            )
            out = [row["ids"].flatten(), row["carried"].flatten(), codes, pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["id", "carried", "code", "error"])

    return blocks.mapInArrow(run, schema)


def compress(
    docs: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    carry: list[str] | None = None,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Per usable row ``id``, the carried columns, ``code`` (an index a part) and ``error``; and the final codebooks.

    Carried columns must not be called ``code`` or ``error``.
    """
    rows, dimension = vectors.kept(docs, id, vector, carry)
    if dimension % parts:
        raise ValueError(f"{dimension} components cannot be cut into {parts} equal parts")
    books = first_books(rows, dimension, parts, entries)
    blocks = written(grow(rows, dimension, parts), "code-blocks")
    for _ in range(rounds if books.size else 0):
        books = improved(blocks, books)
    out = coded(blocks, books)
    carried = out.schema["carried"].dataType
    names = carried.fieldNames() if isinstance(carried, StructType) else []
    columns = [F.col("id").alias(id), *[F.col("carried").getField(c).alias(c) for c in names], "code", "error"]
    return out.select(*columns), books
