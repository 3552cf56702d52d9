"""A global random shuffle of records into shards, in two passes over the disk.

Scatter: every record goes to one of B buckets by a seeded hash of its place in
the input, so copies and repeated ids spread like anything else and buckets come
out even. B is such that a bucket fits the memory of a task. Shuffle: a task
takes one bucket, puts it in the order of places, whatever order the network
brought, permutes it by Fisher-Yates with a generator seeded by the bucket, and
writes it.

The buckets one after another are the shuffled order. Their counts, a number a
bucket, give each bucket its first rank, so a task knows the rank of its records
without meeting others. Shards are equal slices of that order: by the law
``rows`` their counts are at most one apart, and ``slot`` is the rank within the
slice.

Places are settled first: a pass without a shuffle writes the records with their
place, and everything after reads that table. So a task that is run again, after
an executor was lost, sees the same places, buckets and ranks.

Defined results: a record's size is the bytes of its text and 1, of a null text
1, and its checksum that of the bytes, 0 for none. Equal records and ids are
records of their own. Records come back whole, nulls as nulls, as the struct
``record``, so no column of theirs can clash. An empty table gives empty shards;
with fewer records than shards the last shards are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerlake.operators.joins import written
from tellerlake.sources.workspace import new_dir

SHARDS, SEED = 8, 13
#: Bytes of text in a bucket; a record counts 64 bytes more for its other columns.
BUCKET_BYTES, RECORD_BYTES = 32 << 20, 64
#: Of the records written, which are whole texts twice.
COMPRESSION = "zstd"
#: The table of first ranks has a row a bucket, so this bounds what is broadcast (2 MB).
MAX_BUCKETS = 1 << 17


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A permutation of 0 .. n - 1: from the last place down, each is swapped with one at or before it."""
    order = np.arange(n)
    # All draws at once: the k-th is uniform over the places 0 .. n - 1 - k.
    draws = np.random.default_rng(seed).integers(0, np.arange(n, 0, -1)).tolist()
    places = order.tolist()
    for last, drawn in zip(range(n - 1, 0, -1), draws):
        places[last], places[drawn] = places[drawn], places[last]
    return np.array(places, np.int64)


def placed(docs: DataFrame, text: str) -> DataFrame:
    """(record, size, checksum, place), written once: places cannot change afterwards."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        record.alias("record"),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("checksum"),
        F.monotonically_increasing_id().alias("place"),
    )
    path = new_dir(docs.sparkSession, "shard-places")
    rows.write.option("compression", COMPRESSION).parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def bucket_of(buckets: int, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), F.col("place")), F.lit(buckets)).cast("int")


def _permuted(seed: int):
    """Each bucket of a task in shuffled order, with ranks from its first one."""

    def shuffled(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        by_place = pc.sort_indices(table["place"]).to_numpy()
        bucket, first = table["bucket"][0].as_py(), table["first_rank"][0].as_py()
        order = by_place[fisher_yates(len(table), [seed, bucket])]
        taken = table.select(["record", "size", "checksum"]).take(pa.array(order))
        ranks = pa.array(np.arange(first, first + len(table)))
        return taken.append_column("rank", ranks).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if len(batch):
                held.append(batch)
        if held:
            yield from shuffled(held)

    return run


def shuffle(
    docs: DataFrame,
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """``docs`` shuffled and written to ``path``, a folder a shard: (record, size, checksum, slot, shard).

    The files of a shard, by their slots, are its shuffled order.
    """
    spark = docs.sparkSession
    rows = placed(docs, text)
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("size") + RECORD_BYTES), F.lit(0))).first()
    buckets = min(max(1, -(-total // bucket_bytes)), MAX_BUCKETS)
    rows = rows.withColumn("bucket", bucket_of(buckets, seed))
    counts = rows.groupBy("bucket").count()
    # One row a bucket, MAX_BUCKETS at most: small enough for one window and a broadcast.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first_rank"))
    first = written(first, "shard-ranks")
    scattered = rows.join(F.broadcast(first), "bucket").repartitionById(buckets, "bucket")
    schema = StructType([rows.schema[c] for c in ("record", "size", "checksum")]).add("rank", "long")
    ranked = scattered.mapInArrow(_permuted(seed), schema)
    # The first n % shards shards hold one record more than the others.
    small, more = divmod(n, shards)
    edge, rank = more * (small + 1), F.col("rank")
    late = F.lit(more) + F.floor((rank - edge) / F.lit(max(small, 1)))
    shard = F.when(rank < edge, F.floor(rank / F.lit(small + 1))).otherwise(late).cast("int")
    start = F.least(F.col("shard"), F.lit(more)) + F.col("shard").cast("bigint") * F.lit(small)
    sliced = ranked.withColumn("shard", shard).withColumn("slot", rank - start).drop("rank")
    path = path or new_dir(spark, "shards")
    sliced.sortWithinPartitions("shard", "slot").write.option("compression", COMPRESSION).partitionBy("shard").parquet(path)
    return spark.read.schema(sliced.schema).parquet(path)
