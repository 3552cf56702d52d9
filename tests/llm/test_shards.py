import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tellerlake.llm import queries, shards

SF = "/root/testdata/sf0.001"


def laid_out(rows, n, count=8):
    """Checks the law and returns the ids in shuffled order."""
    sizes = Counter(r.shard for r in rows)
    assert [sizes[s] for s in range(count)] == [n // count + (s < n % count) for s in range(count)]
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(count) for k in range(sizes[s])]
    return sorted(rows, key=lambda r: (r.shard, r.slot))


def test_the_permutation_is_the_textbook_one():
    for n in (0, 1, 2, 50):
        order = list(range(n))
        draws = np.random.default_rng([3, n]).integers(0, np.arange(n, 0, -1))
        for step, last in enumerate(range(n - 1, 0, -1)):
            order[last], order[draws[step]] = order[draws[step]], order[last]
        assert shards.fisher_yates(n, [3, n]).tolist() == order
    seen = Counter(tuple(shards.fisher_yates(3, [seed])) for seed in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400


def test_order_equals_brute_force(spark):
    docs = spark.createDataFrame([(k, "w" * (k % 50)) for k in range(1000)], "doc_id long, text string").repartition(4)
    got = shards.shuffle(docs, bucket_bytes=8_000, seed=99)
    rows = laid_out(got.select("record.doc_id", "shard", "slot").collect(), 1000)
    # The same from the settled places, in one list a bucket.
    placed = shards.placed(docs, "text")
    total = placed.agg(F.sum(F.col("size") + shards.RECORD_BYTES)).first()[0]
    buckets = -(-total // 8_000)
    assert buckets > 8
    held = {}
    for r in placed.select("record.doc_id", "place", shards.bucket_of(buckets, 99).alias("b")).collect():
        held.setdefault(r.b, []).append((r.place, r.doc_id))
    want = []
    for b in sorted(held):
        ids = [d for _, d in sorted(held[b])]
        want += [ids[k] for k in shards.fisher_yates(len(ids), [99, b])]
    assert [r.doc_id for r in rows] == want
    assert sum(abs(k - d) for k, d in enumerate(want)) > 1000 * 250


def test_a_hot_group_spreads_and_files_belong_to_one_shard(spark):
    rows = [(7, "same text") for _ in range(600)] + [(k, f"text {k}") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = shards.shuffle(docs, bucket_bytes=9_000)
    hot = Counter(r.shard for r in got.where("record.text = 'same text'").collect())
    assert min(hot[s] for s in range(8)) > 40
    assert Counter((r.doc_id, r.text) for r in got.select("record.*").collect()) == Counter(rows)
    folders = got.select(F.regexp_extract(F.input_file_name(), r"shard=(\d)", 1).cast("int").alias("f"), "shard")
    assert folders.where("f <> shard").count() == 0


def test_edges(spark):
    rows = [(1, None, "a", 5), (None, "", None, 6), (1, "é" * 300_000, "a", 7), (1, None, "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `shard` string, `a b.c` int")
    got = shards.shuffle(docs).collect()
    laid_out(got, 4)
    assert Counter(tuple(r.record) for r in got) == Counter(rows)
    for r in got:
        content = (r.record.text or "").encode()
        assert (r["size"], r.checksum) == (len(content) + 1, zlib.crc32(content))
    assert shards.shuffle(docs.limit(0)).count() == 0
    assert [r.slot for r in shards.shuffle(docs, shards=1).orderBy("slot").collect()] == [0, 1, 2, 3]


def test_query_over_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.QUERIES["op13_shards"](spark, SF).collect()
    laid_out(got, len(table))
    want = sorted((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in table)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    again = queries.QUERIES["op13_shards"](spark, SF).collect()
    assert sorted(again) == sorted(got)
