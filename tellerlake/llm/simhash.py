"""Near-duplicates by SimHash with Golay-code keys.

A 64-bit fingerprint has two segments of 23 bits and a rest of 18. Each segment
is decoded, together with its 23 one-bit neighbours, to the indices of nearby
Golay codewords, one or six of them; segments that differ in two bits or fewer
share an index. With four errors or fewer in all, the pigeonhole leaves these
cases, and each makes fingerprints share a key of 30 bits or more:

* two errors or fewer in either segment and in the rest: an index of one with an
  index of the other and with one third of the rest, which has no error;
* two or fewer in either segment, three or more in the rest: the segments have
  one at most, so one is equal and so is a half of the other;
* three or more in the first segment: the second and the rest have one at most,
  so the rest is equal and the second shares an index, or the second is equal and
  so is one half of the rest;
* three or more in the second: likewise.

Fingerprints that share a key are joined and their distance is verified.

Only classes are needed, not all pairs. So equal fingerprints are one node;
within a key everything is first compared with the smallest and the largest
fingerprint there; and the join that compares the rest leaves out what is
already in one class. No link between different classes can be lost by that,
and a large group of near copies does not become a square of pairs. Classes come
from alternating large-star and small-star steps, each written to the shared
folder.

Defined results: a null text counts as empty; texts without a word have
fingerprint zero and link like any other; repeated rows are returned as often as
they occur; a null id never names a class that has another id; an empty table
gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.golay import Golay
from tellerlake.llm.words import spaced_words
from tellerlake.operators.joins import on_hot_key, written

SHINGLE = 4
SEED = 42
#: The key cases above hold for this many differing bits.
MAX_DISTANCE = 4
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 15
#: Fingerprints whose keys one task makes: some two million rows.
NODES_PER_TASK = 20_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of the text's shingles, as a signed 64-bit number."""
    import xxhash

    words = spaced_words(text)
    if not words:
        return 0
    joined, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
    size = min(shingle, len(words))
    starts, ends = [0, *ends[: len(words) - size]], ends[size - 1 :]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(ends), BLOCK):
        pairs = zip(starts[k : k + BLOCK], ends[k : k + BLOCK])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(ends), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each text in ``out``."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in batch.cast(pa.binary())], pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(out, F.arrow_udf(run, "bigint")(F.col(f"`{text}`")))


def keys_of(values: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) for every distinct key of every fingerprint."""
    values = values.astype("<u8", copy=False) if values.dtype == np.uint64 else values.view(np.uint64)
    first, second, rest = (values & 0x7FFFFF), (values >> np.uint64(23)) & 0x7FFFFF, values >> np.uint64(46)
    row = np.arange(len(values))

    def indices(segment):
        near = golay.nearby(segment.astype(np.uint32)).astype(np.uint64)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        # One or six distinct indices a word; the other places repeat the first.
        place = np.cumsum(new, axis=1) - 1
        out = np.repeat(near[:, :1], 6, axis=1)
        at, column = np.nonzero(new)
        out[at, place[at, column]] = near[at, column]
        return out, new.sum(axis=1)

    (a, na), (b, nb) = indices(first), indices(second)
    slot, parts = np.arange(6), []

    def add(case: int, keys: np.ndarray, use: np.ndarray):
        at = np.nonzero(use)[0]
        parts.append((row[at], (np.uint64(case) << np.uint64(56)) | keys[use]))

    use_a, use_b = slot[None, :] < na[:, None], slot[None, :] < nb[:, None]
    both = ((a << np.uint64(12))[:, :, None] | b[:, None, :]).reshape(len(row), 36)
    use = (use_a[:, :, None] & use_b[:, None, :]).reshape(len(row), 36)
    for third in range(3):
        add(8 + third, (both << np.uint64(6)) | ((rest >> np.uint64(6 * third)) & 0x3F)[:, None], use)
    add(2, (rest << np.uint64(12))[:, None] | b, use_b)
    add(3, (rest << np.uint64(12))[:, None] | a, use_a)
    every = np.ones((len(row), 1), bool)
    halves = [(segment, half) for segment in (second, first) for half in (rest & 0x1FF, rest >> np.uint64(9))]
    halves += [(x, half) for x, y in ((first, second), (second, first)) for half in (y & 0xFFF, y >> np.uint64(12))]
    for case, (segment, half) in enumerate(halves, 16):
        add(case, ((segment << np.uint64(12)) | half)[:, None], every)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    golay = Golay()
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for k in range(0, len(values), 4096):
            part = values[k : k + 4096]
            at, keys = keys_of(part, golay)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(part[at])], ["key", "node"])


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_DISTANCE


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): the smallest node it can reach.

    Alternating large-star and small-star steps until nothing changes. Every
    step groups with partial sums and joins; nothing is gathered.
    """

    def state(edges):
        return edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()

    def downwards(edges):
        return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    def star(edges, large: bool):
        turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        around = edges.union(turned) if large else downwards(edges)
        least = around.groupBy(F.col("a").alias("center")).agg(F.min("b").alias("least"))
        least = least.withColumn("least", F.least("center", "least"))
        met = around.join(least, on_hot_key("a", "center"))
        if large:
            kept = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        else:
            kept = met.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
                least.select(F.col("center").alias("a"), F.col("least").alias("b"))
            )
        return kept.where(F.col("a") != F.col("b")).distinct()

    edges = written(downwards(links.where(F.col("a") != F.col("b"))).distinct(), label)
    before = state(edges)
    while before[0]:
        edges = written(star(star(edges, True), False), label)
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def keyed(nodes: DataFrame) -> DataFrame:
    """(key, node) for every key of every fingerprint.

    A node becomes about a hundred rows, so nodes are dealt to as many tasks as
    their keys ask for, not to as few as their own bytes would.
    """
    tasks = nodes.count() // NODES_PER_TASK + 1
    return nodes.select("node").repartition(tasks, "node").mapInArrow(_emit_keys, "key long, node long")


def classes(nodes: DataFrame) -> DataFrame:
    """(node, root) of the fingerprints in ``nodes`` that link to another one; the root is the smallest of the class."""
    # Cheaper made twice than written: most keys belong to one node and go no further.
    keys = keyed(nodes)
    span = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    span = written(span.withColumnRenamed("key", "shared"), "simhash-spans")
    shared = keys.join(span, on_hot_key("key", "shared"))
    shared = written(shared.select("key", "node", "low", "high"), "simhash-shared")
    stars = [
        shared.where((F.col("node") != F.col(end)) & _near("node", end)).select(F.col("node").alias("a"), F.col(end).alias("b"))
        for end in ("low", "high")
    ]
    first = written(components(stars[0].union(stars[1]).distinct(), "simhash-stars"), "simhash-first")
    labelled = shared.select("key", F.col("node").alias("fp")).join(first, on_hot_key("fp", "node"), "left")
    labelled = labelled.select("key", "fp", F.coalesce("root", "fp").alias("root"))
    labelled = written(labelled, "simhash-labelled")
    mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    mixed = mixed.select(F.col("key").alias("mixed"))
    left = labelled.join(mixed, on_hot_key("key", "mixed"), "left_semi")
    left = written(left, "simhash-mixed")
    right = left.select(F.col("key").alias("key2"), F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    crossing = left.join(right, on_hot_key("key", "key2") & (F.col("root") < F.col("root2")) & _near("fp", "fp2"))
    links = crossing.select(F.col("root").alias("a"), F.col("root2").alias("b"))
    second = components(links, "simhash-second").select(F.col("node").alias("inner"), F.col("root").alias("outer"))
    linked = first.union(second.select(F.col("inner").alias("node"), F.col("inner").alias("root"))).distinct()
    return (
        linked.join(second, on_hot_key("root", "inner"), "left")
        .groupBy("node")
        .agg(F.min(F.coalesce("outer", "root")).alias("root"))
    )


def _placed(docs: DataFrame, id: str, text: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, fp), and per fingerprint (node) the root and the smallest id of its class."""
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = fingerprints(rows, out="fp", shingle=shingle)
    rows = written(rows.select("id", "fp"), "simhash-fingerprints")
    nodes = written(rows.groupBy(F.col("fp").alias("node")).agg(F.min("id").alias("least")), "simhash-nodes")
    roots = classes(nodes).select(F.col("node").alias("linked"), "root")
    placed = nodes.join(roots, on_hot_key("node", "linked"), "left")
    placed = placed.select("node", "least", F.coalesce("root", "node").alias("root"))
    placed = written(placed, "simhash-placed")
    smallest = placed.groupBy(F.col("root").alias("class")).agg(F.min("least").alias("component_id"))
    return rows, placed.join(smallest, on_hot_key("root", "class")).select("node", "root", "component_id")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: its id, fingerprint and the smallest id that it reaches by links, ``component_id``."""
    rows, named = _placed(docs, id, text, shingle)
    placed = rows.join(named, on_hot_key("fp", "node"))
    return placed.select(F.col("id").alias(id), F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The row of ``docs`` with the smallest id of each class, unchanged.

    Of rows that repeat that id within the class one stays; of a class without any id, one row.
    """
    rows, named = _placed(docs, id, text, shingle)
    named = written(named, "simhash-named")
    per_id = rows.where("id IS NOT NULL").join(named, on_hot_key("fp", "node")).groupBy("id")
    per_id = per_id.agg(F.count("*").alias("n"), F.max(F.col("id") == F.col("component_id")).alias("stays"))
    # Whole texts meet only the ids that go or repeat, few beside those that stay.
    aside = written(per_id.where("n > 1 OR NOT stays"), "simhash-aside").select(F.col("id").alias("other"), "n")
    # The input's columns travel as one, so that no name can clash.
    records = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.col(f"`{id}`").alias("id"))
    single = records.where("id IS NOT NULL").join(aside, on_hot_key("id", "other"), "left_anti")
    again = records.join(aside.where("n > 1"), on_hot_key("id", "other"), "left_semi").union(records.where("id IS NULL"))
    again = fingerprints(again.withColumn("text", F.col("record").getField(text)), "text", "fp", shingle)
    again = again.join(named, on_hot_key("fp", "node")).where(F.col("id").eqNullSafe(F.col("component_id")))
    return single.select("record.*").union(again.dropDuplicates(["root"]).select("record.*"))
