import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tellerlake.llm import queries, simhash
from tellerlake.llm.golay import Golay

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + shingle]).encode(), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_classes(prints):
    """Smallest position that each fingerprint reaches over links of at most four bits."""
    label = list(range(len(prints)))
    values = np.array(prints, np.uint64)
    seen = [False] * len(prints)
    for k in range(len(prints)):
        if seen[k]:
            continue
        stack, seen[k] = [k], True
        while stack:
            at = stack.pop()
            label[at] = k
            for other in np.flatnonzero(np.bitwise_count(values ^ values[at]) <= 4):
                if not seen[other]:
                    seen[other] = True
                    stack.append(other)
    return label


def test_every_word_is_near_one_codeword():
    golay, rng = Golay(), np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 20_000, dtype=np.uint32)
    code = words ^ golay.error[golay.low[words & 0xFFF] ^ golay.high[words >> 12]]
    assert (golay.low[code & 0xFFF] ^ golay.high[code >> 12] == 0).all()
    assert np.bitwise_count(words ^ code).max() <= 3
    assert len(set((code >> 11).tolist())) == len(set(code.tolist()))


@pytest.mark.parametrize("errors", [0, 1, 2, 3, 4])
def test_near_fingerprints_share_a_key(errors):
    rng, golay = random.Random(errors), Golay()
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), errors):
            b ^= 1 << bit
        at, keys = simhash.keys_of(np.array([a, b], np.uint64), golay)
        assert set(keys[at == 0]) & set(keys[at == 1])


@pytest.mark.parametrize("segment", [(0, 23), (23, 46), (46, 64)])
def test_errors_in_one_segment_share_a_key(segment):
    rng, golay = random.Random(segment[0]), Golay()
    for errors in (3, 4):
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(*segment), errors):
                b ^= 1 << bit
            at, keys = simhash.keys_of(np.array([a, b], np.uint64), golay)
            assert set(keys[at == 0]) & set(keys[at == 1])


def test_fingerprints_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices(["Abc", "dé", " ", "\t", " ", "x", "\x1c", "YZ "], k=rng.randint(0, 60)))
        assert simhash.fingerprint(text.encode()) % 2**64 == brute_fingerprint(text), repr(text)
    assert simhash.fingerprint(None) == 0
    long = " ".join(rng.choices("abcdefgh", k=100_000))
    assert simhash.fingerprint(long.encode()) % 2**64 == brute_fingerprint(long)


def cluster(rng, n):
    """Fingerprints in chains and balls, some equal, some alone."""
    prints = []
    while len(prints) < n:
        centre, width = rng.getrandbits(64), rng.choice([0, 1, 2, 4, 5, 8])
        for _ in range(rng.choice([1, 2, 3, 40])):
            value = centre
            for bit in rng.sample(range(64), width):
                value ^= rng.getrandbits(1) << bit
            prints.append(value)
            if rng.random() < 0.3:
                centre = value
    return prints[:n]


def test_classes_equal_brute_force(spark):
    prints = cluster(random.Random(9), 900)
    # Two groups of thousands around neighbouring centres, as near copies make them.
    rng = np.random.default_rng(1)
    flips = (1 << rng.integers(0, 11, (1500, 3))).astype(np.uint64)
    prints += [int(0x123456789ABCDEF ^ np.bitwise_xor.reduce(f)) for f in flips]
    want = brute_classes(prints)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(v,) for v in set(signed)], "node long")
    root = {r.node: r.root for r in simhash.classes(nodes).collect()}
    groups = {}
    for k, v in enumerate(signed):
        groups.setdefault(root.get(v, v), set()).add(want[k])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want))


def test_edge_rows(spark):
    rows = [(5, None), (3, " \n"), (3, " \n"), (None, "a b c d e"), (9, "a b c d e"), (None, "only nameless words here"), (None, "only nameless words here")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in simhash.near_duplicates(docs).collect())
    shared = simhash.fingerprint(b"a b c d e")
    alone = simhash.fingerprint(b"only nameless words here")
    assert got == sorted([(5, 0, 3), (3, 0, 3), (3, 0, 3), (-1, shared, 9), (9, shared, 9), (-1, alone, -1), (-1, alone, -1)])
    kept = [(r.doc_id, r.text, r.fp) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, " \n", "x"), (9, "a b c d e", "x"), (None, "only nameless words here", "x")], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_columns_of_any_name_and_ids_that_repeat_with_other_texts(spark):
    rows = [(1, "one two three four five"), (2, "one two three four five"), (2, "quite other words stand here"), (2, "quite other words stand here")]
    rows += [(3, "a b " * 60_000)]
    names = "doc_id long, text string, __rows int, __kept int, record int, id int, root int, `n` int"
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], names)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.id) for r in kept.collect()) == sorted((*rows[k], 4) for k in (0, 2, 4))


def test_keys_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "NODES_PER_TASK", 100)
    rng = random.Random(1)
    nodes = spark.createDataFrame([(rng.getrandbits(63),) for _ in range(1000)], "node long").coalesce(1)
    assert simhash.keyed(nodes).select(F.spark_partition_id().alias("p")).distinct().count() >= 8


def test_query_over_the_whole_table(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    prints = [brute_fingerprint(t) for _, t in rows]
    label = brute_classes(prints)
    want = sorted((d, f"{p:016x}", rows[k][0]) for (d, _), p, k in zip(rows, prints, label))
    got = sorted(tuple(r) for r in queries.QUERIES["op10_simhash"](spark, SF).select("doc_id", "fingerprint", "component_id").collect())
    assert got == want
    kept = simhash.keep_one(spark.read.parquet(f"{SF}/documents.parquet")).agg(F.collect_set("doc_id")).first()[0]
    assert sorted(kept) == sorted({w[2] for w in want})
