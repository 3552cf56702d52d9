import random
import re

import __spark_entry__ as entry
from compare import differences, duck
from tellerlake.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, window=13):
    grams = {}
    for name, text in items:
        words = WORD.findall(lower(text))
        size = min(window, len(words))
        for k in range(len(words) - size + 1) if words else ():
            grams.setdefault(tuple(words[k : k + size]), set()).add(name)
    out = []
    for text in docs:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(words) - size + 1):
                if owners := grams.get(tuple(words[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= owners
        out.append((len(words), sorted(hit), sorted(found)))
    return out


def cases(seed, n):
    rng = random.Random(seed)
    pool = ["alpha", "Beta", "g4mma", "délta", "É", "x", "YZ"]
    items = [(str(k), " ".join(rng.choices(pool, k=rng.randint(0, 18)))) for k in range(12)]
    items += [("one", "lonely"), ("none", "?!"), ("dup", items[3][1]), ("dup", items[3][1])]
    texts = []
    for _ in range(n):
        parts = rng.choices(pool + ["İ", "-", "lonely", "\n"], k=rng.randint(0, 30))
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, len(parts)), rng.choice(items)[1].replace(" ", ", "))
        texts.append(" ".join(parts))
    return items, texts


def test_hits_equal_brute_force_in_one_and_in_many_blocks(spark):
    items, texts = cases(3, 300)
    texts += [None, "", "lonely", "LONELY lonely " * 40_000]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(None, None), (None, "shared words here"), *items], "item_id string, text string")
    want = brute(texts, [("", None), ("", "shared words here"), *items])
    for block_bytes in (1 << 20, 200):
        found = decontaminate.find(docs, bench, block_bytes=block_bytes)
        assert found.columns == ["doc_id", "text", "items", "hits"]
        got = {r.doc_id: (r.hits.n_words, r.hits.words, r.hits["items"]) for r in found.collect()}
        assert [got[k] for k in range(len(texts))] == want


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert [r.hits["words"] for r in decontaminate.find(docs, empty).collect()] == [[], [], []]
    assert decontaminate.find(docs.limit(0), empty).count() == 0
    assert decontaminate.drop_contaminated(docs, empty).count() == 3


def test_removal_of_documents_and_spans(spark):
    bench = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    rows = [(1, "Say: One, two -- three! " + "pad " * 10), (2, "one two three " + "pad " * 200), (3, "one two 3"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()) == [2, 3, 4]
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, bench).collect()}
    assert cut[1] == "Say: ! " + "pad " * 10
    assert cut[2] == " " + "pad " * 200
    assert (cut[3], cut[4]) == ("one two 3", None)


def test_query_equals_sql_over_the_whole_tables(spark):
    found = differences(queries.QUERIES["op8_decontamination"](spark, SF), duck(SF), entry.oracle_sql()["op8_decontamination"])
    assert not found, found


def test_repeated_items_are_collected_once(spark):
    items = [("a", "one two three four")] * 500 + [(str(k), f"own words of number {k}") for k in range(4)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    seen, whole = [], decontaminate.Index.__init__
    try:
        decontaminate.Index.__init__ = lambda self, rows, *a: (seen.extend(rows), whole(self, rows, *a))[1]
        found = decontaminate.find(docs, bench, block_bytes=600).first().hits
    finally:
        decontaminate.Index.__init__ = whole
    assert sorted(n for n, _ in seen) == ["0", "1", "2", "3", "a"]
    assert (found["words"], found["items"]) == ([0, 1, 2, 3], ["a"])
