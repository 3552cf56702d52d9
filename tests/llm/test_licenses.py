import random
import re

from pyspark.sql import functions as F
from tellerlake.llm import licenses, queries

SF = "/root/testdata/sf0.01"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def places(words, phrase):
    phrase = phrase.split()
    return [k for k in range(len(words) - len(phrase) + 1) if words[k : k + len(phrase)] == phrase]


def check(rows, got):
    assert len(got) == len(rows)
    for r in got:
        words = words_of(rows[r.doc_id])
        assert r.n_words == len(words)
        for label, phrase in licenses.BASE.items():
            assert r.base[label] == places(words, phrase), (label, rows[r.doc_id])
        for label, (_, key) in licenses.NOTICES.items():
            assert (label in r.notices) == bool(places(words, key)), (label, rows[r.doc_id])
        assert 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.notices or any(r.base[x] for x in licenses.BASE))


def test_places_equal_brute_force(spark):
    rng = random.Random(12)
    parts = [p for p in licenses.BASE.values()] + [n for n, _ in licenses.NOTICES.values()] + licenses.VOCABULARY + ["İ", "K", "word", "License", "MIT", "-", "GNU"]
    rows = {k: (rng.choice([" ", "-", "\n"])).join(rng.choices(parts, k=rng.randint(0, 14))) for k in range(400)}
    rows |= {1000: None, 1001: "", 1002: "cc by cc by cc cc by", 1003: "filler " * 100_000 + "MIT License", 1004: "mit " * 5000 + "license " * 5000}
    table = spark.createDataFrame([(k, t, "z") for k, t in rows.items()], "doc_id long, text string, base string")
    found = licenses.scan(table)
    assert found.columns == ["doc_id", "text", "n_words", "base", "notices", "score"]
    check(rows, found.collect())


def test_edge_tables(spark):
    table = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, None)], "doc_id long, text string")
    assert sorted(r.score for r in licenses.scan(table).collect()) == [0.0, 1.0, 1.0]
    assert licenses.scan(table.limit(0)).count() == 0


def test_query_over_the_whole_table(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op9_licenses"](spark, SF)
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        words = words_of(rows[r.doc_id])
        at = sorted((k, label) for label, phrase in licenses.BASE.items() for k in places(words, phrase))
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert any(r.n_base for r in out)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert got.where(F.col("n_base") > 0).count() == sum(r.n_base > 0 for r in out)


def test_score_is_that_of_the_best_place(spark):
    rows = []
    for k, (notice, key) in enumerate(licenses.NOTICES.values()):
        rows.append((k, f"see the {key} in passing and later {notice} end of file"))
        rows.append((100 + k, f"{notice} first and then the {key} in passing"))
    rows.append((1000, "the mozilla public license in passing"))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in licenses.scan(table).collect()}
    assert 0.5 < got.pop(1000) < 1
    assert set(got.values()) == {1.0}
