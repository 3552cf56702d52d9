import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tellerlake.llm import queries, rules

SF = "/root/testdata/sf0.001"
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows, inside = defaultdict(list), set()
    for k in range(len(words) - 4):
        windows[tuple(words[k : k + 5])].append(k)
    for at in windows.values():
        if len(at) > 1:
            for k in at:
                inside.update(range(k, k + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def texts(n):
    rng = random.Random(6)
    out = [None, "", " \n ", "a", "a a a a a", "a a a a a a", "x\nx\n\n\nx \nx", "a b c d e a b c d e", "İ é 😀 \x1c z\x0bq", "same " * 30_000]
    for _ in range(n):
        out.append("".join(rng.choices(["a", "b", "cd", "#", "é", "😀", "!"], k=1)[0] + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 40))))
    return out


def test_counts_equal_brute_force(spark):
    rows = [(k, t, "x") for k, t in enumerate(texts(300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places string")
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in rules.measure(docs).collect()}
    for k, t, _ in rows:
        assert got[k] == brute(t), repr(t)[:200]


@pytest.mark.parametrize("n,k", [(0, 0), (1, 0), (59, 0), (100, 1), (1000, 30), (1000, 49), (40_000, 1900), (10, 10)])
def test_binomial_tail_is_exact(spark, n, k):
    got = spark.range(1).select(rules.binomial_tail(F.lit(n), F.lit(k), 0.05)).first()[0]
    if k >= n * 0.05:
        assert got == 1
        return
    log = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
    want = sum(math.exp(log(j) + j * math.log(0.05) + (n - j) * math.log(0.95)) for j in range(k + 1))
    assert got == pytest.approx(want, rel=1e-8)


def test_levels_follow_the_labels(spark):
    """A language with clean labelled rows gets strict cutoffs, one whose good rows look damaged or are few gets none."""
    clean, loud = "some plain words in a row here ok now %d", "# some * plain $ words in a & row | here ok now %d"
    rows = [(k, clean % k, "aa") for k in range(400)] + [(1000 + k, loud % k, "bb") for k in range(400)] + [(5000 + k, clean % k, None) for k in range(20)]
    rows += [(9001, loud % 9, "aa"), (9002, loud % 9, "bb"), (9003, loud % 9, None), (9004, loud % 9, "unseen"), (9005, "short", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.where("doc_id < 9000").select("doc_id", F.lit(1).alias("quality"))
    labels = labels.union(labels).union(spark.createDataFrame([(None, 1), (9001, None), (9001, 0)], "doc_id long, quality int"))
    kept = {r.doc_id: r.kept for r in rules.judge(docs, labels).collect()}
    assert [kept[k] for k in (9001, 9002, 9003, 9004, 9005)] == [False, True, True, True, False]
    assert all(kept[k] for k in kept if k < 9000)


def test_edge_tables(spark):
    docs = spark.createDataFrame([(1, None, None), (1, None, None), (None, "w " * 12, "x")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted((r.n_words, r.base_failed, r.kept) for r in rules.judge(docs, none).collect()) == [(0, True, False), (0, True, False), (12, True, False)]
    assert rules.judge(docs.limit(0), none).count() == 0


def test_query_over_the_whole_table(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op4_rules"](spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(rows[r.doc_id])
        assert tuple(r[n] for n in NAMES) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_false_rejections_stay_within_the_guarantee(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    # Cutoffs from one half of the labels, false rejections counted on the other.
    half = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2))
    judged = rules.judge(docs, labels.where(half == 0)).join(labels.where((half == 1)), "doc_id")
    share = {r.quality: r.kept for r in judged.where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 1 - rules.ALPHA
    assert share[0] < 0.5


def test_copies_of_an_id_are_one_trial(spark):
    clean = "some plain words in a row here ok now yes"
    docs = spark.createDataFrame([(1, clean, "aa")] * 400 + [(2, "# $ % " * 9, "aa"), (2, clean, "aa"), (3, "short", "aa")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in (1, 1, 2, 3)], "doc_id long, quality int")
    measured = rules.measure(docs.withColumnRenamed("lang", "stratum")).withColumns(rules.levels_passed())
    found = rules.cutoffs(measured, labels).collect()
    # The third fails the base rules and is no trial; two prove nothing.
    assert [(r.stratum, r.n_good, *(r[m] for m in rules.LEVELS)) for r in found] == [("aa", 2, 0, 0, 0, 0, 0, 0)]


def test_the_guarantee_holds_over_many_draws(spark):
    """160 strata whose good documents exceed each step of a measure at known rates: those that are granted a step
    with a true rate over ALPHA are fewer than DELTA allows for all together, and easy steps are granted."""
    rng = np.random.default_rng(0)
    rates = [0.001, 0.002, 0.02, 0.06, 0.08, 0.1, 0.2, 0.3]
    rows = []
    for stratum in range(160):
        draws = rng.random(600)
        for k, u in enumerate(draws):
            # Passed levels so that the share passing fewer than j levels is rates[j - 1].
            within = sum(bool(u >= r) for r in rates)
            rows.append((stratum * 1000 + k, str(stratum), 50, 0, within, *[rules.N_LEVELS] * 5))
    names = "doc_id long, stratum string, n_words long, n_repeat_words long, " + ", ".join(f"{c} int" for c in rules.PASSED.values())
    measured = spark.createDataFrame(rows, names)
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    granted = [r["symbols"] for r in rules.cutoffs(measured, labels).collect()]
    assert len(granted) == 160 and all(rates[g - 1] <= rules.ALPHA for g in granted if g)
    assert sum(g >= 2 for g in granted) > 100


def test_plan_is_native(spark):
    plan = queries.QUERIES["op4_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_a_measure_that_a_language_exceeds_leaves_the_others(spark):
    """Words of over 20 letters are usual where there are no spaces; symbols are not."""
    plain, loud = " ".join(["w" * 25] * 6 + ["%d" + "v" * 30] * 6), "# some * plain $ words in a & row | here ok now %d"
    rows = [(k, plain % ((k,) * 6), "zz") for k in range(400)] + [(9001, loud % 1, "zz")]
    docs = spark.createDataFrame([(k, " ".join(f"{w}{n}" for n, w in enumerate(t.split())), g) for k, t, g in rows], "doc_id long, text string, lang string")
    labels = docs.where("doc_id < 9000").select("doc_id", F.lit(1).alias("quality"))
    kept = {r.doc_id: r.kept for r in rules.judge(docs, labels).collect()}
    assert not kept.pop(9001) and all(kept.values())


def test_every_language_has_its_own_cutoffs(spark):
    """Of 70 languages those with loud good documents keep theirs, the others reject them."""
    clean, loud = "some plain words in a row here ok now yes %d", "# some * plain $ words in a & row | here ok now %d"
    docs = spark.range(70 * 500).select(
        F.col("id").alias("doc_id"),
        F.when((F.col("id") % 70 < 67) & (F.col("id") >= 70), F.lit(clean)).otherwise(F.lit(loud)).alias("text"),
        (F.col("id") % 70).cast("string").alias("lang"),
    )
    labels = docs.where("doc_id >= 70").select("doc_id", F.lit(1).alias("quality"))
    judged = rules.judge(docs, labels).where("doc_id < 70").collect()
    assert {r.doc_id for r in judged if r.kept} == {67, 68, 69}
