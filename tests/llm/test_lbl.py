import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tellerlake.llm import lbl, queries

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


def brute(rows):
    """Per row: tokens, known tokens, base score, as the contract words it."""
    remainder = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 for d, _ in rows]
    counts = Counter()
    for (_, text), r in zip(rows, remainder):
        if r != 1:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for (_, text), r in zip(rows, remainder):
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        out.append((r == 1, len(own), sum(counts[t] > 0 for t in own), total, base))
    return out


def small_model(seed=0):
    share = np.random.default_rng(seed).random(lbl.CLASSES)
    return lbl.Parameters(share / share.sum())


def test_probabilities_are_normalised():
    p, rng = small_model(), np.random.default_rng(2)
    p.a = {k: rng.normal(0, 0.7, v.shape) for k, v in p.a.items()}
    tables = lbl.Tables(p)
    every = np.arange(lbl.CLASSES)
    for a, b in rng.integers(0, lbl.CLASSES, (20, 2)):
        one, two = np.full(lbl.CLASSES, a), np.full(lbl.CLASSES, b)
        assert np.power(10, tables.log10(one, two, every)).sum() == pytest.approx(1, abs=1e-3)
        r = p.a["context"][a] @ p.a["place"][: lbl.WIDTH] + p.a["context"][b] @ p.a["place"][lbl.WIDTH :]
        s = p.a["target"] @ r + p.a["bias"][:, 0]
        plain = (s - np.log(np.exp(s).sum())) / np.log(10)
        assert np.allclose(tables.log10(one, two, every), plain, atol=1e-3)


def test_training_learns_a_regular_sequence():
    p, rng = small_model(), np.random.default_rng(1)
    target = np.tile([5, 9, 2, 700], 4000)
    one, two, target = lbl.contexts([target])
    before = lbl.Tables(p).log10(one, two, target).mean()
    for k in range(0, len(target) - lbl.BATCH, lbl.BATCH):
        p.train(one[k : k + lbl.BATCH], two[k : k + lbl.BATCH], target[k : k + lbl.BATCH], rng)
    assert lbl.Tables(p).log10(one, two, target).mean() > before + 1


def test_a_run_of_targets_is_trained_in_steps_of_a_batch(monkeypatch):
    target = np.random.default_rng(1).integers(1, lbl.CLASSES, 5 * lbl.BATCH + 70)
    one, two, target = lbl.contexts([target[:300], target[300:]])
    whole, steps, rng = small_model(), small_model(), np.random.default_rng(2)
    monkeypatch.setattr(lbl, "STEPS", 2)
    whole.train(one, two, target, np.random.default_rng(2))
    for k in range(0, len(target), lbl.BATCH):
        at = slice(k, k + lbl.BATCH)
        steps.train(one[at], two[at], target[at], rng)
    for k in whole.a:
        assert np.array_equal(whole.a[k], steps.a[k]) and np.array_equal(whole.squares[k], steps.squares[k])
        assert not np.array_equal(whole.a[k], small_model().a[k])


def test_tokens_of_a_whole_array_are_those_of_each_text():
    texts = ["  A b\t\nİ\x1cÉ\x0b\x0c\r c\x85d ", None, "", " ", "x", "\n\n", "é\xa0y zz"]
    array = pa.array(["left out", *texts, "too"]).slice(1, len(texts))
    for form in (array, array.cast(pa.binary()), array.cast(pa.large_string())):
        words, sizes = lbl.tokens(form)
        want = [[t.encode() for t in tokens(x)] for x in texts]
        assert (words.to_pylist(), sizes.tolist()) == ([w for x in want for w in x], [len(x) for x in want])
        assert lbl.spellings(words).tolist() == [lbl.spelling(w) for w in words.to_pylist()]
        assert lbl.spellings(words.slice(2, 4)).tolist() == [lbl.spelling(w) for w in words.to_pylist()[2:6]]
    broken = pa.array([b"a\xff B\xc3", b" \x80"])
    assert lbl.tokens(broken)[0].to_pylist() == [b"a\xff", b"b\xc3", b"", b"\x80", b""]


def test_pieces_hold_every_text_once():
    texts = [None, "aaaa", "bbbb", "c" * 30, "", "dd", "e" * 9, None]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["t"]) for x in (texts, [], texts[:1])]
    pieces = [p.column(0).to_pylist() for p in lbl._pieces(iter(batches), 10)]
    assert [t for p in pieces for t in p] == [*texts, None]
    assert all(len(p) == 1 or 0 < sum(map(len, filter(None, p))) <= 10 for p in pieces)


def test_words_outside_the_lexicon_take_no_call_each(monkeypatch):
    class Sent:
        def __init__(self, value):
            self.value = value

    model = lbl.Model({b"the": 1}, 10, 3, np.ones(lbl.CLASSES), np.ones(lbl.CLASSES), small_model())
    run = lbl._scorer(Sent(vars(model)), Sent({b"the": 5, b"of": 3}))
    texts = ["", None, " ".join(f"the w{k} w{k} of" for k in range(30_000)), "w7 w0"]
    batch = pa.RecordBatch.from_arrays([pa.array(["1", None, "3", "4"]), pa.array(texts)], ["id", "text"])
    list(run(iter([batch.slice(0, 1)])))
    calls, spelling = [], lbl.spelling
    monkeypatch.setattr(lbl, "spelling", lambda word: calls.append(word) or spelling(word))
    rows = [r for out in run(iter([batch])) for r in out.to_pylist()]
    assert len(calls) <= 2
    of_text = {r["id"]: (r["n_tokens"], r["n_known"], r["copies"]) for r in rows if r["word"] is None}
    assert of_text == {"1": (1, 0, 1), None: (1, 0, 1), "3": (120_001, 60_000, 1), "4": (3, 0, 1)}
    times = Counter({(r["id"], r["word"]): r["times"] for r in rows if r["word"] is not None})
    want = {("3", b"w%d" % k): 2 for k in range(30_000)} | {("4", b"w7"): 1, ("4", b"w0"): 1}
    assert times == want | {(k, b""): 1 for k in ("1", None, "3", "4")}


def test_contexts_stop_at_the_text():
    one, two, target = lbl.contexts([np.array([4, 5, 6]), np.array([7]), np.array([8, 9])])
    assert (one.tolist(), two.tolist()) == ([0, 4, 5, 0, 0, 8], [0, 0, 4, 0, 0, 0])


def test_edge_rows(spark):
    rows = [(0, None), (0, None), (1, ""), (None, "Word word"), (2, "İ " * 50_000), (4, "w" * 300 + " word"), (17, "w" * 300)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = lbl.score(docs, queries.fold("doc_id", 5) == 1).collect()
    key = lambda r: (str(r[0]), r[1])
    have = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    want = sorted([(d, *b[1:]) for (d, _), b in zip(rows, brute(rows))], key=key)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    assert [h[4] for h in have] == pytest.approx([w[4] for w in want])
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lbl.score(docs.limit(0), F.lit(False)).count() == 0
    assert {r.train_tokens for r in lbl.score(docs, F.lit(True)).collect()} == {0}


def test_query_over_the_whole_table(spark, monkeypatch):
    # A lexicon of a few hundred words sends most of the words through the join.
    monkeypatch.setattr(lbl, "LEXICON", 900)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {d: b for (d, _), b in zip(rows, brute(rows))}
    got = queries.QUERIES["op3_lm"](spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
