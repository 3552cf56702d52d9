import numpy as np
import pytest
from pyspark.sql import functions as F
from tellerlake.llm import mil, queries

SF = "/root/testdata/sf0.01"


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    model = mil.Model(np.zeros(mil.FEATURES), np.ones(mil.FEATURES), 0.6)
    model.p = {k: rng.normal(0, 0.4, np.shape(v)) for k, v in model.p.items()}
    bags, y = [rng.normal(size=(n, mil.FEATURES)) for n in (1, 4, 2)], np.array([1.0, 0.0, 1.0])
    x, starts = np.concatenate(bags), np.array([0, 1, 5])

    def loss():
        s = model.forward(x, starts)[0]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, gradient in model.gradients(x, starts, y, 0.0).items():
        flat, at = model.p[name].reshape(-1), rng.integers(np.size(gradient))
        before, step = flat[at], 1e-5
        values = []
        for sign in (1, -1):
            flat[at] = before + sign * step
            model.p[name] = flat.reshape(np.shape(gradient))
            values.append(loss())
        flat[at] = before
        model.p[name] = flat.reshape(np.shape(gradient))
        assert np.reshape(gradient, -1)[at] == pytest.approx((values[0] - values[1]) / (2 * step), abs=1e-6)


def test_attention_weighs_all_passages():
    model = mil.Model(np.zeros(mil.FEATURES), np.ones(mil.FEATURES), 0.5)
    bag = np.random.default_rng(1).normal(size=(300, mil.FEATURES))
    weight = model.forward(bag, np.array([0]))[1][4]
    assert weight.sum() == pytest.approx(1) and (weight > 0).all()
    assert len(mil.passages(b"word " * 20_000)) == -(-20_000 // mil.PASSAGE_WORDS)


def test_edge_rows(spark):
    rows = [(1, "A fine text."), (1, "A fine text."), (2, None), (3, ""), (None, "### ###"), (4, "long text " * 100_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    model = mil.train(docs, labels)
    scored = mil.score(docs, model)
    assert scored.columns == ["doc_id", "text", "score"]
    got = [r.score for r in scored.collect()]
    assert len(got) == 6 and all(0 <= s <= 1 for s in got) and got[0] == got[1]
    none = mil.train(docs, labels.limit(0))
    assert {r.score for r in mil.score(docs, none).collect()} == {0.5}
    assert mil.score(docs.limit(0), none).count() == 0


def test_query_is_accurate_on_held_out_rows(spark):
    got = queries.QUERIES["op5_quality"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    got = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = got.where("held_out").select((F.col("predicted") == F.col("quality")).alias("right"), "quality").collect()
    assert {r.quality for r in rows} == {0, 1}
    assert sum(r.right for r in rows) >= 0.95 * len(rows)
    assert spark.read.parquet(f"{SF}/documents.parquet").count() == queries.QUERIES["op5_quality"](spark, SF).count()


def test_repeated_rows_of_labelled_ids_do_not_push_out_a_label(spark):
    good = [(k, f"A calm and careful sentence about harbour number {k}, with its own ending.") for k in range(8)]
    bad = [(k, "### $$$ !!! ### buy buy buy !!!") for k in range(8, 16)]
    docs = spark.createDataFrame(good + bad + bad[:1] * 400 + bad * 40, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(k, int(k < 8)) for k in range(16)], "doc_id long, quality int")
    model = mil.train(docs, labels, max_labels=16)
    assert model.trained and model.prior == 0.5
    means = mil.score(docs, model).groupBy((F.col("doc_id") < 8).alias("good")).agg(F.min("score"), F.max("score")).collect()
    found = {r.good: r for r in means}
    assert found[True]["min(score)"] > 0.5 > found[False]["max(score)"]


def test_fitting_learns_from_every_passage(spark):
    calm, junk = "harbour light over quiet water ", "### $$$ !!! ### %%% buy "
    long = [(k, calm * 2_000) for k in range(40)]
    # One passage of junk behind some of 160 others, at a different place in each.
    for k in range(20):
        words = long[k][1].split()
        at = 64 * (2 * (3 + 3 * k) + 1)
        long[k] = (k, " ".join([*words[:at], *(junk * 11).split()[:64], *words[at + 64 :]]))
    docs = spark.createDataFrame(long, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k >= 20)) for k in range(40)], "doc_id long, quality int")
    model = mil.train(docs, labels)
    stacked = np.concatenate([mil.passages(t.encode()) for _, t in long])
    assert np.allclose(model.mean, stacked.mean(axis=0), atol=1e-5)
    assert np.allclose(model.scale, stacked.std(axis=0) + 1e-3, atol=1e-4)
    scores = {r.doc_id: r.score for r in mil.score(docs, model).collect()}
    assert max(scores[k] for k in range(20)) < 0.5 < min(scores[k] for k in range(20, 40))
