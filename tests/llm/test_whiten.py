import numpy as np
import pytest
from tellerlake.llm import queries, vectors, whiten

SF = "/root/testdata/sf0.001"


def brute(x):
    """(n, exact deviations, eigenvalues falling, vectors, trace) of integer rows, from the whole covariance."""
    unique = np.unique(x, axis=0)
    n, sums = len(unique), unique.sum(axis=0)
    centred = (n * unique - sums) / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return n, ((n * x - sums) ** 2).sum(axis=1), values[::-1], columns[:, ::-1], values.sum(), (n * x - sums) / n


def check(got, fitted, x, ids, components):
    n, deviation, values, columns, trace, centred = brute(x)
    assert fitted.n == n
    assert np.allclose(fitted.values, values[:components], rtol=1e-11)
    assert np.allclose(fitted.explained, values[:components] / trace, rtol=1e-11)
    assert fitted.identity_error < 1e-9
    signs = np.sign((fitted.vectors * columns[:, :components]).sum(axis=0))
    want = centred @ (columns[:, :components] * signs) / np.sqrt(values[:components])
    rows = {}
    for k, at in enumerate(ids):
        rows.setdefault(at, []).append(k)
    for r in got:
        k = rows[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation[k])
        assert np.allclose(r.whitened, want[k], atol=1e-8)


def test_filtered_iteration_finds_the_leading_pairs(spark):
    rng = np.random.default_rng(7)
    # More dimensions than the block has columns, a close pair of eigenvalues, and a rest without width.
    for scales in (np.r_[60, 50, 49, 40, np.linspace(30, 10, 56)], np.r_[60, 50, 40, 30, np.full(56, 5)]):
        turn = np.linalg.qr(rng.standard_normal((60, 60)))[0]
        x = np.floor((rng.standard_normal((700, 60)) * scales) @ turn).astype(np.int64)
        rows = [(k, (v / 256).tolist()) for k, v in enumerate(x)] * 2
        docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
        got, fitted = whiten.whiten(docs)
        assert got.count() == 1400
        check(got.collect(), fitted, x, range(700), 4)
        assert fitted.passes < 120


def test_lower_bound_and_filter():
    rng = np.random.default_rng(1)
    values = np.r_[9.0, 8.0, np.linspace(5, 1, 40)]
    turn = np.linalg.qr(rng.standard_normal((42, 42)))[0]

    class Known:
        def times(self, q):
            return turn @ (values[:, None] * (turn.T @ q))

    v = Known()
    assert 0 <= whiten.lower_bound(v, 42, rng) <= 1.3
    q = np.linalg.qr(rng.standard_normal((42, 3)))[0]
    out = turn.T @ whiten.chebyshev(v, q, v.times(q), 1.0, 5.0, 9.0, 10)
    before = turn.T @ q
    grown = np.abs(out / before)
    assert grown[:2].min() > 1000 * grown[2:].max()


def test_edges(spark):
    rows = [(1, [1.0, 0.0, 0.5]), (1, [1.0, 0.0, 0.5]), (None, [-1.0, -0.0, 0.25]), (3, [0.0, 2.0, 0.125]), (4, [1.0, 0.0, 0.5])]
    bad = [(5, None), (6, []), (7, [None, 1.0, 1.0]), (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 0.0, 0.0]), (9, [1.0])]
    docs = spark.createDataFrame([(*r, 5, "w") for r in rows + bad], "vec_id long, embedding array<double>, n int, x string")
    got, fitted = whiten.whiten(docs)
    assert got.columns == ["vec_id", "n", "deviation", "whitened"]
    x = np.floor(np.array([r[1] for r in rows]) * 256).astype(np.int64)
    # Three distinct vectors span two dimensions.
    assert len(fitted.values) == 2
    check(got.collect(), fitted, x, [r[0] for r in rows], 2)
    assert sorted(str(r.vec_id) for r in got.collect()) == sorted(str(r[0]) for r in rows)
    one, fitted = whiten.whiten(docs.where("vec_id = 4"))
    assert [(r.n, r.deviation, r.whitened) for r in one.collect()] == [(1, 0, [])]
    none, fitted = whiten.whiten(docs.limit(0))
    assert (none.count(), fitted.n) == (0, 0)


def test_deviation_beyond_64_bits_is_null_and_close_below_it_exact():
    sums = np.array([5, 7], object)
    assert whiten.deviations(np.array([[1 << 33, 0], [3, 1]]), 3, sums) == [None, 4**2 + 4**2]
    x = np.array([[1 << 40, -(1 << 40)]])
    assert np.allclose(whiten.centred(x, 1 << 30, np.array([1 << 62, 3], object)), x - np.array([2.0**32, 3 / 2**30]))


@pytest.mark.parametrize("name", ["op12_whitening"])
def test_query_over_the_whole_table(spark, name):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(np.array([r.embedding for r in table], float) * vectors.SCALE).astype(np.int64)
    n, deviation, values, columns, trace, centred = brute(x)
    got = queries.QUERIES[name](spark, SF).collect()
    assert sorted((r.vec_id, r.component) for r in got) == sorted((r.vec_id, c) for r in table for c in (1, 2, 3, 4))
    place = {r.vec_id: k for k, r in enumerate(table)}
    found = np.zeros((len(table), 4))
    for r in got:
        found[place[r.vec_id], r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, deviation[place[r.vec_id]])
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-10
        assert r.identity_error < 1e-8
    want = centred @ columns[:, :4] / np.sqrt(values[:4])
    assert np.allclose(found * np.sign((found * want).sum(axis=0)), want, atol=1e-8)
