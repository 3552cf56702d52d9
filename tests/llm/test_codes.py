import __spark_entry__ as entry
import numpy as np
import pytest
from compare import differences, duck
from tellerlake.llm import codes, queries, vectors
from tellerlake.llm.covertree import Forest

SF = "/root/testdata/sf0.001"


def brute(x, parts, entries, rounds):
    """(codes, errors, books) of integer rows already in the order of their ids."""
    points = x.reshape(len(x), parts, -1).transpose(1, 0, 2)
    books = points[:, :entries].copy()

    def nearest():
        return np.array([((p[:, None] - b[None]) ** 2).sum(-1).argmin(1) for p, b in zip(points, books)])

    for _ in range(rounds):
        found = nearest()
        for part in range(parts):
            for entry_ in range(books.shape[1]):
                mine = points[part][found[part] == entry_]
                if len(mine):
                    books[part, entry_] = mine.sum(axis=0) // len(mine)
    found = nearest()
    error = sum(((points[p] - books[p][found[p]]) ** 2).sum(-1) for p in range(parts))
    return found.T, error, books


@pytest.mark.parametrize("rows, parts, width, spread", [(1, 2, 3, 5), (60, 2, 1, 3), (500, 3, 2, 10), (900, 2, 4, 1), (700, 2, 40, 9)])
def test_trees_find_what_a_full_comparison_finds(rows, parts, width, spread):
    rng = np.random.default_rng(rows)
    x = np.floor(rng.standard_normal((rows, parts * width)) * spread).astype(np.int64)
    x[: rows // 3] = x[0]
    points = codes.parts_of(x, parts)
    forest = codes.restored(codes.stored(Forest.build(points, parts)), parts)
    assert sorted(forest.order.tolist()) == list(range(rows * parts))
    books = x[rng.permutation(rows)[:40]].reshape(-1, parts, width).transpose(1, 0, 2).copy()
    code, sums = forest.assign(points[forest.order], books), forest.sums(points[forest.order], books)
    for part, own in enumerate(points.reshape(parts, rows, width)):
        want = ((own[:, None] - books[part][None]) ** 2).sum(-1).argmin(1)
        assert (code[part] == want).all()
        for entry_ in range(books.shape[1]):
            mine = own[want == entry_]
            assert sums[part, entry_].tolist() == [len(mine), *mine.sum(axis=0).tolist()]


def test_nodes_are_cover_trees():
    x = np.floor(np.random.default_rng(3).standard_normal((600, 3)) * 40).astype(np.int64)
    forest = Forest.build(x, 1)
    ordered = x[forest.order]
    settled = forest.nearest(ordered, ordered[None, :8].copy())
    assert len(settled[0][0]) and sum(forest.size[settled[0][0]]) + len(settled[1][0]) == 600
    for node in range(len(forest.start)):
        own = ordered[forest.start[node] : forest.start[node] + forest.size[node]]
        far = np.sqrt(((own - ordered[forest.centre[node]]) ** 2).sum(1))
        assert far.max() <= forest.radius[node]
        first, n = forest.first_child[node], forest.children[node]
        if n:
            centres = ordered[forest.centre[first : first + n]]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(-1))[~np.eye(n, dtype=bool)]
            assert forest.size[first : first + n].sum() == forest.size[node]
            assert apart.min() > forest.radius[node] / 2 * (1 - 1e-9)


def frame(spark, rows, columns="id long, v array<double>, label string, code string, x int"):
    return spark.createDataFrame(rows, columns)


def test_edges(spark):
    rng = np.random.default_rng(5)
    drawn = rng.integers(-400, 400, (90, 4)) / 256
    rows = [(k // 2, v.tolist(), None if k % 3 else "a", "c", 1) for k, v in enumerate(drawn)]
    rows += rows[:30] + [(None, [0.0, -0.0, 0.1, 1.0], "b", "c", 1)]
    bad = [(0, None, "a", "", 0), (-1, [], "a", "", 0), (-2, [1.0, None, 0.0, 0.0], "a", "", 0), (-3, [float("nan")] * 4, "a", "", 0)]
    bad += [(-4, [1.0, float("-inf"), 0.0, 0.0], "a", "", 0), (-5, [1.0, 2.0], "a", "", 0)]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, np.floor(np.array(r[1]) * 256).tolist()))
    x = np.floor(np.array([r[1] for r in ordered]) * 256).astype(np.int64)
    want_codes, want_errors, want_books = brute(x, 2, 10, 2)
    got, books = codes.compress(frame(spark, rows + bad), "id", "v", ["label"], parts=2, entries=10)
    assert got.columns == ["id", "label", "code", "error"]
    assert (books == want_books).all()
    want = [(r[0], r[2], c.tolist(), int(e)) for r, c, e in zip(ordered, want_codes, want_errors)]
    assert sorted(map(str, want)) == sorted(str((r.id, r.label, r.code, r.error)) for r in got.collect())
    few, books = codes.compress(frame(spark, rows[:3]), "id", "v", parts=2, entries=10)
    assert (few.count(), books.shape) == (3, (2, 3, 2))
    assert all(r.error == 0 for r in few.collect())
    none, books = codes.compress(frame(spark, bad[:1]), "id", "v", parts=2)
    assert (none.count(), books.size) == (0, 0)
    with pytest.raises(ValueError, match="cannot be cut"):
        codes.compress(frame(spark, rows), "id", "v", parts=3)


def test_blocks_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/embeddings.parquet").limit(200)
    whole = sorted((r.vec_id, r.code, r.error) for r in codes.compress(docs)[0].collect())
    small = list(vectors.in_blocks(iter(docs.select("vec_id").toArrow().to_batches()), vectors.BLOCK_CELLS // 7))
    assert [len(t) for t in small] == [7] * 28 + [4]
    parted = docs.repartition(5, "vec_id")
    assert whole == sorted((r.vec_id, r.code, r.error) for r in codes.compress(parted)[0].collect())


def test_query_equals_sql_over_the_whole_table(spark):
    found = differences(queries.QUERIES["op11_codes"](spark, SF), duck(SF), entry.oracle_sql()["op11_codes"])
    assert not found, found
