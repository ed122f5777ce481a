import numpy as np
from conftest import SF_MED

from tidemark.llm import hilbert as H
from tidemark.llm import queries


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, rank int")


def brute(rows, query_ids, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, np.array([np.float32(x) for x in v], float))
    out = []
    for q in query_ids:
        if q in good:
            near = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return out


def test_keys_walk_through_neighbouring_cells():
    for dim, bits in ((1, 5), (2, 4), (3, 3), (5, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij")
        cells = np.stack(axes, -1).reshape(-1, dim)
        keys = H.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_window_over_all_rows_is_exact_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(500)]
    rows += [(600 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0]) for i in range(60)]  # one vector many times
    rows += [(700, None), (800, []), (900, [0.0] * 6), (1000, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1100, [float("nan")] * 6), (1200, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (1300, [1.0] * 6), (1300, [1.0] * 6), (1400, [-0.0, 1.0, 2.0, 3.0, 1.0, 1.0]), (1500, [0.0, 1.0, 2.0, 3.0, 1.0, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in H.neighbours_of_every(frame(spark, rows), 50, 10, 10**6).collect())
    want = sorted(brute(rows, range(0, 2000, 50), 10))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(g[3] == w[3] for g, w in zip(got, want))


def test_each_length_is_searched_among_its_own(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-5, 6, 3 if i % 3 == 0 else 4).astype(float).tolist()) for i in range(301)]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in H.neighbours_of_every(frame(spark, rows), 100, 10, 10**6).collect())
    want = sorted(brute([r for r in rows if len(r[1]) == 3], (0, 300), 10) + brute([r for r in rows if len(r[1]) == 4], (100, 200), 10))
    assert got == want and len(got) == 40


def test_fewer_rows_than_asked_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (101, [1.0, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in H.neighbours_of_every(frame(spark, rows)).collect())
    assert got == [(0, 1, 101), (0, 2, 100), (100, 1, 101), (100, 2, 0)]
    assert H.neighbours_of_every(frame(spark, [])).count() == 0
    assert H.neighbours_of_every(frame(spark, [(0, [1.0, 2.0])])).count() == 0


def test_fitted_recall_on_the_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_MED}/embeddings.parquet").collect()]
    got = {(r.query_id, r.vec_id) for r in queries.op6_hilbert_neighbours(spark, SF_MED).collect()}
    want = {(q, i) for q, _, i, _ in brute(rows, [i for i, _ in rows if i % 100 == 0], 10)}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)
