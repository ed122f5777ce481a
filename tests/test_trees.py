import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import train, trees, validate
from tidemark.plans import jobs
from tidemark.session import materialize, scratch_path

COLS = ["a", "b", "c", "d"]


def table(spark, n, batches, seed=1):
    """Numbers with noughts, with few values and a constant one; batch 1 has one class only."""
    rnd, size = np.random.default_rng(seed), n * batches
    a = np.where(rnd.random(size) < 0.1, 0.0, rnd.normal(size=size))
    cells = zip(np.arange(size) // n, range(size), a, rnd.integers(0, 5, size) * 1.0, rnd.normal(size=size), np.full(size, 2.0), strict=True)
    rows = [(int(b), int(i), *map(float, x), float(b != 1 and x[0] + 0.2 * x[1] > 0.6)) for b, i, *x in cells]
    return materialize(spark.createDataFrame(rows, "batch_index int, row_idx long, a double, b double, c double, d double, label double").coalesce(1), "trees-test")


def listed(a, t):
    """A tree in preorder: splits and the shares of class 1 in the leaves."""
    out, todo = [], [int(a.root[t])]
    while todo:
        i = todo.pop()
        left, right = int(a.child[2 * i]), int(a.child[2 * i + 1])
        out.append((float(a.share[1][i]),) if left == i else (int(a.feature[i]), float(a.threshold[i])))
        todo += [] if left == i else [right, left]
    return out


@pytest.mark.parametrize(("n", "params"), [(25, (5, 3, 4)), (300, (9, 1, 10)), (300, (1, 6, 5))])
def test_grown_trees_are_those_of_mllib(spark, n, params):
    df = table(spark, n, 3)
    parts = [df.filter(F.col(C.batch) == b) for b in range(3)]
    make = lambda: train.ModelState(COLS, train.TrainParams(*params, mlp_layers=(3,)))
    want = make()
    for p in parts:
        want.fit(p, ("rf",))
    for got in (make().extended(parts, ("rf",)), make().extended(parts, ("rf",), table=(df, C.batch, [0, 1, 2], C.row))):
        for (m, k), (w, _) in zip(got[-1].forest, want.forest, strict=True):
            x, y = train.stored_arrays([m]), train.TreeArrays.of(w)
            assert m.getNumTrees == k == len(y.root) and [listed(x, t) for t in range(k)] == [listed(y, t) for t in range(k)]
    assert len(m.trees) == k and m.numClasses == 2  # MLlib's form of it
    p = [sorted(map(tuple, s.predict_proba(df).select(C.row, "p1").collect())) for s in (got[-1], want)]
    assert p[0] == p[1]


def test_members_of_many_batches_take_a_few_jobs(spark, tmp_path):
    """MLlib takes about two jobs for each level of each member's trees, and a job for each batch's holdout."""
    df = table(spark, 40, 12)
    names = list(range(12))
    state, sc = train.ModelState(COLS, train.TrainParams(4, 2, 3, mlp_layers=(3,))), spark.sparkContext
    state = state.extended([df.filter("batch_index = 0")])[-1]
    parts = [df.filter(F.col(C.batch) == b) for b in names[1:]]
    sc.setJobGroup("trees-test", "members")
    try:
        versions = state.extended(parts, table=(df, C.batch, names[1:], C.row), chained=True, root=str(tmp_path))
        jobs.score_holdouts(versions, names[1:], df, scratch_path(spark, "held"), 0.2, C)
        ids = sc.statusTracker().getJobIdsForGroup("trees-test")
    finally:
        sc._jsc.clearJobGroup()
    assert len(ids) < 40, len(ids)
    train.save_versions(versions, str(tmp_path))
    for back in (train.ModelState.load(str(tmp_path)), train.ModelState.load(str(tmp_path), 7)):
        v = versions[back.batch_count - 2]
        for m in ("rf", "mlp"):
            a, b = (sorted(map(tuple, s.predict_proba(df, m).select(C.row, "p1").collect())) for s in (back, v))
            assert a == b


def test_versions_of_a_wave_are_appended_without_reading_the_log_for_each(spark, tmp_path, monkeypatch):
    """each commit listed every entry, so the commits of a job grew with the square of its batches."""
    from tidemark.sources.commits import CommitLog

    looks, real = [], CommitLog.numbers
    monkeypatch.setattr(CommitLog, "numbers", lambda self: looks.append(1) or real(self))
    versions = [train.ModelState(COLS, batch_count=i) for i in range(1, 7)]
    train.save_versions(versions, str(tmp_path))
    assert len(looks) == 1
    others, put = [train.ModelState(COLS, batch_count=99)], train.ModelState._append

    def meanwhile(self, path, *rest):  # another writer's entry isn't lost
        if self.batch_count == 9 and others:
            put(others.pop(), path, "other")
        return put(self, path, *rest)

    monkeypatch.setattr(train.ModelState, "_append", meanwhile)
    train.save_versions([train.ModelState(COLS, batch_count=i) for i in (8, 9, 10)], str(tmp_path))
    log = CommitLog(spark, f"{tmp_path}/_versions")
    assert [log.read(n)["version"] for n in sorted(log.numbers())] == [1, 2, 3, 4, 5, 6, 8, 99, 9, 10]


def test_passes_in_one_job_are_those_of_many(spark):
    df = table(spark, 150, 5)
    parts = [df.filter(F.col(C.batch) == b) for b in range(5)]
    params = train.TrainParams(mlp_layers=(6, 4))
    one, many = (train.ModelState(COLS, params).extended(parts, ("mlp",), table=(df, C.batch, range(5), C.row), chained=c) for c in (True, False))
    for v, w in zip(one, many, strict=True):
        assert np.array_equal(train.weights_of(v.mlp), train.weights_of(w.mlp)) and v.mlp.weights == w.mlp.weights
    group, sc = "passes-chained", spark.sparkContext
    sc.setJobGroup(group, "passes")
    try:
        one[0].extended(parts[1:], ("mlp",), table=(df, C.batch, range(1, 5), C.row), chained=True)
        before = len(sc.statusTracker().getJobIdsForGroup(group))
        one[0].extended(parts[1:] * 5, ("mlp",), table=(df, C.batch, list(range(1, 5)) * 5, C.row))
        assert before < 4 * 5  # a job for each pass
    finally:
        sc._jsc.clearJobGroup()


def test_a_fold_in_one_task_is_a_fit_of_fresh_models(spark):
    """fits, passes and scores of a fold without a job of their own."""
    df = table(spark, 80, 2)
    folds = validate.fold_membership(validate.cv_folds(df, 3, C), 3, C).withColumn("part", F.col(C.batch) * 3 + F.col("fold"))
    folds = materialize(folds, "folds-test")
    params = train.TrainParams(5, 2, 4, mlp_layers=(6, 4))
    taken = spark.sparkContext.broadcast(trees.draws(params.seed, 80, 5))
    got = train.fresh_scores(folds, "part", range(6), C.row, COLS, params, taken).collect()
    assert len(got) == 2 * folds.filter("role = 'test'").count()
    for k in range(6):
        part = folds.filter(F.col("part") == k)
        state = train.ModelState(COLS, params).fit(part.filter("role = 'train'"))
        for m in ("rf", "mlp"):
            want = state.predict_proba(part.filter("role = 'test'"), m).orderBy(C.row).select("label", "p1", "prediction").collect()
            mine = [(r.label, r.p1, r.prediction) for r in got if (r.part, r.model) == (k, m)]
            assert [(x[0], x[2]) for x in mine] == [(w[0], w[2]) for w in want]
            assert [x[1] for x in mine] == pytest.approx([w[1] for w in want], abs=0 if m == "rf" else 1e-9)


def test_what_mllib_refuses_is_refused(spark):
    x, y, w = np.zeros((4, 2)), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4)
    for rows, label in ((x[:0], y[:0]), (x + np.nan, y), (x, y + 1)):
        with pytest.raises(ValueError):
            trees.grow(rows, label, w[:len(rows)], np.ones((len(rows), 2), np.uint8), 1, 3)
    df = table(spark, 20, 2)
    with pytest.raises(ValueError, match="without rows"):
        train.ModelState(COLS, train.TrainParams(2, 2, 2)).extended([df, df], ("rf",), table=(df, C.batch, [0, 9]))
