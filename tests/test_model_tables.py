import math
import random
import time

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import model_tables as mt
from tidemark.operators import serve, train
from tidemark.session import scratch_path

COLS = ["a", "b", "c"]


def table(spark, n=300, seed=1):
    rnd = random.Random(seed)
    rows = [(i, *(rnd.choice([None, rnd.gauss(0, 1)]) if rnd.random() < 0.2 else rnd.gauss(0, 1) for _ in COLS)) for i in range(n)]
    rows.append((n, math.nan, math.inf, -math.inf))
    return rows, spark.createDataFrame(rows, "id int, a double, b double, c double")


def random_forest(seed, trees, depth):
    rnd = random.Random(seed)
    nodes = []
    for t in range(trees):
        todo, count = [(0, 0)], 1
        while todo:
            node, level = todo.pop()
            if level < depth and rnd.random() < 0.8:
                nodes.append((t, node, rnd.randrange(3), rnd.gauss(0, 1), count, count + 1, [1.0, 1.0]))
                todo += [(count, level + 1), (count + 1, level + 1)]
                count += 2
            else:
                nodes.append((t, node, -1, None, -1, -1, [float(rnd.randrange(0, 9)), float(rnd.randrange(1, 9))]))
    return nodes


def brute_forest(nodes, x):
    at = {(n[0], n[1]): n for n in nodes}
    trees, out = sorted({n[0] for n in nodes}), 0.0
    for t in trees:
        n = at[t, 0]
        while n[4] >= 0:
            v = x[n[2]]
            n = at[t, n[4] if v is not None and v <= n[3] else n[5]]
        out += n[6][1] / sum(n[6])
    return out / len(trees)


def test_forest_table_equals_a_walk(spark, monkeypatch):
    rows, df = table(spark)
    for seed, trees, depth in ((1, 5, 6), (2, 1, 0), (3, 3, 1)):
        nodes = random_forest(seed, trees, depth)
        forest = spark.createDataFrame(nodes, mt.NODES)
        want = {r[0]: brute_forest(nodes, r[1:]) for r in rows}
        got = mt.TableModels(COLS, forest).predict_proba(df)
        assert "ArrowEval" not in got._jdf.queryExecution().toString() and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert {r.id: r.p1 for r in got.collect()} == pytest.approx(want)
        with monkeypatch.context() as m:
            m.setattr(mt, "MOST_NODES", 0)
            assert {r.id: r.p1 for r in mt.TableModels(COLS, forest).predict_proba(df).collect()} == pytest.approx(want)


def test_broken_forest_tables_are_refused(spark):
    _, df = table(spark, 3)
    for nodes in ([(0, 0, 0, 1.0, 1, 2, [1.0, 1.0])], [(0, 0, 0, 1.0, 1, 1, [1.0, 1.0]), (0, 1, 0, 1.0, 0, 0, [1.0, 1.0])]):
        with pytest.raises(ValueError):
            mt.forest_probabilities(df, spark.createDataFrame(nodes, mt.NODES), COLS)
    with pytest.raises(train.NotFittedError):
        mt.TableModels(COLS).predict(df)
    with pytest.raises(ValueError):
        mt.TableModels(COLS).predict(df, "svm")


def test_tables_and_mllib_agree_both_ways(spark):
    rows, _ = table(spark, 400, 5)
    rows = [(r[0], *(0.0 if v is None else v for v in r[1:]), float((r[1] or 0) + (r[2] or 0) > 0.3)) for r in rows[:-1]]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label double")
    state = train.ModelState(COLS, train.TrainParams(rf_trees=7, rf_new_trees=3, rf_depth=5, mlp_layers=(6, 4)))
    state.fit(df.filter("id % 2 = 0")).fit(df.filter("id % 2 = 1"))
    tables = mt.TableModels.from_mllib(state)
    assert tables.forest.select("tree").distinct().count() == 10
    path = tables.save(scratch_path(spark, "tables"))
    back = mt.TableModels.load(spark, path)
    data = train.assemble(df, COLS)
    for name, again in (("rf", mt.forest_to_mllib(back.forest, 3)), ("mlp", mt.mlp_to_mllib(back.mlp))):
        want = {r.id: (r.p1, r.prediction) for r in state.predict_proba(df, name).collect()}
        got = {r.id: (r.p1, r.prediction) for r in back.predict_proba(df, name).collect()}
        assert {k: v[0] for k, v in got.items()} == pytest.approx({k: v[0] for k, v in want.items()}, abs=1e-9)
        assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
        imported = again.transform(data).select("id", vector_to_array("probability")[1].alias("p1"))
        assert {r.id: r.p1 for r in imported.collect()} == pytest.approx({k: v[0] for k, v in want.items()}, abs=1e-9)
    reg = scratch_path(spark, "reg")
    serve.register(spark, reg, "best", "rf", path, 0.5, "f1", 1)
    serve.promote(spark, reg)
    served = serve.Serving.production(spark, reg).predict(df)
    assert {r.id: r.predict for r in served.collect()} == {r.id: r.prediction for r in state.predict(df, "rf").collect()}


def test_mlp_table_by_hand(spark):
    w = [(0, 0, -1, 0.5), (0, 0, 0, 1.0), (0, 0, 2, -2.0), (0, 1, 1, 3.0), (1, 0, 0, 1.5), (1, 1, 1, -1.0), (1, 1, -1, 0.25)]
    df = spark.createDataFrame([(1, 0.2, -0.4, None), (2, 1.0, 2.0, 3.0)], "id int, a double, b double, c double")
    got = {r.id: r.p1 for r in mt.TableModels(COLS, None, spark.createDataFrame(w, mt.WEIGHTS)).predict_proba(df, "mlp").collect()}
    s = lambda v: 1 / (1 + math.exp(-v))
    for i, (a, b, c) in {1: (0.2, -0.4, 0.0), 2: (1.0, 2.0, 3.0)}.items():
        h0, h1 = s(0.5 + a - 2 * c), s(3 * b)
        z0, z1 = math.exp(1.5 * h0), math.exp(-h1 + 0.25)
        assert got[i] == pytest.approx(z1 / (z0 + z1))
    assert df.filter(F.lit(True)).count() == 2


def test_mlp_table_of_many_layers(spark):
    """Each unit is worked out once a row: worked out again at every use, eight layers of six units take 6^8 steps."""
    rnd = random.Random(5)
    w = [(layer, j, i, rnd.gauss(0, 1)) for layer in range(8) for j in range(6) for i in range(-1, 3 if layer == 0 else 6)]
    rows, df = table(spark, 40, 3)
    start = time.time()
    got = {r.id: r.probability for r in mt.mlp_probabilities(df, spark.createDataFrame(w, mt.WEIGHTS), COLS).collect()}
    assert time.time() - start < 60
    for i, *x in rows[:-1]:
        x = [v or 0.0 for v in x]
        for layer in range(8):
            at = {(j, k): v for n, j, k, v in w if n == layer}
            net = [at[j, -1] + sum(at[j, k] * v for k, v in enumerate(x)) for j in range(6)]
            x = net if layer == 7 else [1 / (1 + math.exp(-v)) for v in net]
        e = [math.exp(v - max(x)) for v in x]
        assert got[i] == pytest.approx([v / sum(e) for v in e])
