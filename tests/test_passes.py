import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from tidemark.operators import passes, train
from tidemark.session import materialize

PARAMS = train.TrainParams(mlp_layers=(6, 4))
COLS = ["a", "b", "c"]


def rows(spark, n, batches):
    """``n`` rows a batch, in one file; the last batch has one class only."""
    df = spark.range(0, n * batches, 1, 1).select((F.col("id") % batches).cast("int").alias("batch_index"), F.randn(1).alias("a"), (3 * F.randn(2)).alias("b"), F.randn(3).alias("c"))
    label = F.when(F.col("batch_index") == batches - 1, 0.0).otherwise((F.col("a") + 0.3 * F.col("b") > 0.5).cast("double"))
    return materialize(df.withColumn("label", label), "passes-test")


def by_mllib(state, parts):
    mlp, out = None, []
    for x in parts:
        trainer = MultilayerPerceptronClassifier(layers=[3, 6, 4, 2], maxIter=1, seed=PARAMS.seed, labelCol="label", featuresCol="features")
        if mlp is not None:
            trainer.setInitialWeights(mlp.weights)
        mlp = trainer.fit(state._data(x))
        out.append(mlp)
    return out


@pytest.mark.parametrize("n", [1, 300, 700])  # 300 and 700 rows: the last block is a short one
def test_passes_are_those_of_mllib(spark, n):
    df = rows(spark, n, 5)
    parts = [df.filter(F.col("batch_index") == b) for b in range(5)]
    state = train.ModelState(COLS, PARAMS)
    want = by_mllib(state, parts)
    for got in (state.extended(parts, ("mlp",)), train.ModelState(COLS, PARAMS).extended(parts, ("mlp",), table=(df, "batch_index", range(5)))):
        for v, m in zip(got, want, strict=True):
            assert np.allclose(v.mlp.weights.toArray(), m.weights.toArray(), rtol=0, atol=1e-9)
    last = got[-1].predict_proba(df, "mlp").agg(F.sum("p1")).first()[0]
    state.mlp = want[-1]
    assert last == pytest.approx(state.predict_proba(df, "mlp").agg(F.sum("p1")).first()[0], abs=1e-6)
    assert got[-1].mlp.getLayers() == [3, 6, 4, 2] and got[-1].mlp.weights != got[-2].mlp.weights


def test_a_pass_is_one_job(spark):
    """MLlib's fit alone takes a job for the number of rows and one for each value of the line search."""
    df = rows(spark, 200, 40)
    state = train.ModelState(COLS, PARAMS).extended([df.filter("batch_index = 0")], ("mlp",))[-1]
    group, count = "passes-test", 39
    sc = spark.sparkContext
    sc.setJobGroup(group, "passes")
    try:
        state.extended([df.filter(F.col("batch_index") == b) for b in range(1, 40)], ("mlp",), table=(df, "batch_index", range(1, 40)))
        ids = sc.statusTracker().getJobIdsForGroup(group)
    finally:
        sc._jsc.clearJobGroup()
    assert count <= len(ids) <= count + 12, len(ids)  # and a few to read the batches


def test_a_pass_without_a_step_keeps_the_weights():
    flat = passes.Network([2, 3, 2], np.zeros((4, 2)), np.array([0.0, 1.0, 0.0, 1.0]))
    weights = np.zeros(3 * 3 + 4 * 2)
    assert passes.step(flat, weights) is weights  # the gradient is nought
    with pytest.raises(ValueError, match="features"):
        passes.Network([2, 3, 2], np.array([[0.0, np.nan]]), np.zeros(1))
    with pytest.raises(ValueError, match="labels"):
        passes.Network([2, 3, 2], np.zeros((1, 2)), np.array([2.0]))


def test_gradient_is_the_slope_of_the_loss():
    rnd = np.random.default_rng(3)
    net = passes.Network([3, 5, 4, 2], rnd.normal(size=(300, 3)), rnd.integers(0, 2, 300).astype(float))
    weights = rnd.normal(size=3 * 5 + 5 + 5 * 4 + 4 + 4 * 2 + 2)
    gradient = net.value(weights)[1]
    for i in range(len(weights)):
        e = np.zeros(len(weights))
        e[i] = 1e-6
        assert gradient[i] == pytest.approx((net.value(weights + e)[0] - net.value(weights - e)[0]) / 2e-6, abs=1e-6)
