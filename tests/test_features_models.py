import pytest
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import features, serve, train, validate
from tidemark.session import scratch_path


@pytest.fixture(scope="module")
def fit_and_data(cleaned_small):
    data = cleaned_small.data
    return data.filter(F.col(C.batch) == 0), data


def test_no_nulls_and_shapes(spark, fit_and_data):
    fit_df, data = fit_and_data
    o = features.fit(fit_df, features.FeatureParams("standard", "ordinal"), C)
    h = features.fit(fit_df, features.FeatureParams("minmax", "onehot"), C)
    xo, xh = o.transform(data), h.transform(data)
    assert len(o.output_columns()) == 9 and len(h.output_columns()) > len(o.output_columns())
    for x, cols in ((xo, o.output_columns()), (xh, h.output_columns())):
        assert x.select([F.sum(F.col(c).isNull().cast("int")) for c in cols]).first() == tuple([0] * len(cols))
    fit_x = h.transform(fit_df)
    mm = fit_x.agg(*[F.min(c) for c in h.numeric], *[F.max(c) for c in h.numeric]).first()
    assert all(0.0 <= v <= 1.0 for v in mm)


def test_unseen_category(spark, fit_and_data):
    fit_df, _ = fit_and_data
    o = features.fit(fit_df, features.FeatureParams("standard", "ordinal"), C)
    h = features.fit(fit_df, features.FeatureParams("standard", "onehot"), C)
    new = fit_df.limit(3).withColumn(C.txn_type, F.lit("never-seen"))
    assert {r[C.txn_type] for r in o.transform(new).collect()} == {-1.0}
    onehot = h.transform(new).select([c for c in h.output_columns() if c.startswith(C.txn_type + "_")])
    assert all(sum(r) == 0 for r in onehot.collect())


def test_save_load_round_trip(spark, fit_and_data):
    fit_df, data = fit_and_data
    o = features.fit(fit_df, features.FeatureParams(), C)
    path = scratch_path(spark, "test-features")
    o.save(spark, path)
    back = features.FittedFeatures.load(spark, path)
    assert back.to_json() == o.to_json()


def test_models_fit_predict_and_errors(spark, fit_and_data):
    fit_df, data = fit_and_data
    o = features.fit(fit_df, features.FeatureParams(), C)
    x0 = o.transform(fit_df)
    st = train.ModelState(o.output_columns(), train.TrainParams(rf_trees=10, rf_new_trees=5, rf_depth=4, mlp_layers=(8,)))
    with pytest.raises(train.NotFittedError):
        st.predict(x0, "rf")
    st.fit(x0)
    with pytest.raises(ValueError):
        st.predict(x0, "svm")
    assert st.predict(x0, "rf").count() == x0.count()
    assert st.predict(x0, "mlp").count() == x0.count()
    st.fit(o.transform(data.filter(F.col(C.row) >= 700)))  # sf0.001 holds one batch: use a later slice
    assert [n for _, n in st.forest] == [10, 5]
    p = st.predict_proba(x0, "rf").agg(F.min("p1"), F.max("p1")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0
    path = scratch_path(spark, "test-models")
    vdir = st.save(path)
    back = train.ModelState.load(path)
    assert back.batch_count == 2 and [n for _, n in back.forest] == [10, 5]
    a = st.predict_proba(x0, "rf").select("p1").collect()
    b = back.predict_proba(x0, "rf").select("p1").collect()
    assert a == b
    reg = scratch_path(spark, "test-registry")
    with pytest.raises(serve.NoModelError):
        serve.Serving.production(spark, reg)
    serve.register(spark, reg, "best", "rf", vdir, 0.5, "f1", 1)
    serve.promote(spark, reg)
    prod = serve.Serving.production(spark, reg)
    assert prod.predict(x0).count() == x0.count()
    log = scratch_path(spark, "test-log")
    e = serve.write_scored(prod.predict(x0), scratch_path(spark, "test-out"), log)
    assert e["n_rows"] == x0.count()
    s = serve.performance_summary(spark.read.parquet(log)).first()
    assert s["n_calls"] == 1


def test_class_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 9 + [(1.0,)], "label double")
    w = {r["label"]: r["weight"] for r in train.class_weights(df).collect()}
    assert w == {0.0: 10 / 18, 1.0: 5.0}


def test_large_vocabulary(spark):
    df = spark.range(50000).select(F.format_string("s%06d", "id").alias(C.state), F.lit(1.0).alias(C.amount))
    o = features.fit(df, features.FeatureParams(), C)
    got = o.transform(df, keep=[]).select(C.state).distinct().count()
    assert got == 50000
    assert o.transform(df.limit(1).withColumn(C.state, F.lit("none"))).first()[C.state] == -1.0


def test_one_model_of_all_trees_is_the_weighted_mean_of_its_members(spark, fit_and_data):
    from pyspark.ml.functions import vector_to_array

    fit_df, _ = fit_and_data
    o = features.fit(fit_df, features.FeatureParams(), C)
    x = o.transform(fit_df, keep=[C.row])
    st = train.ModelState(o.output_columns(), train.TrainParams(rf_trees=7, rf_new_trees=3, rf_depth=4, mlp_layers=(4,))).fit(x, ("rf",)).fit(x, ("rf",))
    data = train.assemble(x, o.output_columns())
    parts = [{r[0]: r[1] for r in m.transform(data).select(C.row, vector_to_array("probability")[1]).collect()} for m, _ in st.forest]
    whole = {r[0]: r[1] for r in st.predict_proba(x, "rf").select(C.row, "p1").collect()}
    assert all(abs(whole[k] - (0.7 * parts[0][k] + 0.3 * parts[1][k])) < 1e-9 for k in whole)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_best_model_ties_at_four_digits_go_to_the_later_batch(spark):
    rows = []
    for batch, hits in ((10, 40001), (11, 40000)):  # F1 0.80001 and 0.80000
        tp, miss = hits, 2 * (50000 - hits)
        rows += [(batch, "rf", 1, 0.9, 1, tp), (batch, "rf", 1, 0.1, 0, miss // 2), (batch, "rf", 0, 0.9, 1, miss - miss // 2), (batch, "rf", 0, 0.1, 0, 9)]
    df = spark.createDataFrame(rows, "batch_index int, model string, label int, p1 double, prediction int, n int")
    df = df.withColumn("i", F.explode(F.expr("sequence(1, n)")))
    best = validate.best_model(validate.evaluate(df, C), "f1", 0).first()
    assert (best["batch_index"], best["score"]) == (11, 0.8)


def test_median_of_integers_may_lie_between_two(spark):
    from tidemark.operators import clean, eda

    rows = [(i, float(i), 100.0 + i, a, a, i, 0) for i, a in enumerate((20, 21, None))]
    df = spark.createDataFrame(rows, "Transaction_ID long, Transaction_Amount double, Account_Balance double, Age int, Visits long, row_idx long, batch_index int")
    out = clean.fill_and_filter(df, clean.clean_params(df, df, C, 50.0), C)
    assert sorted(r.Age for r in out.collect()) == sorted(r.Visits for r in out.collect()) == [20.0, 20.5, 21.0]
    assert dict(out.dtypes)["Transaction_ID"] == "bigint"
    bins = eda.histogram(out, None, cols=C).filter("column_name = 'Age'").collect()
    assert len(bins) == 30 and sum(r["count"] for r in bins) == 3 and sum(r["count"] == 0 for r in bins) == 27


def test_sparse_vectors_equal_the_wide_form(spark, fit_and_data):
    from pyspark.ml.functions import vector_to_array

    fit_df, data = fit_and_data
    o = features.fit(fit_df, features.FeatureParams("minmax", "onehot"), C)
    data = data.withColumn(C.state, F.when(F.col(C.row) % 7 == 0, F.lit("nowhere")).otherwise(F.col(C.state)))
    wide = {r[0]: tuple(r[1:]) for r in o.transform(data, keep=[C.row]).select(C.row, *o.output_columns()).collect()}
    vectors = o.transform_sparse(data, keep=[C.row])
    got = {r[0]: tuple(r[1]) for r in vectors.select(C.row, vector_to_array("features")).collect()}
    assert got == wide and o.sparse_size() == len(o.output_columns()) and "label" in vectors.columns
    entries = o.sparse_entries(data, [C.row]).groupBy(C.row).agg(F.collect_list(F.struct("position", "feature", "value"))).collect()
    names = o.output_columns()
    for row, cells in entries:
        assert {(names[p], v) for p, f, v in cells if names[p] == f} == {(n, v) for n, v in zip(names, wide[row]) if v or n in o.numeric}


def test_a_hundred_thousand_categories_prepare_and_score(spark):
    n = 100_000
    df = spark.range(n).select(F.format_string("s%06d", "id").alias(C.state), (F.col("id") % 97).cast("double").alias(C.amount), (F.col("id") % 2).cast("int").alias(C.target))
    o = features.fit(df, features.FeatureParams("minmax", "onehot"), C)
    x = o.transform_sparse(df.filter("Transaction_Amount < 3").withColumn(C.state, F.when(F.col(C.amount) == 1, "new").otherwise(F.col(C.state))))
    first = x.filter(F.col("label") == 0).first().features
    assert o.sparse_size() == n + 1 and first.size == n + 1 and len(first.indices) <= 2
    st = train.ModelState(["x"], train.TrainParams(rf_trees=2, rf_depth=2, mlp_layers=(2,)), num_features=n + 1)
    x = x.withColumnRenamed("features", "x")
    st.fit(x.limit(200))
    assert all(st.predict_proba(x, m).filter("p1 is null").count() == 0 for m in ("rf", "mlp"))


def test_walked_forest_equals_mllib_for_all_and_for_the_first_trees(spark):
    """The merged forest's arrays give MLlib's doubles; ``upto`` gives those of an earlier version, so one job scores every version's holdout."""
    import random

    from pyspark.ml.functions import vector_to_array

    from tidemark.operators import train, validate
    from tidemark.plans import jobs
    from tidemark.session import scratch_path

    rnd = random.Random(3)
    num = lambda: rnd.choice([None, float("nan"), rnd.gauss(0, 1)]) if rnd.random() < 0.1 else rnd.gauss(0, 1)
    rows = [(i // 100, i, num(), num(), float(rnd.random() < 0.4)) for i in range(300)]
    df = spark.createDataFrame(rows, "batch_index int, row_idx long, a double, b double, label double").persist()
    fill = df.fillna(0.0)  # the network takes no missing values
    params = train.TrainParams(rf_trees=6, rf_new_trees=3, rf_depth=4, mlp_layers=(3,))
    versions = train.ModelState(["a", "b"], params).extended([fill.filter(F.col("batch_index") == b) for b in range(3)])
    order = train.ModelState(["a", "b"], params)
    for b, v in enumerate(versions):
        order.fit(fill.filter(F.col("batch_index") == b))
        assert v.mlp.weights == order.mlp.weights and v.batch_count == b + 1 and len(v.forest) == b + 1
        merged = train.merged_forest([m for m, _ in order.forest])
        want = merged.transform(train.assemble(df, ["a", "b"])).select("row_idx", vector_to_array("probability")[1])
        got = versions[-1].predict_proba(df, "rf", upto=F.lit(6 + 3 * b)).select("row_idx", "p1")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    one, every = scratch_path(spark, "one"), scratch_path(spark, "every")
    for b, v in enumerate(versions):
        hold = validate.holdout(fill.filter(F.col("batch_index") == b)).filter("is_holdout")
        jobs.score_holdout(v, hold, one, b, C)
    for _ in range(2):  # a rerun replaces
        jobs.score_holdouts(versions, [0, 1, 2], fill, every, validate.DEFAULT_VAL_SIZE, C)
    x = spark.read.parquet(one)
    y = spark.read.parquet(every).select(*x.columns)
    assert x.schema == y.schema and x.count() == y.count() == 120 and x.exceptAll(y).isEmpty()


def test_trees_are_not_wrapped_in_python_unless_asked_for(spark, tmp_path):
    """A fit, a merge and a load of a forest leave its trees in the JVM (F1: 100 wrappers a fit held the interpreter for a second)."""
    df = spark.createDataFrame([(i % 7 / 7.0, float(i % 2)) for i in range(60)], "x double, label double")
    params = train.TrainParams(rf_trees=4, rf_new_trees=2, rf_depth=2, mlp_layers=(2,))
    state = train.ModelState(["x"], params).fit(df, ("rf",)).fit(df, ("rf",))
    state.save(str(tmp_path))
    back = train.ModelState.load(str(tmp_path))
    members = [m for m, _ in state.forest + back.forest]
    merged = train.merged_forest(members[:2])
    for m, n in zip([*members, merged], (4, 2, 4, 2, 6), strict=True):
        assert "trees" not in vars(m) and len(m.trees) == n
    p = [sorted(map(tuple, s.predict_proba(df).select("x", "p1").collect())) for s in (state, back)]
    assert p[0] == p[1]
