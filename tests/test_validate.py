import random

from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import validate


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = 0.0
    for p in pos:
        for q in neg:
            tot += 1.0 if p > q else 0.5 if p == q else 0.0
    return tot / (len(pos) * len(neg))


def test_auc_matches_pairwise(spark):
    rnd = random.Random(1)
    pairs = [(round(rnd.random(), 1), int(rnd.random() < 0.3)) for _ in range(200)]
    df = spark.createDataFrame([(0, "m", y, s) for s, y in pairs], "batch_index int, model string, label int, p1 double")
    got = validate.roc_auc(df, [C.batch, "model"]).first()["roc_auc"]
    assert abs(got - brute_auc(pairs)) < 1e-12


def test_auc_one_class_is_null_and_f1_zero(spark):
    df = spark.createDataFrame([(0, "m", 0, 0.2, 0), (0, "m", 0, 0.7, 1)], "batch_index int, model string, label int, p1 double, prediction int")
    assert validate.roc_auc(df, [C.batch, "model"]).first()["roc_auc"] is None
    m = validate.binary_metrics(df, [C.batch, "model"]).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)
    assert validate.evaluate(df, C).count() == 0  # undefined AUC: no metrics row


def test_holdout_and_folds(spark):
    df = spark.range(23).select(F.lit(0).alias(C.batch), F.col("id").alias(C.row))
    h = validate.holdout(df, 0.2, C).filter("is_holdout").select(C.row).collect()
    assert sorted(r[0] for r in h) == list(range(18, 23))  # int(23 * 0.8) = 18
    f = {r[C.row]: r["test_fold"] for r in validate.cv_folds(df, 3, C).collect()}
    # expanding window: test size 23 // 4 = 5, test blocks start at 8, 13, 18
    assert [f[i] for i in range(23)] == [None] * 8 + [0] * 5 + [1] * 5 + [2] * 5
    mem = validate.fold_membership(validate.cv_folds(df, 3, C), 3, C)
    tr = mem.filter((F.col("fold") == 1) & (F.col("role") == "train")).count()
    assert tr == 13


def test_best_model_ties_go_later(spark):
    m = spark.createDataFrame(
        [(9, "rf", 0.9), (10, "rf", 0.5), (10, "mlp", 0.5), (11, "rf", 0.4), (12, "mlp", None)],
        "batch_index int, model string, f1 double",
    )
    b = validate.best_model(m, "f1", 10, cols=C).first()
    assert (b["model_name"], b[C.batch], b["score"]) == ("mlp", 10, 0.5)
    assert validate.best_model(m, "f1", 20, cols=C).count() == 0
