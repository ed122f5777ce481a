"""V1-V7: time-ordered holdout, confusion metrics, ROC-AUC, expanding-window
folds and best-model selection, for every batch and model at once.

Per-batch windows are partitioned by ``batch_index`` (groups of at most
``batch_size`` rows). AUC is a tie-aware rank sum over distinct scores: the
numerator is an integer, so the result is one exact division.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns

# Validation defaults.
DEFAULT_VAL_SIZE = 0.2
DEFAULT_SPLITS = 3
DEFAULT_MIN_BATCHES = 10
MODEL_ORDER = ("rf", "mlp")
SCORE_DIGITS = 4


def with_batch_position(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """``__pos`` (0-based, row order) and ``__n`` (batch rows) per row."""
    w = Window.partitionBy(cols.batch).orderBy(cols.row)
    return df.withColumn("__pos", F.row_number().over(w) - 1).withColumn(
        "__n", F.count(F.lit(1)).over(Window.partitionBy(cols.batch))
    )


def holdout(df: DataFrame, val_size: float = DEFAULT_VAL_SIZE, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """V1: adds ``is_holdout``: the rows from ``int(n * (1 - val_size))`` on."""
    pos = with_batch_position(df, cols)
    split = F.floor(F.col("__n").cast("double") * (F.lit(1.0) - F.lit(float(val_size))))
    return pos.withColumn("is_holdout", F.col("__pos") >= split).drop("__pos", "__n")


def cv_folds(df: DataFrame, n_splits: int = DEFAULT_SPLITS, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """V5: ``test_fold`` (0-based, NULL outside every test block) for an
    expanding-window split: test size ``n div (n_splits + 1)``, fold i trains
    on every row before its test block."""
    pos = with_batch_position(df, cols)
    size = F.floor(F.col("__n") / F.lit(n_splits + 1)).cast("long")
    first = F.col("__n") - F.lit(n_splits) * size
    fold = F.when((size > 0) & (F.col("__pos") >= first), F.floor((F.col("__pos") - first) / size).cast("int"))
    return (
        pos.withColumn("test_fold", fold)
        .withColumn("fold_test_start", first)
        .withColumn("fold_size", size)
        .drop("__pos", "__n")
    )


def fold_membership(folds: DataFrame, n_splits: int = DEFAULT_SPLITS, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """(row..., fold, role) with role 'train' or 'test' for each of the folds
    (a row is in the training part of every later fold)."""
    pos = with_batch_position(folds, cols)
    rows = []
    for i in range(n_splits):
        start = F.col("fold_test_start") + F.lit(i) * F.col("fold_size")
        role = F.when(F.col("__pos") < start, F.lit("train")).when(
            F.col("__pos") < start + F.col("fold_size"), F.lit("test")
        )
        rows.append(F.struct(F.lit(i).alias("fold"), role.alias("role")))
    out = pos.withColumn("__f", F.explode(F.array(*rows))).select("*", "__f.fold", "__f.role")
    return out.filter(F.col("role").isNotNull() & (F.col("fold_size") > 0)).drop("__f", "__pos", "__n")


def binary_metrics(scored: DataFrame, keys: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """V2: precision, recall, F1 of class 1 per key group; 0 when undefined."""
    y, p = F.col(label), F.col(prediction)
    agg = scored.groupBy(*keys).agg(
        F.count_if((p == 1) & (y == 1)).cast("long").alias("tp"),
        F.count_if((p == 1) & (y != 1)).cast("long").alias("fp"),
        F.count_if((p != 1) & (y == 1)).cast("long").alias("fn"),
        F.count(F.lit(1)).cast("long").alias("n"),
    )
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    out = agg.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(
        (F.col("precision") + F.col("recall")) > 0,
        F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
    ).otherwise(F.lit(0.0))
    return out.withColumn("f1", f1)


def roc_auc(scored: DataFrame, keys: Sequence[str], label: str = "label", score: str = "p1") -> DataFrame:
    """V3: tie-aware ROC-AUC per key group; NULL when one class is absent.

    Scores are first counted per distinct value (map-side combine), then a
    running count of negatives below each score is taken per group.
    """
    y = F.col(label)
    per_score = scored.groupBy(*keys, score).agg(
        F.count_if(y == 1).cast("long").alias("__pos"), F.count_if(y != 1).cast("long").alias("__neg")
    )
    w = Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranked = per_score.withColumn("__below", F.coalesce(F.sum("__neg").over(w), F.lit(0)))
    agg = ranked.groupBy(*keys).agg(
        F.sum(F.col("__pos") * (F.lit(2) * F.col("__below") + F.col("__neg"))).cast("long").alias("__num"),
        F.sum("__pos").cast("long").alias("n_pos"),
        F.sum("__neg").cast("long").alias("n_neg"),
    )
    den = F.lit(2) * F.col("n_pos") * F.col("n_neg")
    return agg.select(
        *keys, "n_pos", "n_neg",
        F.when(den > 0, F.col("__num").cast("double") / den.cast("double")).alias("roc_auc"),
    )


def evaluate(scored: DataFrame, cols: Columns = DEFAULT_COLUMNS, model_col: str = "model") -> DataFrame:
    """V4: metrics per (batch, model) on holdout rows, rounded to 4 digits before
    any comparison; a model whose AUC is undefined (one class in the holdout)
    gets no row."""
    keys = [cols.batch, model_col]
    m = binary_metrics(scored, keys)
    a = roc_auc(scored, keys)
    j = m.join(a, keys)
    scores = [F.round(c, SCORE_DIGITS).alias(c) for c in ("f1", "roc_auc", "precision", "recall")]
    return j.filter(F.col("roc_auc").isNotNull()).select(*keys, *scores, "tp", "fp", "fn", "n")


def best_model(
    metrics: DataFrame,
    metric: str = "f1",
    min_batches: int = DEFAULT_MIN_BATCHES,
    model_order: Sequence[str] = MODEL_ORDER,
    cols: Columns = DEFAULT_COLUMNS,
    model_col: str = "model",
) -> DataFrame:
    """V6: the best (batch, model) among batches >= min_batches: highest score;
    ties go to the later batch, then the later model (a walk over batches and
    models in order that replaces the best on ``>=``)."""
    order = F.create_map(*[x for i, name in enumerate(model_order) for x in (F.lit(name), F.lit(i))])
    eligible = metrics.filter((F.col(cols.batch) >= min_batches) & F.col(metric).isNotNull())
    rank = F.coalesce(F.element_at(order, F.col(model_col)), F.lit(len(model_order)))
    key = F.struct(F.col(metric).alias("s"), F.col(cols.batch).alias("b"), rank.alias("r"))
    best = eligible.agg(F.max_by(F.struct(F.col(model_col).alias("m"), F.col(cols.batch).alias("b"), F.col(metric).alias("s")), key).alias("best"))
    return best.filter(F.col("best").isNotNull()).select(
        F.col("best.m").alias("model_name"), F.col("best.b").alias(cols.batch),
        F.col("best.s").alias("score"), F.lit(metric).alias("metric"),
    )
