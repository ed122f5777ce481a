"""Drift features per batch, the reference snapshot and the deltas.

Features are a long table ``(batch_index, feature, value)``. The reference is
one batch's features; whether it is broadcast is left to the optimizer, which
knows its measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns, categorical_columns, numeric_columns
from tidemark.operators.eda import _without_dropped, category_value_counts

# Fixed value: relative change above which a feature counts as drifted.
DEFAULT_THRESHOLD = 0.2


def drift_features(
    df: DataFrame,
    dropped: DataFrame | None = None,
    cols: Columns = DEFAULT_COLUMNS,
) -> DataFrame:
    """``{col}_mean``, ``{col}_std`` (sample), ``{col}={val}_share`` and
    ``fraud_rate`` (a fraction). Totals are aggregates with map-side combine
    joined back, so a group with very many distinct values is no window in one
    task."""
    num = numeric_columns(df, cols)
    aggs = []
    for c in num:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}_mean"), F.stddev_samp(F.col(c).cast("double")).alias(f"{c}_std")]
    has_target = cols.target in df.columns
    if has_target:
        aggs.append(F.avg(F.col(cols.target).cast("double")).alias("fraud_rate"))
    wide = df.groupBy(cols.batch).agg(*aggs)
    entries = []
    for c in num:
        entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(f"{c}_mean").alias("feature"), F.col(f"{c}_mean").alias("value")))
        entries.append(F.struct(F.lit(c).alias("column_name"), F.lit(f"{c}_std").alias("feature"), F.col(f"{c}_std").alias("value")))
    if has_target:
        entries.append(F.struct(F.lit(cols.target).alias("column_name"), F.lit("fraud_rate").alias("feature"), F.col("fraud_rate").alias("value")))
    numeric_long = wide.select(cols.batch, F.inline(F.array(*entries)))

    counts = category_value_counts(df, cols, categorical_columns(df, cols))
    totals = counts.groupBy(cols.batch, "column_name").agg(F.sum("count").alias("__tot"))
    shares = counts.join(totals, [cols.batch, "column_name"])
    shares = shares.select(
        cols.batch, "column_name",
        F.concat(F.col("column_name"), F.lit("="), F.col("value"), F.lit("_share")).alias("feature"),
        (F.col("count").cast("double") / F.col("__tot").cast("double")).alias("value"),
    )
    long = numeric_long.unionByName(shares)
    return _without_dropped(long, dropped, cols).select(cols.batch, "feature", "value")


def reference_features(features: DataFrame, reference_batch: int = 0, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The snapshot ``(feature, value)`` of one batch."""
    return features.filter(F.col(cols.batch) == reference_batch).select("feature", F.col("value").alias("reference"))


def drift_deltas(
    features: DataFrame,
    reference: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    reference_batch: int | None = 0,
    cols: Columns = DEFAULT_COLUMNS,
) -> DataFrame:
    """Features present on both sides; ref = 0 -> |cur|, else |cur-ref|/|ref|."""
    cur = features if reference_batch is None else features.filter(F.col(cols.batch) != reference_batch)
    j = cur.join(reference, "feature")
    delta = F.when(F.col("reference") == 0, F.abs(F.col("value"))).otherwise(
        F.try_divide(F.abs(F.col("value") - F.col("reference")), F.abs(F.col("reference")))
    )
    return j.select(
        cols.batch, "feature",
        F.round("reference", 4).alias("reference"),
        F.round("value", 4).alias("current"),
        F.round(delta * 100.0, 2).alias("delta_pct"),
        F.coalesce(delta > F.lit(threshold), F.lit(False)).alias("drifted"),
    )


def drift_summary(deltas: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Drifted feature list and flag per batch."""
    return deltas.groupBy(cols.batch).agg(
        F.count_if("drifted").cast("long").alias("n_drifted"),
        F.bool_or("drifted").alias("drift_detected"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))), ",").alias("drifted_features"),
    )
