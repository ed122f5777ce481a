"""M*/Q*: batch metadata, quality report and the threshold gate.

Everything per batch comes from one ``groupBy(batch_index)`` pass (partial
aggregation before the shuffle). Duplicate counting groups on all columns;
map-side combine collapses even a huge group of identical rows to one partial
row per task before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns, data_columns
from tidemark.functions.exprs import pct


@dataclass(frozen=True)
class QualityThresholds:
    # Default gate thresholds (percent).
    max_missing_pct: float = 30.0
    max_duplicates_pct: float = 5.0
    max_fraud_rate: float = 50.0


def duplicate_counts(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows equal (NULL = NULL) to an earlier row of their batch, per batch."""
    data = data_columns(df, cols)
    copies = df.groupBy(cols.batch, *data).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.groupBy(cols.batch).agg(F.sum(F.col("__copies") - 1).cast("long").alias("duplicates"))


def _missing_cells(data: list[str]) -> Column:
    cells = [F.col(c).isNull().cast("long") for c in data]
    total = cells[0]
    for c in cells[1:]:
        total = total + c
    return total


def _round(c: Column, digits: int) -> Column:
    return F.round(c, digits)


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def _num_or_null(df: DataFrame, name: str, fn) -> Column:
    return fn(F.col(name)) if _has(df, name) else F.lit(None).cast("double")


def batch_meta(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, approx_distinct: bool = False) -> DataFrame:
    """M1-M9: one metadata row per batch (``approx_distinct``: HyperLogLog++
    for M9 instead of the exact distinct count)."""
    data = data_columns(df, cols)
    n = F.count(F.lit(1))
    agg = [
        n.alias("n_rows"),
        F.lit(len(data)).cast("int").alias("n_cols"),
        F.min(cols.time).alias("date_min"),
        F.max(cols.time).alias("date_max"),
        F.sum(_missing_cells(data)).cast("long").alias("missing_total"),
        F.sum(F.col(cols.target)).cast("long").alias("fraud_count"),
        _round(F.avg(cols.target) * 100.0, 2).alias("fraud_rate"),
        _round(F.avg(cols.amount), 2).alias("amount_mean"),
        _round(F.stddev_samp(cols.amount), 2).alias("amount_std"),
        _round(F.avg(cols.balance), 2).alias("balance_mean"),
        F.mode(cols.txn_type, True).cast("string").alias("top_transaction_type"),
        F.mode(cols.device, True).cast("string").alias("top_device_type"),
        (F.approx_count_distinct(cols.state) if approx_distinct else F.count_distinct(cols.state))
        .cast("long").alias("unique_states"),
    ]
    base = df.groupBy(cols.batch).agg(*agg)
    out = base.join(duplicate_counts(df, cols), cols.batch, "left").withColumn(
        "missing_pct",
        _round(pct(F.col("missing_total"), F.col("n_rows") * F.col("n_cols")), 2),
    )
    return out.select(
        cols.batch, "n_rows", "n_cols", "date_min", "date_max", "missing_total", "missing_pct",
        F.coalesce("duplicates", F.lit(0)).cast("long").alias("duplicates"),
        "fraud_count", "fraud_rate", "amount_mean", "amount_std", "balance_mean",
        "top_transaction_type", "top_device_type", "unique_states",
    )


def missing_per_column(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Q1 in long form: (batch_index, column_name, missing_count)."""
    data = data_columns(df, cols)
    wide = df.groupBy(cols.batch).agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in data])
    return wide.unpivot(cols.batch, data, "column_name", "missing_count").withColumn(
        "missing_count", F.col("missing_count").cast("long")
    )


def quality_report(
    df: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    thresholds: QualityThresholds = QualityThresholds(),
) -> DataFrame:
    """Q2-Q6: scalar quality metrics and the gate, one row per batch.

    The gate is a column (a failed batch still goes on), computed on the
    rounded metrics; a NULL metric fails its check.
    """
    data = data_columns(df, cols)
    n = F.count(F.lit(1))
    base = df.groupBy(cols.batch).agg(
        n.alias("n_rows"),
        F.sum(_missing_cells(data)).cast("long").alias("__missing"),
        _round(F.avg(cols.target) * 100.0, 2).alias("fraud_rate"),
        F.sum(F.col(cols.target)).cast("long").alias("fraud_count"),
        F.count_if(F.col(cols.target) == 0).cast("long").alias("legit_count"),
        _round(F.avg(cols.amount), 2).alias("amount_mean"),
        _round(F.stddev_samp(cols.amount), 2).alias("amount_std"),
        _round(F.avg(cols.balance), 2).alias("balance_mean"),
    )
    rep = base.join(duplicate_counts(df, cols), cols.batch, "left").select(
        cols.batch,
        "n_rows",
        _round(pct(F.col("__missing"), F.col("n_rows") * F.lit(len(data))), 2).alias("missing_pct_total"),
        F.coalesce("duplicates", F.lit(0)).cast("long").alias("duplicates_count"),
        _round(pct(F.coalesce("duplicates", F.lit(0)), F.col("n_rows")), 2).alias("duplicates_pct"),
        "fraud_rate", "fraud_count", "legit_count", "amount_mean", "amount_std", "balance_mean",
    )
    return with_gate(rep, thresholds)


def with_gate(rep: DataFrame, thresholds: QualityThresholds = QualityThresholds()) -> DataFrame:
    """Q6: the three checks and ``passed`` as columns."""
    chk = {
        "missing_ok": F.coalesce(F.col("missing_pct_total") <= F.lit(thresholds.max_missing_pct), F.lit(False)),
        "duplicates_ok": F.coalesce(F.col("duplicates_pct") <= F.lit(thresholds.max_duplicates_pct), F.lit(False)),
        "fraud_rate_ok": F.coalesce(F.col("fraud_rate") <= F.lit(thresholds.max_fraud_rate), F.lit(False)),
    }
    out = rep
    for k, v in chk.items():
        out = out.withColumn(k, v)
    return out.withColumn("passed", F.col("missing_ok") & F.col("duplicates_ok") & F.col("fraud_rate_ok"))


def quality_gate(rep: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return rep.select(cols.batch, "missing_ok", "duplicates_ok", "fraud_rate_ok", "passed")


def column_profile(df: DataFrame, batch_col: str) -> DataFrame:
    """Schema-driven profile of any table, one row per (batch, column).

    Numeric columns: count, missing, distinct, mean, sample std, min, max and
    the exact median (skew-proof, see ``plans.positions.group_medians``).
    String columns: count, missing, distinct, most frequent value (ties:
    smallest) and its count. Every step aggregates with map-side combine
    (value counts first, then per column), so a batch key holding a large
    share of the rows never lands in one task as raw rows.
    """
    from pyspark.sql.types import NumericType, StringType

    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != batch_col]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name != batch_col]
    parts = []
    if num:
        long = df.select(batch_col, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in num
        ])).alias("e")).select(batch_col, "e.column_name", "e.v")
        stats = long.groupBy(batch_col, "column_name").agg(
            F.count("v").alias("count"),
            F.count_if(F.col("v").isNull()).alias("n_missing"),
            F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
            F.min("v").alias("min"), F.max("v").alias("max"),
        )
        distinct = (
            long.groupBy(batch_col, "column_name", "v").agg(F.count(F.lit(1)).alias("k"))
            .groupBy(batch_col, "column_name").agg(F.count("v").alias("n_distinct"))
        )
        from tidemark.plans.positions import group_medians

        medians = group_medians(long, [batch_col, "column_name"], "v")
        parts.append(stats.join(distinct, [batch_col, "column_name"]).join(medians, [batch_col, "column_name"], "left").select(
            batch_col, "column_name",
            F.col("count").cast("long").alias("count"),
            F.col("n_missing").cast("long").alias("n_missing"),
            F.col("n_distinct").cast("long").alias("n_distinct"),
            "mean", "std", "min", "max", "median",
            F.lit(None).cast("string").alias("top_value"), F.lit(None).cast("long").alias("top_count"),
        ))
    if txt:
        long = df.select(batch_col, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("t")) for c in txt
        ])).alias("e")).select(batch_col, "e.column_name", "e.t")
        vc = long.groupBy(batch_col, "column_name", "t").agg(F.count(F.lit(1)).alias("k"))
        top = F.min(F.when(F.col("t").isNotNull(), F.struct((-F.col("k")).alias("nk"), F.col("t").alias("t"))))
        stats = vc.groupBy(batch_col, "column_name").agg(
            F.sum(F.when(F.col("t").isNotNull(), F.col("k"))).alias("count"),
            F.sum(F.when(F.col("t").isNull(), F.col("k"))).alias("n_missing"),
            F.count("t").alias("n_distinct"),
            top.alias("__top"),
        )
        parts.append(stats.select(
            batch_col, "column_name",
            F.coalesce("count", F.lit(0)).cast("long").alias("count"),
            F.coalesce("n_missing", F.lit(0)).cast("long").alias("n_missing"),
            F.col("n_distinct").cast("long").alias("n_distinct"),
            F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("std"),
            F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"),
            F.lit(None).cast("double").alias("median"),
            F.col("__top.t").alias("top_value"), (-F.col("__top.nk")).cast("long").alias("top_count"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
