"""The profile tables behind the reference's charts, for all batches.

Wide per-batch aggregates (one pass, partial aggregation) are unpivoted after
the shuffle, when they are small; category counts unpivot the string columns
first and combine map-side. Pairs (batch, column) dropped by the cleaner are
left out, as the reference no longer has those columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns, categorical_columns, data_columns, numeric_columns

HIST_BINS = 30
MAX_CATEGORIES_FOR_COUNTS = 20
TOP_CATEGORIES = 3


def _without_dropped(long: DataFrame, dropped: DataFrame | None, cols: Columns, name: str = "column_name") -> DataFrame:
    if dropped is None:
        return long
    d = dropped.select(cols.batch, F.col("column_name").alias(name))
    return long.join(d, [cols.batch, name], "left_anti")


def drop_flags(df: DataFrame, dropped: DataFrame | None, columns: Sequence[str], cols: Columns) -> DataFrame:
    """One row per batch with ``__dropped`` = array of the batch's dropped columns."""
    ids = df.select(cols.batch).distinct()
    if dropped is None:
        return ids.withColumn("__dropped", F.array().cast("array<string>"))
    lists = dropped.groupBy(cols.batch).agg(F.collect_list("column_name").alias("__dropped"))
    return ids.join(lists, cols.batch, "left").withColumn(
        "__dropped", F.coalesce("__dropped", F.array().cast("array<string>"))
    )


def profile_header(df: DataFrame, dropped: DataFrame | None = None, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows, columns, numeric and categorical column lists, target rate."""
    data = data_columns(df, cols)
    num = numeric_columns(df, cols)
    cat = categorical_columns(df, cols)
    base = df.groupBy(cols.batch).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(cols.target) * 100.0, 2).alias("fraud_rate"),
    )
    flags = drop_flags(df, dropped, data, cols)
    j = base.join(flags, cols.batch)

    def kept(names):
        return F.concat_ws(",", *[F.when(~F.array_contains("__dropped", n), F.lit(n)) for n in names])

    return j.select(
        cols.batch,
        F.col("n_rows").cast("long").alias("n_rows"),
        (F.lit(len(data)) - F.size("__dropped")).cast("int").alias("n_cols"),
        kept(num).alias("numeric_cols"),
        kept(cat).alias("cat_cols"),
        "fraud_rate",
    )


def describe_numeric(df: DataFrame, dropped: DataFrame | None = None, cols: Columns = DEFAULT_COLUMNS,
                     exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (interpolated), max.

    Rounded to 4 digits (not 2): quantiles interpolated between cent values
    often fall on an exact half-cent, where 2-digit rounding depends on the
    last bit of the interpolation formula; at 4 digits they are exact.
    ``exact=False`` uses ``percentile_approx`` (bounded memory per group)."""
    num = numeric_columns(df, cols)
    probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    aggs = []
    for i, c in enumerate(num):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            (F.percentile(v, probs) if exact else F.percentile_approx(v, probs)).cast("array<double>").alias(f"q{i}"),
            F.max(v).alias(f"max{i}"),
        ]
    wide = df.groupBy(cols.batch).agg(*aggs)
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("std"), F.col(f"min{i}").alias("min"), F.col(f"q{i}")[0].alias("p25"),
            F.col(f"q{i}")[1].alias("p50"), F.col(f"q{i}")[2].alias("p75"), F.col(f"max{i}").alias("max"),
        )
        for i, c in enumerate(num)
    ])
    long = wide.select(cols.batch, F.inline(entries))
    long = _without_dropped(long, dropped, cols)
    r = lambda c: F.round(F.col(c), 4).alias(c)
    return long.select(
        cols.batch, "column_name", F.col("count").cast("long").alias("count"),
        r("mean"), r("std"), r("min"), r("p25"), r("p50"), r("p75"), r("max"),
    )


def category_value_counts(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, columns: Sequence[str] | None = None) -> DataFrame:
    """(batch_index, column_name, value, count) over the string columns, NULL skipped."""
    cat = list(columns) if columns is not None else categorical_columns(df, cols)
    long = df.select(cols.batch, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cat
    ])).alias("__e")).select(cols.batch, "__e.column_name", "__e.value")
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy(cols.batch, "column_name", "value")
        .agg(F.count(F.lit(1)).cast("long").alias("count"))
    )


def top_categories(df: DataFrame, k: int = TOP_CATEGORIES, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The k most frequent values per (batch, column); ties by value."""
    counts = category_value_counts(df, cols)
    w = Window.partitionBy(cols.batch, "column_name").orderBy(F.desc("count"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def category_counts(df: DataFrame, max_distinct: int = MAX_CATEGORIES_FOR_COUNTS, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Full value counts of string columns with at most ``max_distinct`` values."""
    counts = category_value_counts(df, cols)
    w = Window.partitionBy(cols.batch, "column_name")
    return (
        counts.withColumn("__nd", F.count(F.lit(1)).over(w))
        .filter(F.col("__nd") <= max_distinct)
        .drop("__nd")
    )


def correlation(df: DataFrame, dropped: DataFrame | None = None, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Pearson matrix of numeric columns on pairwise-complete rows, 2 digits.

    A constant column gives NULL (never a division error). All pairs come
    from one aggregate; the matrix is mirrored from its upper triangle.
    """
    num = numeric_columns(df, cols)
    if len(num) < 2:
        return df.sparkSession.createDataFrame([], f"{cols.batch} int, col_a string, col_b string, corr double")
    aggs, pairs = [], []
    for i, a in enumerate(num):
        for j in range(i, len(num)):
            b = num[j]
            x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
            y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
            val = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
            aggs.append(val.alias(f"c{i}_{j}"))
            pairs.append((a, b, f"c{i}_{j}"))
            if i != j:
                pairs.append((b, a, f"c{i}_{j}"))
    wide = df.groupBy(cols.batch).agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(k).alias("corr")) for a, b, k in pairs
    ])
    long = wide.select(cols.batch, F.inline(entries))
    long = _without_dropped(long, dropped, cols, "col_a")
    long = _without_dropped(long, dropped, cols, "col_b")
    return long.select(cols.batch, "col_a", "col_b", F.round("corr", 2).alias("corr"))


def histogram(
    df: DataFrame, dropped: DataFrame | None = None, bins: int = HIST_BINS, cols: Columns = DEFAULT_COLUMNS
) -> DataFrame:
    """E5: equal-width bins on [min, max] per (batch, column), last bin closed,
    empty bins with count 0. A constant column is widened by 0.5 on each side.
    The target column is excluded.

    The ranges are one wide row per batch, joined on the batch alone (the
    table's own partitioning); bins are computed per column and counted as
    (column, bin) pairs with map-side combine; dropped columns go from the
    short tables.
    """
    num = [c for c in numeric_columns(df, cols) if c != cols.target]
    value = {c: F.col(c).cast("double") for c in num}
    wide = df.groupBy(cols.batch).agg(
        *[F.min(value[c]).alias(f"__lo{i}") for i, c in enumerate(num)], *[F.max(value[c]).alias(f"__hi{i}") for i, c in enumerate(num)]
    )
    ends = []
    for i, _ in enumerate(num):
        same = F.col(f"__lo{i}") == F.col(f"__hi{i}")
        ends += [F.when(same, F.col(f"__lo{i}") - 0.5).otherwise(F.col(f"__lo{i}")).alias(f"lo{i}"),
                 F.when(same, F.col(f"__hi{i}") + 0.5).otherwise(F.col(f"__hi{i}")).alias(f"hi{i}")]
    wide = wide.select(cols.batch, *ends)
    at = []
    for i, c in enumerate(num):
        norm = F.lit(float(bins)) / (F.col(f"hi{i}") - F.col(f"lo{i}"))
        at.append(F.when(value[c].isNotNull(), F.struct(
            F.lit(c).alias("column_name"), F.least(F.floor((value[c] - F.col(f"lo{i}")) * norm), F.lit(bins - 1)).cast("int").alias("bin"))))
    pairs = df.join(wide, cols.batch).select(cols.batch, F.explode(F.array_compact(F.array(*at))).alias("__e"))
    counted = pairs.groupBy(cols.batch, "__e.column_name", "__e.bin").agg(F.count(F.lit(1)).cast("long").alias("__n"))
    ranges = wide.select(cols.batch, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi")) for i, c in enumerate(num)
    ]))).filter(F.col("lo").isNotNull())
    ranges = _without_dropped(ranges, dropped, cols)
    every = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return every.join(counted, [cols.batch, "column_name", "bin"], "left").select(
        cols.batch, "column_name", "bin",
        F.round(F.col("lo") + F.col("bin") * width, 4).alias("bin_lo"),
        F.round(F.col("lo") + (F.col("bin") + 1) * width, 4).alias("bin_hi"),
        F.coalesce("__n", F.lit(0)).cast("long").alias("count"),
    )


def target_rate_by_category(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Mean target x100 per value of the breakdown columns present."""
    rate_cols = [c for c in cols.rate_columns if c in df.columns]
    long = df.select(cols.batch, F.col(cols.target).alias("__t"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in rate_cols
    ])).alias("__e")).select(cols.batch, "__t", "__e.column_name", "__e.value")
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy(cols.batch, "column_name", "value")
        .agg(F.round(F.avg("__t") * 100.0, 4).alias("target_rate"), F.count(F.lit(1)).cast("long").alias("n"))
    )
