"""De-duplication, sparse-column removal, median/mode fill, validity filter.

The all-batch form keeps one schema: a column dropped in a batch (C2) is
NULLed in that batch's rows and listed in ``dropped``; later operators skip
those (batch, column) pairs. All per-batch parameters (missing counts, row
counts after de-duplication, medians, modes) come from two aggregates with one
row per batch, joined back on ``batch_index`` (Catalyst broadcasts that side
while its measured size is under the threshold, and shuffles otherwise).
Per-batch medians/modes hold at most ``batch_size`` values per group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, IntegerType, LongType, NumericType, ShortType, StringType

from tidemark.columns import DEFAULT_COLUMNS, Columns, data_columns
from tidemark.functions.exprs import pct

# Fixed value: a column is dropped when its missing share exceeds this percent.
DEFAULT_MAX_MISSING_PCT = 30.0


@dataclass
class Cleaned:
    data: DataFrame
    dropped: DataFrame
    params: DataFrame


def dedupe(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Keep the first (lowest ``row_idx``) of rows equal in every column.

    NULL equals NULL in grouping keys; map-side combine collapses large copy
    groups before the shuffle.
    """
    data = data_columns(df, cols)
    kept = df.groupBy(cols.batch, *data).agg(F.min(cols.row).alias(cols.row))
    return kept.select(*df.columns)


def _m(c):
    return f"__miss__{c}"


def _d(c):
    return f"__drop__{c}"


def _f(c):
    return f"__fill__{c}"


def clean_params(
    raw: DataFrame,
    deduped: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    max_missing_pct: float = DEFAULT_MAX_MISSING_PCT,
    exact: bool = True,
) -> DataFrame:
    """One row per batch: drop flags (C2) and fill values.
    ``exact=False`` takes medians with ``percentile_approx``."""
    data = data_columns(raw, cols)
    miss = raw.groupBy(cols.batch).agg(
        F.count(F.lit(1)).alias("__rows_before"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(_m(c)) for c in data],
    )
    fills = []
    for f in deduped.schema.fields:
        if f.name not in data:
            continue
        if isinstance(f.dataType, NumericType):
            med = F.median(f.name) if exact else F.percentile_approx(F.col(f.name).cast("double"), 0.5)
            fills.append(med.cast("double").alias(_f(f.name)))
        elif isinstance(f.dataType, StringType):
            fills.append(F.mode(f.name, True).alias(_f(f.name)))
    stats = deduped.groupBy(cols.batch).agg(F.count(F.lit(1)).alias("__rows_dedup"), *fills)
    joined = miss.join(stats, cols.batch)
    flags = [
        F.coalesce(pct(F.col(_m(c)), F.col("__rows_dedup")) > F.lit(max_missing_pct), F.lit(False)).alias(_d(c))
        for c in data
    ]
    return joined.select(cols.batch, "__rows_before", "__rows_dedup", *flags, *[_f(c) for c in data if _f(c) in joined.columns])


def dropped_columns(params: DataFrame, data: list[str], cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """C2 as a table: (batch_index, column_name) for every dropped column."""
    long = params.select(
        cols.batch,
        F.explode(F.array(*[F.when(F.col(_d(c)), F.lit(c)) for c in data])).alias("column_name"),
    )
    return long.filter(F.col("column_name").isNotNull())


def fill_and_filter(
    deduped: DataFrame,
    params: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    filter_invalid: bool = True,
    only_invalid: bool = False,
) -> DataFrame:
    """C2 (NULL dropped), C3 (fill), C4 (validity filter) on de-duplicated rows.

    Integer columns become doubles, as a median may lie between two integers;
    only the 64-bit ones that ``cols`` names as identifiers keep their type
    (their median is rounded)."""
    identifiers = {cols.id, *cols.model_drop}
    data = data_columns(deduped, cols)
    j = deduped.join(params, cols.batch)
    out = []
    types = {f.name: f.dataType for f in deduped.schema.fields}
    for c in deduped.columns:
        if c not in data:
            out.append(F.col(c))
            continue
        t = types[c]
        v = F.col(c)
        if _f(c) in params.columns:
            fill = F.col(_f(c))
            if isinstance(t, LongType) and c in identifiers:
                fill = F.round(fill).cast(t)
            elif isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
                t, v = DoubleType(), v.cast("double")
            elif isinstance(t, NumericType):
                fill = fill.cast(t)
            v = F.coalesce(v, fill)
        out.append(F.when(F.col(_d(c)), F.lit(None).cast(t)).otherwise(v).alias(c))
    filled = j.select(*out, *[F.col(_d(c)) for c in data])
    if only_invalid:
        filled = filled.filter(~valid_rows(filled, cols))
    elif filter_invalid:
        filled = filled.filter(valid_rows(filled, cols))
    return filled.select(*deduped.columns)


def valid_rows(df: DataFrame, cols: Columns = DEFAULT_COLUMNS):
    """C4 predicate: amount >= 0, balance >= 0, age in [0, 120]; a check applies
    only where its column exists (not dropped); NULL fails."""
    cond = F.lit(True)
    checks = [
        (cols.amount, lambda c: c >= 0),
        (cols.balance, lambda c: c >= 0),
        (cols.age, lambda c: c.between(0, 120)),
    ]
    for name, fn in checks:
        if name not in df.columns:
            continue
        ok = F.coalesce(fn(F.col(name)), F.lit(False))
        if _d(name) in df.columns:
            ok = F.col(_d(name)) | ok
        cond = cond & ok
    return cond


def clean(
    raw: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    max_missing_pct: float = DEFAULT_MAX_MISSING_PCT,
    materialize: bool = True,
) -> Cleaned:
    """C1 -> C2 -> C3 -> C4 for all batches at once.

    With ``materialize`` the cleaned rows and the per-batch parameters are
    written to the shared checkpoint folder: every later stage reads them,
    most of them several times."""
    from tidemark.session import materialize as write_back

    deduped = dedupe(raw, cols)
    params = clean_params(raw, deduped, cols, max_missing_pct)
    if materialize:
        params = write_back(params, "clean-params", bucket_col=cols.batch)
    data = fill_and_filter(deduped, params, cols)
    if materialize:
        data = write_back(data, "clean", bucket_col=cols.batch)
    return Cleaned(data=data, dropped=dropped_columns(params, data_columns(raw, cols), cols), params=params)


def invalid_rows(raw: DataFrame, cols: Columns = DEFAULT_COLUMNS, max_missing_pct: float = DEFAULT_MAX_MISSING_PCT) -> DataFrame:
    """Rows removed by C4 (after C1-C3)."""
    deduped = dedupe(raw, cols)
    params = clean_params(raw, deduped, cols, max_missing_pct)
    return fill_and_filter(deduped, params, cols, only_invalid=True)


def clean_audit(raw: DataFrame, cleaned: Cleaned, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows before, after de-duplication and after the filter, per batch."""
    after = cleaned.data.groupBy(cols.batch).agg(F.count(F.lit(1)).alias("rows_after"))
    p = cleaned.params.select(cols.batch, "__rows_before", "__rows_dedup")
    j = p.join(after, cols.batch, "left")
    return j.select(
        cols.batch,
        F.col("__rows_before").cast("long").alias("rows_before"),
        (F.col("__rows_before") - F.col("__rows_dedup")).cast("long").alias("duplicates_removed"),
        F.col("__rows_dedup").cast("long").alias("rows_after_dedupe"),
        (F.col("__rows_dedup") - F.coalesce(F.col("rows_after"), F.lit(0))).cast("long").alias("invalid_removed"),
        F.coalesce(F.col("rows_after"), F.lit(0)).cast("long").alias("rows_after"),
    )
