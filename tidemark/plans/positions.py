"""Exact row positions in a global order, computed without a single-task window.

``Window.orderBy`` without ``partitionBy`` moves every row into one task. Here
the table is range-partitioned on the order keys plus a unique tie-breaker, so
even a value (or a group of identical rows) holding a third of the table is
split over many tasks. Each task numbers its rows; the per-partition row counts
(one row per partition, a proven size bound) give the partition offsets.

The numbered table is written to the shared checkpoint folder before the
counts are taken: the position of a row must not change if a task is re-run
after an executor loss, and the counts and the positions must come from the
same range split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, partitions_for

_PID = "__pid"
_POS = "__pos"
_UID = "__uid"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return partitions_for(df)


def global_positions(
    df: DataFrame,
    order: Sequence[Column],
    out_col: str = "position",
    num_partitions: int | None = None,
    checkpoint: bool = True,
    part_col: str | None = None,
) -> DataFrame:
    """Add ``out_col`` = 0-based position of each row in ``order``.

    Ties in ``order`` are broken by an id unique per input row, so the range
    split stays balanced whatever the key skew. ``part_col``: also add the
    number of the row's part of that split.
    """
    n = _num_partitions(df, num_partitions)
    keyed = df.withColumn(_UID, F.monotonically_increasing_id())
    full_order = list(order) + [F.col(_UID).asc()]
    ranged = (
        keyed.repartitionByRange(n, *full_order)
        .sortWithinPartitions(*full_order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    )
    if checkpoint:
        ranged = materialize(ranged, "positions")
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the running sum runs in one task over <= n rows.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = (
        ranged.join(F.broadcast(offsets), _PID)
        .withColumn(out_col, (F.col("__off") + F.col(_POS)).cast("long"))
        .drop(_POS, _UID, "__off")
    )
    out = out.withColumnRenamed(_PID, part_col) if part_col else out.drop(_PID)
    out._tidemark_path = getattr(ranged, "_tidemark_path", None)
    return out


def positions_within_groups(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    out_col: str = "pos_in_group",
    size_col: str | None = None,
    num_partitions: int | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """0-based position of each row inside its group, skew-proof.

    A group's rows are contiguous in the global (groups, order) numbering, so
    the position inside a group is the global position minus the group's
    first position. That is joined by part of the range split and group: by group
    alone, one task would read all rows of a group.
    """
    gorder = [F.col(g).asc_nulls_last() for g in groups] + list(order)
    pos = global_positions(df, gorder, "__gpos", num_partitions, checkpoint, "__part")
    held = pos.groupBy("__part", *groups).agg(F.min("__gpos").alias("__gmin"), F.count(F.lit(1)).alias("__gn"))
    agg = [F.min("__gmin").alias("__gstart")]
    if size_col:
        agg.append(F.sum("__gn").alias(size_col))
    starts = held.groupBy(*groups).agg(*agg)
    starts = starts.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
                           *[c for c in starts.columns if c not in groups])
    cond = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]
    parts = held.select(F.col("__part").alias("__p"), *groups).join(starts, cond).drop(*groups)
    joined = pos.join(parts, [F.col("__part") == F.col("__p"), *cond], "inner")
    out = joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("__gpos") - F.col("__gstart")).alias(out_col),
        *([F.col(size_col)] if size_col else []),
    )
    return out


def group_medians(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    out_col: str = "median",
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact (interpolated) median of ``value`` per group, skew-proof.

    Built-in ``median`` keeps every value of a group in one task's buffer; a
    group holding a third of the rows would have to fit in one task. Here the
    rows are numbered inside their group by the range-partitioned global order,
    and only the one or two middle rows per group are kept and averaged.
    """
    rows = df.select(*groups, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    ranked = positions_within_groups(rows, groups, [F.col("__v").asc()], "__r", "__n", num_partitions)
    lo = F.floor((F.col("__n") - 1) / 2)
    hi = F.ceil((F.col("__n") - 1) / 2)
    mid = ranked.filter((F.col("__r") == lo) | (F.col("__r") == hi))
    return mid.groupBy(*groups).agg(F.avg("__v").alias(out_col))


def group_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float],
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact (interpolated) quantiles of ``value`` per group as rows ``(groups..., prob, quantile)``, skew-proof.

    The general form of ``group_medians``: rows are numbered inside their group by the
    range-partitioned order, and only the one or two rows around each quantile's place are kept."""
    rows = df.select(*groups, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    ranked = positions_within_groups(rows, groups, [F.col("__v").asc()], "__r", "__n", num_partitions)
    places = []
    for p in probs:
        at = F.lit(float(p)) * (F.col("__n") - 1)
        low, share = F.floor(at), at - F.floor(at)
        weight = F.when(F.col("__r") == low, F.lit(1.0) - share).when(F.col("__r") == low + 1, share)
        places.append(F.struct(F.lit(float(p)).alias("prob"), weight.alias("__w")))
    near = ranked.select(*groups, "__v", F.inline(F.array(*places))).filter(F.col("__w") > 0)
    low, high = F.min("__v"), F.max("__v")
    return near.groupBy(*groups, "prob").agg((low + (high - low) * F.coalesce(F.max_by("__w", "__v") * F.when(F.count("*") > 1, 1.0), F.lit(0.0))).alias("quantile"))
