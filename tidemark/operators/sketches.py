"""E2, C3, P2 on groups of any size: mergeable quantile sketches.

A KLL sketch keeps a few kilobytes whatever the number of values, and sketches of
parts merge into that of the whole. So each batch stores one sketch a column
(map-side combined), and quantiles of any set of batches, up to the whole history,
come from the stored sketches without another look at the rows. The exact form for
groups that don't fit into a task is ``plans.positions.group_quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches, and the error of a rank, as a share of the rows, that it keeps to with 99 % probability.
K = 400
RANK_ERROR = 0.01


def quantile_sketches(df: DataFrame, groups: Sequence[str], columns: Sequence[str], k: int = K) -> DataFrame:
    """``(groups..., column_name, n, min, max, sketch)``; missing values and NaN aren't counted; columns without values have no row."""
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    aggs = []
    for i, v in enumerate(value.values()):
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.kll_sketch_agg_double(v, k).alias(f"s{i}")]
    wide = df.groupBy(*groups).agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"), F.col(f"s{i}").alias("sketch"))
             for i, c in enumerate(columns)]
    return wide.select(*groups, F.inline(F.array(*cells))).filter(F.col("n") > 0)


def merged(sketches: DataFrame, groups: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of coarser groups (of everything, if none are named) from stored ones."""
    return sketches.groupBy(*groups, "column_name").agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketches: DataFrame, groups: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(groups..., column_name, prob, quantile)``, the ends being exact."""
    def at(p: float):
        return F.col("min") if p <= 0 else F.col("max") if p >= 1 else F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))

    cells = F.array(*[F.struct(F.lit(float(p)).alias("prob"), at(p).alias("quantile")) for p in probs])
    return sketches.select(*groups, "column_name", F.inline(cells))
