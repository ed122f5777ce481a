"""Ordered fixed-size batches and the pending-batch lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns
from tidemark.functions.exprs import nan_to_null
from tidemark.plans.positions import global_positions
from tidemark.session import discard, materialize

DEFAULT_BATCH_SIZE = 2000


def assign_batches(
    df: DataFrame,
    batch_size: int = DEFAULT_BATCH_SIZE,
    cols: Columns = DEFAULT_COLUMNS,
    num_partitions: int | None = None,
    bucketed: bool = True,
    start_row: int = 0,
    start_batch: int = 0,
) -> DataFrame:
    """Number rows in (time, id) order and cut them into ``batch_size`` slices.

    Adds ``row_idx`` (0-based position, NULL times last) and ``batch_index`` =
    ``row_idx div batch_size``: the last batch is short and no row is lost.
    The ordering runs as a range-partitioned sort (see ``plans.positions``),
    so no task holds more than its share of the table. NaN becomes NULL here,
    once, so every later comparison has pandas semantics. ``start_row`` and
    ``start_batch`` continue the numbering of rows stored before.
    """
    order = [F.col(cols.time).asc_nulls_last()]
    if cols.id in df.columns:
        order.append(F.col(cols.id).asc_nulls_last())
    numbered = global_positions(nan_to_null(df), order, cols.row, num_partitions)
    out = numbered.withColumn(cols.batch, F.expr(f"CAST(`{cols.row}` DIV {int(batch_size)} AS INT)") + F.lit(int(start_batch)))
    out = out.withColumn(cols.row, F.col(cols.row) + F.lit(int(start_row)).cast("long"))
    if bucketed:
        # Every later operator groups or joins on batch_index: write the table
        # bucketed by it once, so those stages run without another shuffle of
        # the rows (a batch holds at most batch_size rows: no skewed bucket).
        out = materialize(out, "batched", bucket_col=cols.batch, buckets=num_partitions)
        discard(numbered)
    return out


def batch_ids(batched: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return batched.select(cols.batch).distinct()


def pending_batches(batched: DataFrame, stored_meta: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Batch numbers present in the source but absent from the batch store."""
    return batch_ids(batched, cols).join(stored_meta.select(cols.batch).distinct(), cols.batch, "left_anti")


def next_batch(batched: DataFrame, stored_meta: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The rows of the lowest pending batch (empty when every batch is stored)."""
    first = pending_batches(batched, stored_meta, cols).agg(F.min(cols.batch).alias(cols.batch))
    return batched.join(first, cols.batch, "left_semi")
