"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are put in one global order (text key, then ``doc_id``) by range
partitioning; every task adds up the sizes of its own rows, the per-partition
totals give each partition its start, and a row's shard is the byte offset of
its middle divided by the common target. The order is total up to identical rows, so a
group of copies that holds a third of the table is split over many tasks.

Copies of a text are neighbours in that order. A group that straddles a cut
goes whole to the earlier shard when it is small (at most ``group_slack`` of a
shard's target, so that bytes stay near equal); larger groups are split. At
most ``n_shards - 1`` groups can straddle a cut, which bounds that table.

Defined results: a null or empty text has the size 8 and the CRC 0; a null
``doc_id`` sorts first; an empty table gives no rows; identical rows get
different slots; input columns named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_key, written

N_SHARDS = 24
GROUP_SLACK = 0.01


def byte_size(text: str = "text"):
    """UTF-8 bytes of the text plus 8 (null: 8)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row number and byte offset of every row inside its partition."""
    row, total = 0, 0
    for batch in batches:
        size = batch.column(batch.schema.get_field_index("__size")).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        more = [pa.array(np.arange(row, row + len(size))), pa.array(total + ends - size)]
        row, total = row + len(size), total + int(ends[-1]) if len(size) else total
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "__row", "__at"])


def prefix_sums(df: DataFrame, order: list, size: str = "__size") -> DataFrame:
    """Add ``__pos`` (global row number) and ``__before`` (sum of ``size`` of all earlier rows) in the given order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("__row", T.LongType()), T.StructField("__at", T.LongType())])
    summed = written(ranged.mapInArrow(_running, schema), "ranged")  # totals and offsets must come from the same split
    totals = summed.groupBy("__part").agg(F.count("*").alias("__n"), F.sum(size).alias("__sum"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = totals.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__pos0"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__at0"))
    out = summed.join(F.broadcast(starts), "__part")
    return out.withColumn("__pos", F.col("__pos0") + F.col("__row")).withColumn("__before", F.col("__at0") + F.col("__at")).drop("__part", "__row", "__at", "__pos0", "__at0")


def shard(df: DataFrame, n_shards: int = N_SHARDS, group_slack: float = GROUP_SLACK) -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_shards - 1``) and ``slot`` (gapless from 0 in each shard, in the global order)."""
    columns = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    keyed = df.select(*columns, byte_size().alias("__size"), text_key().alias("__text"))
    return _cut(keyed, columns, n_shards, group_slack)


def shard_digest(df: DataFrame, n_shards: int = N_SHARDS, group_slack: float = GROUP_SLACK) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; texts stay out of the shuffle."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    keyed = df.select("doc_id", byte_size().alias("size"), crc.alias("text_crc32"), byte_size().alias("__size"), text_key().alias("__text"))
    return _cut(keyed, ["doc_id", "size", "text_crc32"], n_shards, group_slack)


def _cut(keyed: DataFrame, columns: list[str], n_shards: int, group_slack: float) -> DataFrame:
    order = [F.col("__text"), F.col("doc_id")]
    placed = prefix_sums(keyed, order)
    total = placed.agg(F.sum("__size")).first()[0] or 1
    target = total / n_shards
    middle = F.col("__before") + F.col("__size") / 2
    own = F.least(F.floor(middle / F.lit(float(target))).cast("int"), F.lit(n_shards - 1))
    placed = placed.withColumn("__own", own)
    group = placed.groupBy("__text").agg(F.min("__own").alias("__first"), F.max("__own").alias("__last"), F.sum("__size").alias("__bytes"))
    straddling = group.filter((F.col("__first") < F.col("__last")) & (F.col("__bytes") <= group_slack * target)).select("__text", "__first")
    placed = placed.join(F.broadcast(straddling), "__text", "left")  # fewer rows than shards
    placed = placed.withColumn("shard", F.coalesce("__first", "__own"))
    begin = placed.groupBy("shard").agg(F.min("__pos").alias("__begin"))
    return placed.join(F.broadcast(begin), "shard").select(*columns, "shard", (F.col("__pos") - F.col("__begin")).alias("slot"))


def write_shards(df: DataFrame, path: str, n_shards: int = N_SHARDS) -> None:
    """Store the rows as one folder for each shard, in slot order inside a file."""
    shard(df, n_shards).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
