"""The micro-batch path on Structured Streaming.

Batches land as Parquet files (one file per ``batch_index``, written by the
batch store); a file-source stream with ``maxFilesPerTrigger`` hands them to
``foreachBatch``, which runs the same DataFrame operators as the batch path
and writes with dynamic partition overwrite keyed by ``batch_index``. A
replayed micro-batch (after a failure, from the checkpoint) rewrites its own
partitions, so the sink is idempotent. Group by ``batch_index``, never by the
epoch id (it restarts with a new checkpoint).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import BATCH
from tidemark.sources.store import GROUP, BatchStore


GROUP_SIZE = 1024


def write_landing(batched: DataFrame, landing_dir: str, group_size: int = GROUP_SIZE) -> None:
    """Land the batches as Parquet files that each hold whole batches (rows are
    hash-partitioned by ``batch_index`` before the write), in one folder per
    group of ``group_size`` batches. A batch never spans two files, so it never
    spans two micro-batches."""
    (
        batched.repartition(F.col(BATCH))
        .withColumn(GROUP, F.floor(F.col(BATCH) / F.lit(group_size)).cast("int"))
        .write.mode("overwrite")
        .partitionBy(GROUP)
        .parquet(landing_dir)
    )


def run_stream(
    spark: SparkSession,
    landing_dir: str,
    schema,
    process: Callable[[DataFrame], DataFrame],
    sink_dir: str,
    checkpoint_dir: str,
    files_per_trigger: int = 1,
) -> DataFrame:
    """Process every landed file once (``availableNow``) and return the sink.

    ``process`` maps a micro-batch to a result keyed by ``batch_index``.
    """

    parent, kind = sink_dir.rstrip("/").rsplit("/", 1)
    store = BatchStore(spark, parent)

    def each(df: DataFrame, epoch_id: int) -> None:
        store.write(kind, process(df.drop(GROUP)), ids=df.select(BATCH).distinct())

    q = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("basePath", landing_dir)
        .parquet(landing_dir)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return store.read(kind)


def stream_analytics(
    spark: SparkSession,
    landing_dir: str,
    schema,
    root: str,
    checkpoint_dir: str,
    files_per_trigger: int = 16,
    cols=None,
) -> dict[str, DataFrame]:
    """J1 on the stream: quality, cleaning, profile and rules for every
    micro-batch with the batch operators, written to per-batch tables under
    ``root`` (dynamic partition overwrite: replays are idempotent). Returns the
    written tables. Drift and training need batch 0's state first; they run in
    the update job over the stored tables."""
    from tidemark.columns import DEFAULT_COLUMNS
    from tidemark.operators import clean, eda, profile, rules

    C = cols or DEFAULT_COLUMNS
    store = BatchStore(spark, root)

    def each(df: DataFrame, epoch_id: int) -> None:
        df = df.drop(GROUP)
        ids = df.select(BATCH).distinct()

        def sink(rows: DataFrame, name: str) -> None:
            store.write(name, rows, ids=ids)

        sink(profile.quality_report(df, C), "quality")
        sink(profile.batch_meta(df, C), "batch_meta")
        cl = clean.clean(df, C)
        sink(cl.data, "clean")
        sink(eda.describe_numeric(cl.data, cl.dropped, C), "eda_numeric")
        fi = rules.frequent_itemsets(rules.baskets(cl.data, C), rules.RuleParams(), C)
        sink(rules.as_text(rules.top_rules(rules.association_rules(fi, rules.RuleParams(), C), 10, C)), "rules")

    q = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("basePath", landing_dir)
        .parquet(landing_dir)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    names = ("quality", "batch_meta", "clean", "eda_numeric", "rules")
    return {n: store.read(n) for n in names}
