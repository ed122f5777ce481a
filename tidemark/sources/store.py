"""The batch store and report tables.

Raw batches and every report are Parquet tables with a ``batch_index``
column, partitioned by ``batch_group = batch_index div group_size`` (one
folder per group of batches, not per batch: a table of many millions of
batches stays at a sane folder count) and written with dynamic partition
overwrite. Batches that the table doesn't hold yet are appended; otherwise a
write replaces exactly the groups it touches, and rows of other batches inside a
partly covered group are carried over first, so re-running a batch (a
replayed micro-batch, a retried job) replaces only its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import BATCH
from tidemark.session import delete_path, discard, list_names, materialize

GROUP = "batch_group"


class BatchStore:
    def __init__(self, spark: SparkSession, root: str, group_size: int = 1024):
        self.spark = spark
        self.root = root.rstrip("/")
        self.group_size = int(group_size)

    def path(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def _exists(self, kind: str) -> bool:
        """Whether the table holds files (a table written without rows has a folder and no file)."""
        return any(n.startswith((f"{GROUP}=", "part-")) for n in list_names(self.spark, self.path(kind)))

    def _grouped(self, df: DataFrame) -> DataFrame:
        return df.withColumn(GROUP, F.floor(F.col(BATCH) / F.lit(self.group_size)).cast("int"))

    def write(self, kind: str, df: DataFrame, partitioned: bool = True, ids: DataFrame | None = None) -> None:
        """Write a per-batch table. The rows of the batches in ``ids`` (by
        default: those that occur in ``df``) are replaced, also where a batch has
        no rows any more. ``df`` is evaluated once."""
        if not (partitioned and BATCH in df.columns):
            df.write.mode("overwrite").parquet(self.path(kind))
            return
        new = self._grouped(df)
        if not self._exists(kind):
            self._put(kind, new)
            return
        if ids is not None and not self._holds(kind, ids):
            new.write.mode("append").partitionBy(GROUP).parquet(self.path(kind))  # nothing to replace
            return
        new = materialize(new, f"new-{kind}")
        done = (new if ids is None else self._grouped(ids.select(BATCH))).select(GROUP, BATCH).distinct()
        touched = [r[0] for r in done.select(GROUP).distinct().collect()]  # one number for each folder this write touches
        # carry over the other batches of those folders (written first: the folders are about to be replaced)
        old = self.spark.read.parquet(self.path(kind)).filter(F.col(GROUP).isin(touched))
        keep = materialize(old.join(done.select(BATCH), BATCH, "left_anti"), f"carry-{kind}")
        whole = new.unionByName(keep, allowMissingColumns=True)
        left = {r[0] for r in whole.select(GROUP).distinct().collect()}
        self._put(kind, whole)
        for group in set(touched) - left:
            delete_path(self.spark, f"{self.path(kind)}/{GROUP}={group}")
        discard(new, keep)

    def _holds(self, kind: str, ids: DataFrame) -> bool:
        """Whether the table has rows of any of these batches (as after a run that stopped while it wrote)."""
        folders = [r[0] for r in self._grouped(ids.select(BATCH)).select(GROUP).distinct().collect()]
        stored = self.spark.read.parquet(self.path(kind)).filter(F.col(GROUP).isin(folders)).select(BATCH)
        return not stored.join(ids.select(BATCH), BATCH, "left_semi").isEmpty()

    def _put(self, kind: str, df: DataFrame) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(GROUP).parquet(self.path(kind))

    def read(self, kind: str) -> DataFrame | None:
        """All batches of a table (None when nothing was written)."""
        if not self._exists(kind):
            return None
        df = self.spark.read.parquet(self.path(kind))
        return df.drop(GROUP) if GROUP in df.columns else df

    def read_batches(self, kind: str, ids: DataFrame) -> DataFrame | None:
        """The rows of the batches in ``ids``; only their folders are read."""
        if not self._exists(kind):
            return None
        df = self.spark.read.parquet(self.path(kind))
        return df.join(self._grouped(ids.select(BATCH)), [GROUP, BATCH], "left_semi").drop(GROUP)

    def save_batches(self, batched: DataFrame, meta: DataFrame, ids: DataFrame | None = None) -> None:
        """Raw rows and their metadata (with ``saved_at``)."""
        self.write("raw", batched, ids=ids)
        self.write("batch_meta", meta.withColumn("saved_at", F.current_timestamp()), ids=ids)

    def load_all_batches(self) -> DataFrame | None:
        return self.read("raw")

    def history(self, kind: str) -> DataFrame | None:
        df = self.read(kind)
        return None if df is None else df.orderBy(BATCH)
