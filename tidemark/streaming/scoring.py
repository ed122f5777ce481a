"""G2/G4 on a stream: arriving rows scored by the production model of the moment, with one log row for each epoch.

The registry is looked at when an epoch begins; if another model has been promoted
since, it is loaded before the epoch is scored, so an epoch is scored by one
model and the log says by which. An epoch's scored rows and its log row are written
to folders of its own (a replay replaces them).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features, serve
from tidemark.plans import jobs
from tidemark.sources.store import BatchStore
from tidemark.streaming.run import run_to_end

LOG_SCHEMA = "n_rows long, elapsed_ms double, ms_per_row double, model_name string, model_number long, logged_at timestamp"


class Scorer:
    """Scores micro-batches; reloads model and preparation when another model is in production."""

    def __init__(self, spark: SparkSession, root: str, out: str):
        self.spark, self.store, self.out = spark, BatchStore(spark, root), out.rstrip("/")
        self.number: int | None = None

    def refresh(self) -> None:
        now = serve.current(self.spark, self.store.path("registry"), "production")
        if now["number"] != self.number:
            self.serving = serve.Serving.production(self.spark, self.store.path("registry"))
            self.fitted = features.FittedFeatures.load(self.spark, self.store.path("fitted_features"))
            self.number = now["number"]

    def score(self, rows: DataFrame) -> DataFrame:
        return jobs.scored(rows, self.fitted, self.serving)

    def each(self, rows: DataFrame, epoch: int) -> None:
        self.refresh()
        began = time.perf_counter()
        path = f"{self.out}/scored/epoch={epoch}"
        self.score(rows).write.mode("overwrite").parquet(path)
        ms = round((time.perf_counter() - began) * 1000.0, 2)
        n = self.spark.read.parquet(path).count()  # from file footers
        entry = self.spark.createDataFrame([(n, ms, round(ms / max(n, 1), 4), self.serving.model_name, self.number)], LOG_SCHEMA.rsplit(",", 1)[0])
        entry.withColumn("logged_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{self.out}/log/epoch={epoch}")


def score_stream(spark: SparkSession, stream: DataFrame, root: str, out: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """``(scored rows, log)`` of everything that has arrived; runs until nothing new is there."""
    scorer = Scorer(spark, root, out)
    run_to_end(stream, scorer.each, checkpoint)
    read = lambda kind: spark.read.parquet(f"{scorer.out}/{kind}")
    return read("scored").drop("epoch"), read("log")
