"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input for each partition of a shuffle.
PARTITION_BYTES = 128 << 20


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting (tests) gets a fresh folder of its own; on a cluster
    such a folder would lie on one machine, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


#: Scratch folders and tables this process has made: path -> table name (or None).
_made: dict[str, str | None] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name inside the shared checkpoint folder (for written tables)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made[path] = None
    return path


def partitions_for(df: DataFrame, bytes_each: int = PARTITION_BYTES) -> int:
    """Partitions for a shuffle of ``df``: its input bytes over ``bytes_each``, at least the configured number.

    Input bytes are the sum over the plan's leaves (files and tables), known
    without a job, so the count grows with the data whatever the setting."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    known = total if total < 1 << 60 else 0  # a leaf without statistics counts as unknown
    return max(least, -(-known // bytes_each))


def materialize(df, name: str = "stage", bucket_col: str | None = None, buckets: int | None = None, in_order: bool = False):
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder
    and read it back. Columnar and compressed (cheaper than an RDD
    checkpoint), survives executor loss, and later scans get pushdown.

    With ``bucket_col`` the table is written bucketed (one file per bucket,
    registered as an external table over that folder), so later aggregates
    and joins keyed by that column reuse the partitioning instead of
    shuffling the rows again, and a filter on one value reads one bucket; with
    ``in_order`` its files are sorted by it and such a filter reads a few pages.

    ``discard`` drops it; what is left goes when the process ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if bucket_col is None:
        df.write.mode("overwrite").parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    else:
        n = int(buckets or partitions_for(df))
        table = f"tidemark_{name.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
        writer = df.repartition(n, bucket_col).write.mode("overwrite").bucketBy(n, bucket_col)
        (writer.sortBy(bucket_col) if in_order else writer).option("path", path).saveAsTable(table)
        _made[path] = table
        out = spark.table(table)
    out._tidemark_path = path
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder on any file system Spark knows; empty if there is none."""
    target, fs = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def delete_path(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(sc._jsc.hadoopConfiguration())


def discard(*frames) -> None:
    """Drop the tables and folders behind frames that ``materialize`` made and nothing reads any more."""
    for df in frames:
        path = getattr(df, "_tidemark_path", None)
        if path is not None:
            _drop(df.sparkSession, path)


def release(spark: SparkSession | None = None) -> None:
    """Drop every scratch table and folder this process has made."""
    spark = spark or SparkSession.getActiveSession()
    if spark is not None:
        for path in list(_made):
            _drop(spark, path)


def _drop(spark: SparkSession, path: str) -> None:
    table = _made.pop(path, None)
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    delete_path(spark, path)


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        release()
