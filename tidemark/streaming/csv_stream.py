"""S1/S2 as a stream: CSV files as they land, with bad files and bad rows set aside.

The stream carries file names only (a ``binaryFile`` source whose content is never
selected, so nothing is read twice). Each micro-batch, of at most
``files_per_trigger`` files, looks at the files' headers, reads files of one header
together, and parses them as ``csv_source`` does: columns by header name,
missing-value tokens, dates of mixed layouts. What can't be used goes to two side
tables instead of stopping the stream:

* ``bad_files``: a file without a header or without one of the columns (one of no bytes is passed over);
* ``bad_rows``: a row with more or fewer cells than the header has, or with values that
  aren't of their column's type; with its text and the columns concerned.

Both are written by epoch (a replayed epoch replaces its own part), and the
good rows go to ``process(rows, epoch)``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns
from tidemark.functions.exprs import DEFAULT_DATE_FORMATS
from tidemark.sources.csv_source import typed, unparsed, without_tokens
from tidemark.streaming.run import run_to_end

BAD_FILES = "file string, reason string"
BAD_ROWS = "file string, record string, columns array<string>"
_TEXT, _FILE = "__record", "__file"


def parse_files(spark: SparkSession, paths: Sequence[str], types: Mapping[str, str], cols: Columns = DEFAULT_COLUMNS,
                date_formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(good rows, bad rows, bad files)`` of a few CSV files, whose headers may differ."""
    groups: dict[tuple[str, ...], list[str]] = {}
    bad: list[tuple[str, str]] = []
    for path in paths:
        header = tuple(spark.read.option("header", True).csv(path).columns)  # reads the first line
        missing = [c for c in types if c not in header]
        if not header:
            bad.append((path, "no header"))
        elif missing:
            bad.append((path, "columns not in the header: " + ", ".join(missing)))
        else:
            groups.setdefault(header, []).append(path)
    schema = ", ".join(f"`{c}` {t}" for c, t in types.items())
    good, rows = spark.createDataFrame([], schema.replace("timestamp", "timestamp_ntz")), spark.createDataFrame([], BAD_ROWS)
    for header, files in groups.items():
        text = ", ".join(f"`{c}` string" for c in (*header, _TEXT))
        raw = (
            spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _TEXT)
            .option("enforceSchema", True).option("columnPruning", False)  # a row's cells are counted only if all are parsed
            .csv(files).withColumn(_FILE, F.col("_metadata.file_path"))
        )
        cells = without_tokens(raw, (_TEXT, _FILE))
        wrong = F.array_compact(F.array(*[F.when(unparsed(c, t, cols, date_formats), F.lit(c)) for c, t in types.items()]))
        marked = cells.withColumn("__wrong", F.when(F.col(_TEXT).isNotNull(), F.array(F.lit("*"))).otherwise(wrong))
        fine = F.size("__wrong") == 0
        good = good.unionByName(marked.filter(fine).select(*[typed(c, t, cols, date_formats).alias(c) for c, t in types.items()]))
        record = F.coalesce(F.col(_TEXT), F.to_json(F.struct(*[F.col(f"`{c}`") for c in header])))
        rows = rows.unionByName(marked.filter(~fine).select(F.col(_FILE).alias("file"), record.alias("record"), F.col("__wrong").alias("columns")))
    return good, rows, spark.createDataFrame(bad, BAD_FILES)


def stream_csv(spark: SparkSession, landing: str, types: Mapping[str, str], process: Callable[[DataFrame, int], None], side_dir: str, checkpoint: str,
               files_per_trigger: int = 8, cols: Columns = DEFAULT_COLUMNS, date_formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> None:
    """Hand every landed file's good rows to ``process``, oldest files first, until none is left."""

    def each(names: DataFrame, epoch: int) -> None:
        paths = [r[0] for r in names.orderBy("modificationTime", "path").select("path").collect()]  # at most files_per_trigger
        good, rows, files = parse_files(spark, paths, types, cols, date_formats)
        rows.write.mode("overwrite").parquet(f"{side_dir}/bad_rows/epoch={epoch}")
        files.write.mode("overwrite").parquet(f"{side_dir}/bad_files/epoch={epoch}")
        process(good, epoch)

    names = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger).load(landing).select("path", "modificationTime")
    )
    run_to_end(names, each, checkpoint)
