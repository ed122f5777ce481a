"""Shared helpers of the training-data operators: scratch tables in the shared folder, batches, row keys.

Identity of a document row: ``(doc_id, xxhash64(text))``. Rows that agree in
both are the same document given more than once; rows that share only a
``doc_id`` are different documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import discard, materialize

def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the folder named in ``spark.checkpoint.dir`` and read it back."""
    return materialize(df, f"llm-{name}")


#: Delete the folders behind written frames that nothing reads any more.
forget = discard


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_key(col: str | Column = "text") -> Column:
    """64-bit key of a whole text (null and empty text share the key of the empty text)."""
    return F.xxhash64(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")))


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches into slices of about ``limit`` characters (one row at least), with the texts as Python strings.

    Keeps the memory of a task bounded by its longest text, not by the batch."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = [0 if v is None else v for v in pc.binary_length(column).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                part = batch.slice(start, i - start)
                yield part, column.slice(start, i - start).to_pylist()
                start, held = i, 0
            held += n
        if len(sizes) > start:
            part = batch.slice(start, len(sizes) - start)
            yield part, column.slice(start, len(sizes) - start).to_pylist()


def arrow(schema: str, columns: dict) -> pa.RecordBatch:
    """A record batch whose columns follow a short schema text such as ``doc_id long, text string``."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
        "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
        "array<float>": pa.list_(pa.float32()), "array<double>": pa.list_(pa.float64()),
    }
    names, arrays = [], []
    for part in schema.split(","):
        name, kind = part.split()
        names.append(name)
        arrays.append(columns[name] if isinstance(columns[name], pa.Array) else pa.array(columns[name], kinds[kind]))
    return pa.RecordBatch.from_arrays(arrays, names)
