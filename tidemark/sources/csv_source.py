"""The transaction CSV source with pandas-compatible missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns
from tidemark.functions.exprs import DEFAULT_DATE_FORMATS, MISSING_TOKENS, parse_mixed_timestamp


class UnparsedDatesError(ValueError):
    pass


class UnparsedValuesError(ValueError):
    pass


def read_transactions_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str],
    cols: Columns = DEFAULT_COLUMNS,
    date_formats: Sequence[str] = DEFAULT_DATE_FORMATS,
    check: bool = True,
) -> DataFrame:
    """Read header CSV files as text, NULL the missing tokens, then cast.

    Columns are found by their header name; ``types`` maps column -> Spark SQL
    type (``double``, ``int``, ``string``...) and gives the order, a missing column
    raises, and files with different headers raise. Further columns follow in
    file order with an inferred type (``bigint``, ``double`` or ``string``: the
    narrowest that fits every value). The time column is parsed per value with
    ``date_formats``. Reading as text first keeps ``NaN``/``NA`` handling identical
    for every type. With ``check`` a value that fits no date layout, or isn't of
    its column's type, raises; checks and inference are one distributed
    aggregate.
    """
    raw = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    missing = [c for c in types if c not in raw.columns]
    if missing:
        raise ValueError(f"columns not in the header: {', '.join(missing)}")
    text = without_tokens(raw)
    more = [c for c in raw.columns if c not in types]

    def lost(c: str, kind: str):
        return F.count_if(unparsed(c, kind, cols, date_formats))

    tests = [lost(c, t).alias(f"bad_{i}") for i, (c, t) in enumerate(types.items())] if check else []
    tests += [lost(c, t).alias(f"{t}_{i}") for i, c in enumerate(more) for t in ("bigint", "double")]
    found = text.agg(*tests).first().asDict() if tests else {}
    for i, c in enumerate(types):
        if found.get(f"bad_{i}"):
            kind = UnparsedDatesError if c == cols.time else UnparsedValuesError
            raise kind(f"{found[f'bad_{i}']} values of {c} are not of type {types[c]}")
    kinds = dict(types) | {c: next((t for t in ("bigint", "double") if not found[f"{t}_{i}"]), "string") for i, c in enumerate(more)}
    return text.select(*[typed(c, t, cols, date_formats).alias(c) for c, t in kinds.items()])


def without_tokens(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns with the missing-value tokens as NULL (but those in ``keep``)."""
    tokens = F.array(*[F.lit(t) for t in MISSING_TOKENS])
    return raw.select(*[F.col(c) if c in keep else F.when(F.array_contains(tokens, F.trim(F.col(c))), F.lit(None)).otherwise(F.col(c)).alias(c) for c in raw.columns])


def typed(c: str, kind: str, cols: Columns = DEFAULT_COLUMNS, date_formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """A text column as its type; NULL where a value isn't of it."""
    if c == cols.time:
        return parse_mixed_timestamp(F.col(c), date_formats)
    return F.col(c) if kind == "string" else F.trim(F.col(c)).try_cast(kind)


def unparsed(c: str, kind: str, cols: Columns = DEFAULT_COLUMNS, date_formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """True where a column has a value that isn't of its type."""
    return F.col(c).isNotNull() & typed(c, kind, cols, date_formats).isNull()
