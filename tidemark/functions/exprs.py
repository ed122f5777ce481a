"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Text tokens a CSV reader treats as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Date layouts tried in order; month-first wins for ambiguous day/month text.
# One pattern letter accepts one or two digits; the zoned ones end in an offset or Z.
DEFAULT_DATE_FORMATS = (
    "yyyy-M-d H:m:s.SSSSSS",
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s.SSSSSS",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d'T'H:m",
    "yyyy-M-d H:m",
    "yyyy-M-d",
    "yyyy/M/d H:m:s",
    "yyyy/M/d",
    "M-d-yyyy H:m:s",
    "M-d-yyyy",
    "d-M-yyyy H:m:s",
    "d-M-yyyy",
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy",
    "d/M/yyyy H:m:s",
    "d/M/yyyy H:m",
    "d/M/yyyy",
    "MMM d, yyyy H:m:s",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy H:m:s",
    "d MMM yyyy",
    "d MMMM yyyy",
    "d-MMM-yyyy",
    "yyyy-M-d'T'H:m:s.SSSSSSXXX",
    "yyyy-M-d'T'H:m:sXXX",
    "yyyy-M-d H:m:sXXX",
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL every NaN in floating columns (Spark orders NaN above all numbers)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def layout_shapes(layout: str) -> list[str]:
    """Shapes (see ``text_shape``) of the texts that a layout can fit; several if it ends in an offset."""
    out = [""]
    for part in re.finditer(r"'[^']*'|([A-Za-z])\1*|.", layout):
        text, letter = part.group(0), part.group(0)[0]
        if text.startswith("'"):
            more = [re.sub("[A-Za-z]+", "a", text[1:-1])]
        elif letter == "X":
            more = ["a", "+9:9", "-9:9"]
        elif letter == "S":
            more = ["f"]
        elif text in ("MMM", "MMMM"):
            more = ["a"]
        elif text == "yyyy":
            more = ["y"]
        else:
            more = ["9"] if letter.isalpha() else [text]
        out = [o + m for o in out for m in more]
    return out


def text_shape(c: Column) -> Column:
    """A date text with its parts masked: ``y`` four digits, ``9`` another run of digits, ``.f`` a fraction, ``a`` letters."""
    for pattern, mark in (("[A-Za-z]+", "a"), (r"\.[0-9]+", ".f"), ("(?<![0-9])[0-9]{4}(?![0-9])", "y"), ("[0-9]+", "9")):
        c = F.regexp_replace(c, pattern, mark)
    return c


def _parsed(c: Column, fmt: str) -> Column:
    at = F.try_to_timestamp(c, F.lit(fmt))
    if fmt.endswith("X"):
        at = F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))
    return at.cast("timestamp_ntz")


def parse_mixed_timestamp(col: Column | str, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Parse text whose layout varies per value: the first layout that fits wins.

    A cell's shape is taken once and only the layouts of that shape are tried (one or two
    of them); a text of no known shape is tried with all. Layouts with a zone
    give the UTC wall time, whatever the session's zone."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    by_shape: dict[str, list[str]] = {}
    for fmt in formats:
        for s in layout_shapes(fmt):
            by_shape.setdefault(s, []).append(fmt)
    shape, out = text_shape(c), None
    for s, layouts in by_shape.items():
        value = F.coalesce(*[_parsed(c, x) for x in layouts])
        out = F.when(shape == s, value) if out is None else out.when(shape == s, value)
    every = F.coalesce(*[_parsed(c, x) for x in formats])
    return every if out is None else out.otherwise(every)


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    """(num / den) * 100 in that order (the order decides exact-boundary tests);
    NULL on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double")) * F.lit(100.0)
