"""Mix sources to target weights with hash-threshold histograms.

Every source has a target number of words. A document is taken a whole number
of times, ``floor(target / source size)``, and once more if its hash lies
below the source's threshold. The threshold comes from histograms: words are
summed by source and hash bucket, the bucket in which the remaining budget is
used up is found, and only that bucket is split further (12 bits a level, 60
bits in all). No rows are sorted, and each level reads about 1/4096 of the
rows of the level before. The documents below the threshold are the longest
run in hash order whose words fit the budget.

Identical rows (same ``doc_id``, text and source) share their hash; at a
threshold that falls among them as many are taken as fit, chosen by a second
hash of the row number.

Targets: weights 5, 2, 1 repeating over the sources in code point order (null
last) share all words; a target stops at three times its source and the excess
is shared again by weight until none is above (a few rounds of one-row sums).

Defined results: null or empty text has the size 0 and takes nothing; null is
a source of its own; an empty table gives no rows; extra columns are kept, an
input column named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, written
from tidemark.plans.positions import global_positions

WEIGHTS = (5, 2, 1)
MOST = 3
BITS, LEVEL = 60, 12


def word_count(text: str = "text") -> Column:
    """Number of runs of characters other than U+0020 and U+0009 to U+000D (null: 0)."""
    flat = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " "))
    gaps = F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" ")))
    return F.when(flat == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def mix_key() -> Column:
    """60 bits of the MD5 of ``doc_id`` and the text's MD5."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def _source_name() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """One row for each source in ``sized(source, __src, __size)``: ``__src``, ``source_size``, ``target``."""
    by = sized.groupBy("__src", "source").agg(F.sum("__size").alias("source_size"))
    by = global_positions(by, [F.col("source").asc_nulls_last()], "__nth")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__nth") % len(weights) + 1).cast("int"))
    by = written(by.select("__src", "source_size", weight.alias("__w")), "sources")
    row = by.agg(F.sum("source_size"), F.sum("__w")).first()
    total, weight_all = row[0] or 0, row[1] or 1.0
    share, above = total / weight_all, -1
    while True:  # the set of sources above their limit only grows
        over = F.col("__w") * share > most * F.col("source_size")
        row = by.filter(over).agg(F.count("*"), F.sum(most * F.col("source_size")), F.sum("__w")).first()
        if row[0] == above:
            break
        above = row[0]
        share = (total - (row[1] or 0)) / (weight_all - (row[2] or 0.0)) if above else share
    limit = (most * F.col("source_size")).cast("double")
    return by.select("__src", "source_size", F.least(F.col("__w") * share, limit).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """For ``rows(__src, __size, __key)`` and ``budgets(__src, __left)``: ``__src``, ``__upto``, ``__tied``, ``__left``.

    Rows with ``__key < __upto`` are the longest run in key order whose sizes
    sum to at most the budget. ``__tied``: several rows hold the key
    ``__upto`` itself, and ``__left`` of the budget remains for them."""
    state = budgets.select("__src", F.lit(0).cast("long").alias("__prefix"), F.col("__left").cast("long").alias("__left"))
    settled, shift = None, BITS
    state = written(state, "mix")
    while True:
        shift -= LEVEL
        at = rows.join(state, "__src").filter(F.shiftright("__key", shift + LEVEL) == F.col("__prefix"))
        bucket = F.shiftright("__key", shift).bitwiseAND((1 << LEVEL) - 1)
        histogram = at.groupBy("__src", bucket.alias("__b")).agg(F.sum("__size").alias("__sum"), F.count("*").alias("__n"))
        order = Window.partitionBy("__src").orderBy("__b")  # at most 4096 buckets for each source
        ends = histogram.withColumn("__end", F.sum("__sum").over(order)).join(state, "__src").filter("__end > __left")
        first = ends.groupBy("__src").agg(F.min(F.struct("__b", "__end", "__sum", "__n", "__prefix", "__left")).alias("x"))
        cut = first.select("__src", F.shiftleft("x.__prefix", LEVEL).bitwiseOR(F.col("x.__b")).alias("__prefix"), (F.col("x.__left") - F.col("x.__end") + F.col("x.__sum")).alias("__left"), F.col("x.__n").alias("__n"))
        cut = written(cut, "mix")
        done = cut if shift == 0 else cut.filter("__n = 1")
        part = done.select("__src", F.shiftleft("__prefix", shift).alias("__upto"), (F.col("__n") > 1).alias("__tied"), "__left")
        settled = part if settled is None else settled.unionByName(part)
        forget(state)
        state = cut.filter("__n > 1").select("__src", "__prefix", "__left")
        if shift == 0 or state.isEmpty():
            return written(settled, "mix")


def plan(df: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> tuple[DataFrame, DataFrame]:
    """``(rows, cuts)``: the sized rows (no texts) and one row for each source with its target and thresholds."""
    rows = df.select("doc_id", "source", _source_name().alias("__src"), word_count().alias("__size"), mix_key().alias("__key"), F.monotonically_increasing_id().alias("__row"))
    rows = written(rows, "sized")
    goal = targets(rows, weights, most)
    whole = F.when(F.col("source_size") == 0, 0).when(F.col("target") >= most * F.col("source_size"), most).otherwise(F.floor(F.col("target") / F.col("source_size")))
    goal = goal.withColumn("__whole", whole.cast("long"))
    goal = written(goal.withColumn("__left", F.floor(F.col("target") - F.col("__whole") * F.col("source_size")).cast("long")), "targets")
    counted = rows.filter("__size > 0").select("__src", "__size", "__key", "__row")
    first = thresholds(counted, goal.select("__src", "__left"))
    tied = first.filter("__tied").select("__src", F.col("__upto").alias("__tie"), "__left")
    cuts = goal.drop("__left").join(first.select("__src", "__upto", "__tied"), "__src", "left")
    if tied.isEmpty():
        return rows, written(cuts.withColumn("__upto2", F.lit(0).cast("long")), "cuts")
    same = counted.join(tied, "__src").filter("__key = __tie").select("__src", "__size", _row_key().alias("__key"))
    second = thresholds(written(same, "tied"), tied.select("__src", "__left"))
    return rows, written(cuts.join(second.select("__src", F.col("__upto").alias("__upto2")), "__src", "left"), "cuts")


def _row_key() -> Column:
    return F.shiftrightunsigned(F.xxhash64("__row"), 64 - BITS)


def _times() -> Column:
    """How often a row is taken: whole passes, and one more below the threshold (no threshold: its budget takes all)."""
    tie = (F.col("__key") == F.col("__upto")) & F.coalesce(F.col("__tied"), F.lit(False)) & (F.col("__upto2").isNull() | (_row_key() < F.col("__upto2")))
    more = F.col("__upto").isNull() | (F.col("__key") < F.col("__upto")) | tie
    return F.when(F.col("__size") == 0, F.lit(0)).otherwise(F.least(F.col("__whole") + F.when(more, 1).otherwise(0), F.lit(MOST))).cast("long")


def mix_digest(df: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """doc_id, size, source_size, target (of the row's source) and taken (words the mix takes, repeats counted)."""
    rows, cuts = plan(df, weights, most)
    joined = rows.join(cuts, "__src")
    return joined.select("doc_id", F.col("__size").alias("size"), "source_size", "target", (F.col("__size") * _times()).alias("taken"))


def mix(df: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The mixed rows: every row of ``df`` as often as the mix takes it. Texts aren't shuffled; decisions come from the thresholds."""
    _, cuts = plan(df, weights, most)
    keyed = df.withColumns({"__src": _source_name(), "__size": word_count(), "__key": mix_key(), "__row": F.monotonically_increasing_id()})
    taken = keyed.join(cuts.select("__src", "__whole", "__upto", "__tied", "__upto2"), "__src").withColumn("__times", _times()).filter("__times > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*df.columns)


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k,
    coalesce(sum(w) OVER e, 0) AS w0, coalesce(sum({MOST} * source_size) OVER e, 0) AS c0,
    (SELECT sum(w) FROM s) AS wt, (SELECT sum(source_size) FROM s) AS st
  FROM s WINDOW e AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT CAST(st - c0 AS DOUBLE) / (wt - w0) AS share FROM r WHERE NOT w * (CAST(st - c0 AS DOUBLE) / (wt - w0)) > {MOST} * source_size ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size, least(w * coalesce((SELECT share FROM l), 0), CAST({MOST} * source_size AS DOUBLE)) AS target FROM s),
b AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 WHEN target >= {MOST} * source_size THEN {MOST} ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole FROM t),
o AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, floor(b.target - b.whole * b.source_size) AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN upto <= budget THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM o
"""
