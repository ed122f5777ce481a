"""Baskets, frequent itemsets and association rules for every batch.

Itemsets are mined level by level. Every itemset carries the set of its rows as
a bit array over the rows of its batch (64 rows in a ``long``), so its support is
a bit count. An itemset of size k joins two frequent ones of size k - 1 that
share their first k - 2 items, and its rows are the AND of theirs: nothing is
counted that is not made of frequent parts, baskets are read once, and there is
no limit on the width of a basket.

Spark groups the rows by batch; a task takes one batch after another and does the
bit and look-up steps on all itemsets of a level at once in Arrow and numpy.

Supports, confidence and lift use the same float formulas as the common
Python implementation (support = count / n, confidence = s(AC) / s(A),
lift = confidence / s(C)), so threshold tests agree bit for bit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns
from tidemark.plans.positions import group_medians
from tidemark.session import discard, materialize


@dataclass(frozen=True)
class RuleParams:
    # Default mining parameters.
    min_support: float = 0.05
    min_confidence: float = 0.3
    min_lift: float = 1.0
    n_rules: int = 10
    n_target_rules: int = 5


# Item names of the median splits and the label.
AMOUNT_HIGH, AMOUNT_LOW = "Amount_high", "Amount_low"
BALANCE_HIGH, BALANCE_LOW = "Balance_high", "Balance_low"


def target_item(cols: Columns = DEFAULT_COLUMNS, value: int = 1) -> str:
    return f"{cols.target}={value}"


def baskets(df: DataFrame, cols: Columns = DEFAULT_COLUMNS, bounded: bool = True) -> DataFrame:
    """A1-A3: ``items`` (sorted array<string>) per row, with batch and row ids.

    ``bounded``: a batch fits into one task, as batches do. Otherwise (a whole table as one batch) its
    medians are taken from the range-partitioned order of all rows."""
    present = [c for c in cols.basket_columns if c in df.columns]
    items: list[Column] = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in present
    ]
    med_cols = [(cols.amount, AMOUNT_HIGH, AMOUNT_LOW), (cols.balance, BALANCE_HIGH, BALANCE_LOW)]
    med_cols = [m for m in med_cols if m[0] in df.columns]
    base = df
    if med_cols:
        if bounded:
            meds = df.groupBy(cols.batch).agg(*[F.median(c).alias(f"__med{i}") for i, (c, _, _) in enumerate(med_cols)])
        else:
            meds = df.select(cols.batch).distinct()
            for i, (c, _, _) in enumerate(med_cols):
                meds = meds.join(group_medians(df, [cols.batch], c, f"__med{i}"), cols.batch, "left")
        base = df.join(meds if bounded else F.broadcast(meds), cols.batch)  # a row for each batch
        for i, (c, hi, lo) in enumerate(med_cols):
            m = F.col(f"__med{i}")
            items.append(F.when(F.col(c) > m, F.lit(hi)).when(F.col(c) <= m, F.lit(lo)))
    if cols.target in df.columns:
        t = F.col(cols.target)
        items.append(F.when(t == 1, F.lit(target_item(cols, 1))).when(t == 0, F.lit(target_item(cols, 0))))
    return base.select(cols.batch, cols.row, F.array_sort(F.array_compact(F.array(*items))).alias("items"))


def _coded(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(names, codes, sizes)`` of an array of lists: the distinct items in order, each item's place among them, each list's length."""
    found = lists.flatten().dictionary_encode()
    names = found.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    code = np.empty(len(names), np.int64)
    code[order] = np.arange(len(names))
    return pa.array([names[i] for i in order], pa.string()), code[found.indices.to_numpy(zero_copy_only=False)], lists.value_lengths().fill_null(0).to_numpy()


def _lists(names: pa.Array, codes: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Lists of names of the sizes given, their codes one after the other."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), names.take(pa.array(codes)))


#: Words of 64 rows that are ANDed at a time: 64 MB.
_CHUNK_WORDS = 1 << 23
#: Ways to split an itemset, and splits in all, that are looked up at a time.
_SPLITS, _CHUNK_SPLITS = 1 << 12, 1 << 18


def frequent_itemsets(bk: DataFrame, params: RuleParams = RuleParams(), cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """A4: (batch_index, itemset, count, support) with support >= min_support, mined level by level.

    Each batch is one group: at most batch_size rows. ``frequent_itemsets_blocked`` takes batches of any size."""
    least = params.min_support

    def mine(key: tuple, table: pa.Table) -> pa.Table:
        names, codes, sizes = _coded(table["items"].combine_chunks())
        _, at = np.unique(table["row"].to_numpy(), return_inverse=True)
        has = np.zeros((len(names), -(-(at.max() + 1) // 64) * 64), bool)
        has[codes, np.repeat(at, sizes)] = True
        bits = np.packbits(has, axis=1).view(np.uint64)

        def frequent(sets: np.ndarray, bits: np.ndarray) -> tuple:
            count = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
            keep = count / table.num_rows >= least
            return sets[keep], bits[keep], count[keep]

        out = []
        sets, bits, count = frequent(np.arange(len(names))[:, None], bits)
        while len(sets):
            n, k = sets.shape
            one = pa.array(np.full(n, key[0].as_py()), schema.types[0])
            out.append(pa.Table.from_arrays([one, _lists(names, sets.ravel(), np.full(n, k)), pa.array(count), pa.array(count / table.num_rows)], [cols.batch, "itemset", "count", "support"]))
            # the sets are in order: those that share a head follow one another, and each joins those after it
            first = np.concatenate([[True], (sets[1:, :-1] != sets[:-1, :-1]).any(axis=1)])
            end = np.append(np.flatnonzero(first), n)[np.cumsum(first)]
            after = end - np.arange(n) - 1
            upto = np.cumsum(after)
            parts, lo = [], 0
            while lo < n:
                hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - after[lo] + _CHUNK_WORDS // bits.shape[1], "right")))
                left = np.repeat(np.arange(lo, hi), after[lo:hi])
                right = left + 1 + np.arange(len(left)) - np.repeat(upto[lo:hi] - after[lo:hi] - (upto[lo] - after[lo]), after[lo:hi])
                parts.append(frequent(np.column_stack([sets[left], sets[right, -1]]), bits[left] & bits[right]))
                lo = hi
            sets, bits, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.concat_tables(out) if out else schema.empty_table()

    kind = bk.schema[cols.batch].dataType.simpleString()
    schema = pa.schema([(cols.batch, pa.int64() if kind == "bigint" else pa.int32()), ("itemset", pa.list_(pa.string())), ("count", pa.int64()), ("support", pa.float64())])
    rows = bk.filter(F.col(cols.batch).isNotNull()).select(F.col(cols.batch).alias("batch"), F.col(cols.row).alias("row"), "items")
    return rows.groupBy("batch").applyInArrow(mine, f"`{cols.batch}` {kind}, itemset array<string>, count long, support double")


#: Rows in a block of ``frequent_itemsets_blocked``: 512 words of 64 rows, 4 KB.
BLOCK_ROWS = 1 << 15


def _blocks(bk: DataFrame, cols: Columns, block_rows: int) -> DataFrame:
    """(batch, itemset of one item, block, rows): the rows of every item in each block of ``block_rows`` row numbers, as a bit array."""
    at = F.pmod(F.col(cols.row), F.lit(block_rows))
    single = bk.select(cols.batch, F.expr(f"CAST(`{cols.row}` DIV {block_rows} AS BIGINT)").alias("block"),
                       F.expr(f"CAST(pmod(`{cols.row}`, {block_rows}) DIV 64 AS INT)").alias("word"), (at % 64).cast("int").alias("bit"), F.explode("items").alias("item"))
    words = single.groupBy(cols.batch, "item", "block", "word").agg(F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), bit)")).alias("bits"))
    found = words.groupBy(cols.batch, "item", "block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))  # a block's words at most
    line = F.transform(F.sequence(F.lit(0), F.lit(block_rows // 64 - 1)), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long")))
    return found.select(cols.batch, F.array("item").alias("itemset"), "block", line.alias("rows"))


def frequent_itemsets_blocked(bk: DataFrame, params: RuleParams = RuleParams(), cols: Columns = DEFAULT_COLUMNS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A4 where a batch is of any size, a whole table for instance: the same itemsets, counts and supports.

    The rows of an itemset are cut into blocks of bits, keyed (itemset, block), so no array spans the table and
    an item that nearly every row has is spread over all tasks. Candidates are made from the frequent itemsets alone; their
    blocks are ANDed block by block, empty ones go, and counts are summed over blocks."""
    total = materialize(bk.groupBy(cols.batch).agg(F.count(F.lit(1)).alias("__n")), "baskets")
    bits = F.aggregate("rows", F.lit(0).cast("long"), lambda acc, x: acc + F.bit_count(x).cast("long"))
    blocks = materialize(_blocks(bk, cols, block_rows).withColumn("count", bits), "itemset-blocks")
    out = None
    while True:
        counted = blocks.groupBy(cols.batch, "itemset").agg(F.sum("count").alias("count")).join(total, cols.batch)
        counted = counted.withColumn("support", F.col("count") / F.col("__n")).filter(F.col("support") >= F.lit(params.min_support)).drop("__n")
        level = materialize(counted, "itemsets")
        if level.isEmpty():
            discard(level, blocks)
            break
        out = level if out is None else out.unionByName(level)
        head, last = F.slice("itemset", F.lit(1), F.size("itemset") - 1), F.element_at("itemset", -1)
        left = level.select(cols.batch, head.alias("__head"), F.col("itemset").alias("__a"), last.alias("__x"))
        right = level.select(cols.batch, head.alias("__head"), F.col("itemset").alias("__b"), last.alias("__y"))
        pairs = left.join(right, [cols.batch, "__head"]).filter(F.col("__x") < F.col("__y"))
        pairs = pairs.select(cols.batch, "__a", "__b", F.concat("__a", F.array("__y")).alias("__ab"))
        a = blocks.select(cols.batch, F.col("itemset").alias("__a"), "block", F.col("rows").alias("__ra"))
        b = blocks.select(cols.batch, F.col("itemset").alias("__b"), "block", F.col("rows").alias("__rb"))
        both = a.join(pairs, [cols.batch, "__a"]).join(b, [cols.batch, "__b", "block"])
        anded = both.select(cols.batch, F.col("__ab").alias("itemset"), "block", F.zip_with("__ra", "__rb", lambda x, y: x.bitwiseAND(y)).alias("rows"))
        more = materialize(anded.withColumn("count", bits).filter("count > 0"), "itemset-blocks")
        discard(blocks)
        blocks = more
    if out is None:
        return bk.sparkSession.createDataFrame([], f"{cols.batch} int, itemset array<string>, count long, support double")
    return out.select(cols.batch, "itemset", "count", "support")


def frequent_itemsets_fpgrowth(bk: DataFrame, batch_index: int, params: RuleParams = RuleParams(), cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """A4 for one (possibly very wide) batch with MLlib FP-growth."""
    from pyspark.ml.fpm import FPGrowth

    one = bk.filter(F.col(cols.batch) == batch_index).select("items")
    n = one.count()
    if n == 0:
        return bk.sparkSession.createDataFrame([], f"{cols.batch} int, itemset array<string>, count long, support double")
    model = FPGrowth(itemsCol="items", minSupport=params.min_support * (1 - 1e-9)).fit(one)
    return model.freqItemsets.select(
        F.lit(batch_index).cast("int").alias(cols.batch),
        F.array_sort("items").alias("itemset"),
        F.col("freq").cast("long").alias("count"),
        (F.col("freq") / F.lit(float(n))).alias("support"),
    ).filter(F.col("support") >= F.lit(params.min_support))


def association_rules(itemsets: DataFrame, params: RuleParams = RuleParams(), cols: Columns = DEFAULT_COLUMNS, holding: str | None = None) -> DataFrame:
    """Every split of every itemset of size >= 2 into antecedent and
    consequent (both non-empty), confidence >= min_confidence, lift >= min_lift.

    ``holding``: only the rules whose consequent holds this item. An itemset is a number with one bit for each item of
    its batch, so a part is found among the batch's itemsets by number."""
    min_confidence, min_lift = params.min_confidence, params.min_lift

    def split(key: tuple, table: pa.Table) -> pa.Table:
        names, codes, sizes = _coded(table["itemset"].combine_chunks())
        support, start = table["support"].to_numpy(), np.cumsum(sizes) - sizes
        bit = np.array([1 << i for i in range(len(names))], np.int64 if len(names) < 63 else object)  # of any number of items
        number = np.bitwise_or.reduceat(bit[codes], start)
        order = np.argsort(number)
        known, known_support = number[order], support[order]

        def supports(part: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(known, part), len(known) - 1)
            return np.where((known[at] == part).astype(bool), known_support[at], np.nan)

        wanted = number.copy()
        if holding is not None:
            wanted = number & (1 << names.to_pylist().index(holding) if holding in names.to_pylist() else 0)
        out = []
        for k in np.unique(sizes[sizes > 1]).tolist():
            here, most = np.flatnonzero((sizes == k) & (wanted != 0).astype(bool)), (1 << k) - 1
            for first in range(1, most, _SPLITS) if len(here) else ():
                masks = np.arange(first, min(first + _SPLITS, most))
                chosen = (masks[:, None] >> np.arange(k) & 1).astype(bool)
                step = max(1, _CHUNK_SPLITS // len(masks))
                for some in (here[i:i + step] for i in range(0, len(here), step)):
                    items = np.sort(codes[start[some][:, None] + np.arange(k)], axis=1)
                    parts = bit[items] @ chosen.T.astype(bit.dtype)  # sums of different bits
                    at, by = np.nonzero(((wanted[some][:, None] & ~parts) != 0).astype(bool))
                    ante, s = parts[at, by], support[some[at]]
                    sa = supports(ante)
                    sure = s / sa >= min_confidence
                    at, by, ante, s, sa = at[sure], by[sure], ante[sure], s[sure], sa[sure]
                    sc = supports(number[some[at]] ^ ante)
                    lifts = s / sa / sc >= min_lift
                    at, by, s, sa, sc = at[lifts], by[lifts], s[lifts], sa[lifts], sc[lifts]
                    one = pa.array(np.full(len(at), key[0].as_py()), schema.types[0])
                    texts = [_lists(names, items[at][x], x.sum(axis=1)) for x in (chosen[by], ~chosen[by])]
                    out.append(pa.Table.from_arrays([one, *texts, *map(pa.array, (sa, sc, s, s / sa, s / sa / sc))], schema.names))
        return pa.concat_tables(out) if out else schema.empty_table()

    kind = itemsets.schema[cols.batch].dataType.simpleString()
    lists, numbers = ("antecedents", "consequents"), ("antecedent_support", "consequent_support", "support", "confidence", "lift")
    schema = pa.schema([(cols.batch, pa.int64() if kind == "bigint" else pa.int32()), *[(c, pa.list_(pa.string())) for c in lists], *[(c, pa.float64()) for c in numbers]])
    rows = itemsets.filter(F.col(cols.batch).isNotNull()).select(F.col(cols.batch).alias("batch"), "itemset", "support")
    return rows.groupBy("batch").applyInArrow(split, f"`{cols.batch}` {kind}, " + ", ".join([f"{c} array<string>" for c in lists] + [f"{c} double" for c in numbers]))


def _rank_order():
    return [
        F.desc("lift"), F.desc("support"),
        F.asc(F.array_join("antecedents", ", ")), F.asc(F.array_join("consequents", ", ")),
    ]


def top_rules(rules: DataFrame, k: int = 10, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The first k rules per batch by lift (ties: support, then names)."""
    w = Window.partitionBy(cols.batch).orderBy(*_rank_order())
    return rules.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def target_rules(rules: DataFrame, k: int = 5, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rules whose consequent holds the positive label, first k per batch."""
    hit = rules.filter(F.array_contains("consequents", target_item(cols, 1)))
    return top_rules(hit, k, cols)


def as_text(rules: DataFrame, digits: int | None = 4) -> DataFrame:
    """Report form: item lists as ', '-joined text, scores rounded (None: exact)."""
    out = rules
    for c in ("antecedents", "consequents", "itemset", "items"):
        if c in out.columns:
            out = out.withColumn(c, F.array_join(c, ", "))
    for c in ("support", "confidence", "lift", "antecedent_support", "consequent_support"):
        if c in out.columns and digits is not None:
            out = out.withColumn(c, F.round(c, digits))
    return out
