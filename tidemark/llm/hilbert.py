"""Approximate nearest neighbours along shifted Hilbert curves.

Every vector is projected onto a few random directions, several times with
other directions and another random shift, and gets its key on a Hilbert curve
through each projected space. The keys of each curve are put in one global
order by range partitioning, which gives every vector a rank. Near vectors
tend to have near ranks on at least one curve: a query looks at the ranks
within a window around its own on every curve, the windows' rows are compared
in blocks, and the union of what the curves find is ranked by exact distance.

The window is fitted, not guessed: for a bounded sample of queries
(``SAMPLE``, by hash) the true neighbours are found by comparison with all
rows, and the window is the rank distance that covers ``COVER`` of their best
curves. So recall follows the data: on vectors without structure (all
directions alike) the window has to grow to a large part of the table.

Vectors that are equal are one item with its ``k + 1`` smallest ids (no query can
need more of them), chosen by a group limit before the shuffle, so copies
neither crowd a window nor meet in one task.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part; vectors of different length have no
distance, so each length is searched among its own; ties go to the smaller id; rows that repeat an id count once; with
fewer than ``k`` candidates all found are returned; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, written
from tidemark.plans.positions import global_positions

K = 10
EVERY = 100
CURVES, DIMS, BITS = 8, 8, 7
SAMPLE, COVER = 64, 0.97
BLOCK = 2048
SPREAD = 3.0  # projected coordinates beyond so many standard deviations share the outermost cell


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points, rows of ``cells`` with coordinates below ``2**bits``.

    Works bit by bit on all points at once: each level exchanges or inverts the
    lower bits of the axes, then the Gray code is undone and the bits interleaved."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            on = (x[i] >> level) & 1
            swap = (x[0] ^ x[i]) & low & -(1 - on)
            x[0] = x[0] ^ (low & -on) ^ swap
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= ((1 << level) - 1) & -((x[-1] >> level) & 1)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


def curves(dim: int, n: int = CURVES, dims: int = DIMS, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Orthonormal projections and shifts, fixed by the seed."""
    out, width = [], min(dims, dim)
    for i in range(n):
        rng = np.random.default_rng([seed, i])
        out.append((np.linalg.qr(rng.standard_normal((dim, width)))[0], rng.random(width)))
    return out


def valid_vectors(df: DataFrame) -> DataFrame:
    """``vec_id, vec`` (doubles), ``len`` of the rows that take part."""
    v = F.col("embedding")
    vec = v.cast("array<double>")
    good = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = df.filter(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter(good)
    # -0.0 and 0.0 are the same component
    return rows.withColumn("vec", F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))).withColumn("len", F.size("vec"))


def items_of(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: ``id`` (smallest vec_id), ``vec`` and ``members`` (their ``k + 1`` smallest ids)."""
    keyed = vectors.withColumn("h", F.xxhash64("vec")).withColumn("g", F.xxhash64(F.lit(3), "vec"))
    order = Window.partitionBy("h", "g").orderBy("vec_id")
    few = keyed.withColumn("n", F.dense_rank().over(order)).filter(F.col("n") <= k + 1)
    group = few.groupBy("h", "g").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_set("vec_id")).alias("members"), F.first("vec").alias("vec"))
    return group.select("id", "members", "vec")


def _moments(items: DataFrame, lines: list) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every projected coordinate, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                y = np.concatenate([x @ p for p, _ in lines], axis=1)
                own = np.concatenate([[float(len(x))], y.sum(0), (y * y).sum(0)])
                total = own if total is None else total + own
        if total is not None:
            yield arrow("at long, x double", {"at": np.arange(len(total)), "x": total})

    cells = {r[0]: r[1] for r in items.select("vec").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x")).collect()}
    m = sum(p.shape[1] for p, _ in lines)
    n = cells[0]
    mean = np.array([cells[1 + i] for i in range(m)]) / n
    square = np.array([cells[1 + m + i] for i in range(m)]) / n
    return mean, np.sqrt(np.maximum(square - mean * mean, 1e-18))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def curve_ranks(items: DataFrame, lines: list, bits: int = BITS) -> DataFrame:
    """``curve, id, rank``: rank of every item on every curve (0-based, in one order over all curves)."""
    mean, spread = _moments(items, lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, start = _matrix(batch.column(1)), 0
            for c, (p, shift) in enumerate(lines):
                if not len(x):
                    break
                at = slice(start, start + p.shape[1])
                start += p.shape[1]
                unit = np.clip((x @ p - mean[at]) / (2 * SPREAD * spread[at]) + 0.5, 0, 0.999999)
                keys = hilbert_keys(((unit + shift) / 2 * (1 << bits)).astype(np.int64), bits)
                yield arrow("curve int, key long, id long", {"curve": np.full(len(x), c, np.int32), "key": keys, "id": batch.column(0)})

    keys = items.select("id", "vec").mapInArrow(run, "curve int, key long, id long")
    ranked = written(global_positions(keys, [F.col("curve"), F.col("key"), F.col("id")], "at").drop("key"), "ranks")
    begin = ranked.groupBy("curve").agg(F.min("at").alias("begin"))  # one row for each curve
    return ranked.join(F.broadcast(begin), "curve").select("curve", "id", (F.col("at") - F.col("begin")).alias("rank"))


def _nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query row the positions of the ``k`` nearest rows of ``x`` and their distances (ties to smaller id)."""
    rough = (q * q).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * q @ x.T
    n = min(k, len(x))
    edge = np.partition(rough, n - 1, axis=1)[:, n - 1]
    at, near = [], []
    for i in range(len(q)):
        some = np.flatnonzero(rough[i] <= edge[i] + 1e-9 * (1 + abs(edge[i])))
        exact = np.sqrt(((x[some] - q[i]) ** 2).sum(1))
        best = np.lexsort((ids[some], exact))[:n]
        at.append(some[best])
        near.append(exact[best])
    return np.array(at), np.array(near)


def true_neighbours(items: DataFrame, sample: DataFrame, k: int) -> pd.DataFrame:
    """``q, id, d``: the nearest items of a bounded sample of items, by comparison with all items (one pass, top k in each task)."""
    rows = sample.select("id", "vec").toPandas()
    if not len(rows):
        return pd.DataFrame({"q": [], "id": [], "d": []})
    q_ids, q = rows["id"].to_numpy(), np.array(rows["vec"].tolist(), float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = _matrix(batch.column(1)), batch.column(0).to_numpy()
            if len(x):
                at, near = _nearest(q, x, ids, k + 1)
                yield arrow("q long, id long, d double", {"q": np.repeat(q_ids, at.shape[1]), "id": ids[at].ravel(), "d": near.ravel()})

    found = items.select("id", "vec").mapInArrow(run, "q long, id long, d double").filter("q <> id")
    best = Window.partitionBy("q").orderBy("d", "id")
    return found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).drop("n").toPandas()


def fit_window(items: DataFrame, ranks: DataFrame, queries: DataFrame, k: int) -> int:
    """Rank distance that covers ``COVER`` of the sampled queries' true neighbours on their best curve."""
    sample = items.join(queries.select("id").distinct().orderBy(F.xxhash64("id")).limit(SAMPLE), "id")
    truth = true_neighbours(items, sample, k)
    if not len(truth):
        return BLOCK
    ids = items.sparkSession.createDataFrame(pd.DataFrame({"id": pd.unique(truth[["q", "id"]].to_numpy().ravel()).astype("int64")}))
    at = ranks.join(F.broadcast(ids), "id").toPandas().pivot(index="id", columns="curve", values="rank")  # SAMPLE * (k + 1) rows at most
    apart = np.abs(at.loc[truth["q"]].to_numpy() - at.loc[truth["id"]].to_numpy()).min(1)
    return int(np.quantile(apart, COVER)) + 1


def search(df: DataFrame, queries: DataFrame, k: int = K, window: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``k`` rows found of ``df(vec_id, embedding)`` for each id in ``queries(vec_id)``."""
    vectors = valid_vectors(df)
    asked = queries.select(F.col("vec_id").cast("long").alias("query_id")).distinct()
    own = vectors.join(asked, vectors["vec_id"] == asked["query_id"], "left_semi")
    lengths = [r[0] for r in own.select("len").distinct().orderBy("len").collect()]  # a few in one table
    found = [_search(vectors.filter(F.col("len") == n).drop("len"), asked, n, k, window) for n in lengths]
    if not found:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out if len(found) == 1 else _best(out.drop("rank"), k)  # an id may have vectors of several lengths


def _search(vectors: DataFrame, asked: DataFrame, length: int, k: int, window: int | None) -> DataFrame:
    """The search among vectors of one length."""
    items = written(items_of(vectors, k), "items")
    # the item of each query, also of one that isn't among the smallest ids of its copies
    keys = items.select("id", F.xxhash64("vec").alias("h"), F.xxhash64(F.lit(3), "vec").alias("g"))
    own = vectors.join(asked, vectors["vec_id"] == asked["query_id"], "left_semi").select(F.col("vec_id").alias("query_id"), F.xxhash64("vec").alias("h"), F.xxhash64(F.lit(3), "vec").alias("g")).distinct()
    wanted = written(own.join(keys, ["h", "g"]).select("query_id", "id"), "queries")
    lines = curves(length)
    ranks = written(curve_ranks(items, lines), "ranks")
    reach = window or fit_window(items, ranks, wanted, k)
    return _ranked(_window_pairs(items, ranks, wanted, k, reach), items, wanted, k)


def _window_pairs(items: DataFrame, ranks: DataFrame, wanted: DataFrame, k: int, reach: int) -> DataFrame:
    """``q, id, d``: the ``k + 1`` nearest items within ``reach`` ranks of each query item, for each curve and block."""
    block = F.floor(F.col("rank") / BLOCK).cast("long")
    rows = ranks.join(items.select("id", "vec"), "id").select("curve", block.alias("block"), "rank", "id", "vec")
    asked = ranks.join(wanted.select("id").distinct(), "id").join(items.select("id", "vec"), "id")
    from_block, to_block = F.floor(F.greatest(F.col("rank") - reach, F.lit(0)) / BLOCK), F.floor((F.col("rank") + reach) / BLOCK)
    visits = asked.select(F.col("curve").alias("at_curve"), F.explode(F.sequence(from_block.cast("long"), to_block.cast("long"))).alias("at_block"), F.col("rank").alias("q_rank"), F.col("id").alias("q"), F.col("vec").alias("q_vec"))

    def compare(visit: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        if not len(visit) or not len(row):
            return pd.DataFrame({"q": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "d": np.zeros(0)})
        x, ids, rank = np.array(row["vec"].tolist(), float), row["id"].to_numpy(), row["rank"].to_numpy()
        order = np.argsort(rank)
        x, ids, rank = x[order], ids[order], rank[order]
        out: list[tuple] = []
        all_q, at_q, q_ids = np.array(visit["q_vec"].tolist(), float), visit["q_rank"].to_numpy(), visit["q"].to_numpy()
        low, high = np.searchsorted(rank, at_q - reach), np.searchsorted(rank, at_q + reach, "right")
        whole = (low == 0) & (high == len(rank))
        if whole.any():
            at, near = _nearest(all_q[whole], x, ids, k + 1)
            out.append((np.repeat(q_ids[whole], at.shape[1]), ids[at].ravel(), near.ravel()))
        for i in np.flatnonzero(~whole & (high > low)):
            at, near = _nearest(all_q[i : i + 1], x[low[i] : high[i]], ids[low[i] : high[i]], k + 1)
            out.append((np.full(at.shape[1], q_ids[i]), ids[low[i] : high[i]][at[0]], near[0]))
        if not out:
            return pd.DataFrame({"q": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "d": np.zeros(0)})
        return pd.DataFrame({"q": np.concatenate([o[0] for o in out]), "id": np.concatenate([o[1] for o in out]), "d": np.concatenate([o[2] for o in out])})

    # a block holds BLOCK rows and the visits of the queries within reach of it
    found = visits.groupBy("at_curve", "at_block").cogroup(rows.groupBy("curve", "block")).applyInPandas(compare, "q long, id long, d double")
    best = Window.partitionBy("q").orderBy("d", "id")
    return found.distinct().withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")


def _ranked(found: DataFrame, items: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Expand items to their members and keep each query's nearest ``k`` rows, its own row left out."""
    near = wanted.join(found, wanted["id"] == found["q"]).select("query_id", found["id"].alias("id"), "d")
    rows = near.join(items.select("id", F.explode("members").alias("vec_id")), "id").filter("vec_id <> query_id")
    return _best(rows.select("query_id", "vec_id", F.col("d").alias("score")), k)


def _best(rows: DataFrame, k: int) -> DataFrame:
    """Each query's first ``k`` of ``rows(query_id, vec_id, score)``."""
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def neighbours_of_every(df: DataFrame, every: int = EVERY, k: int = K, window: int | None = None) -> DataFrame:
    """Search with the rows whose ``vec_id`` is divisible by ``every`` as queries, against all rows."""
    return search(df, df.select("vec_id").filter(F.pmod(F.col("vec_id").cast("long"), F.lit(every)) == 0), k, window)
