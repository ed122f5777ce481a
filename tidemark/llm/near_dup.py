"""Near-duplicate documents with ProbMinHash over weighted word shingles.

A document is the weighted set of its five-word shingles (weight 1 + ln of how
often one occurs). Every shingle sends points of a Poisson process whose rate
is its weight; each point falls on one of the signature's components, and a
component keeps the shingle of its earliest point, so two documents agree in a
component with the probability Jaccard similarity of their sets. A shingle
stops once its next point lies beyond the latest point that any component
holds; for long texts that is after about one point each. All points come from
hashes of the shingle, so signatures don't depend on batches.

Documents that share a band of components become candidates (stars to the
smallest id of a bucket and an exact remainder, see ``linking``), and a pair is
linked if the exact Jaccard similarity of the two sets of five-word shingles
reaches 0.8. Classes are the connected components; documents with the same
words in the same order count as one item until the end, so copies cost no
pairs. With 24 bands of 5 components a pair at 0.8 is a candidate with
probability 0.9999, at 0.7 with 0.988.

Defined results: a text of fewer than five words is one shingle; null, empty and
wordless texts are classes of their own; rows equal in ``doc_id`` and text are
one document (the kept document stays once); the smallest ``doc_id`` of a class
names it (null last) and stays; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, pieces, text_key, written
from tidemark.llm.linking import linked_groups
from tidemark.llm.words import U, mix, sequence_key, shingles, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
MOST_KEYS = 1 << 22  # keys of needed texts that are sent to all executors: 32 MB
_STEP, _SALT = U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03)


def probminhash(items: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, m: int) -> np.ndarray:
    """Signatures (``sets`` x ``m``) of weighted sets given as parallel arrays; a set without items has zeros."""
    reach = np.full(sets * m, np.inf)
    held = np.zeros(sets * m, U)
    latest = np.full(sets, np.inf)
    at = np.zeros(len(items))
    turn = 0
    while len(items):
        with np.errstate(over="ignore"):
            r = mix(items + U(turn) * _STEP)
            u = (mix(r ^ _SALT) >> U(11)).astype(float) * 2.0**-53
        at = at - np.log1p(-u) / weights
        cell = owner * m + ((r >> U(32)) % U(m)).astype(np.int64)
        np.minimum.at(reach, cell, at)
        first = reach[cell] == at
        held[cell[first]] = items[first]
        live = np.flatnonzero(np.bincount(owner, minlength=sets))
        latest[live] = reach.reshape(sets, m)[live].max(1)
        on = at < latest[owner]
        items, weights, owner, at = items[on], weights[on], owner[on], at[on]
        turn += 1
    return held.reshape(sets, m)


def weighted_shingles(words: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text and their weights."""
    items, n = np.unique(shingles(words, k), return_counts=True)
    return items, 1.0 + np.log(n)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=U) * _SALT, (len(signature), bands))
        for i in range(rows):
            key = mix(key * _STEP + parts[:, :, i])
    return key.astype(np.int64)


SIGNED = "doc_id long, row long, text_key long, id long, n_words long, bands array<long>"


def signatures(df: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each row of ``df(doc_id, text)``; ``id`` keys the word sequence, ``row`` the pair of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, limit=1 << 22):
            words, cut = word_hashes(texts)
            own = [words[a:z] for a, z in zip(cut, cut[1:], strict=False)]
            sets = [weighted_shingles(w) for w in own]
            owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
            signed = probminhash(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), owner, len(sets), bands * rows)
            keys = band_keys(signed, bands, rows)
            n = np.diff(cut)
            lists = [k if c else [] for k, c in zip(keys.tolist(), n, strict=True)]
            yield arrow(SIGNED, {"doc_id": part.column(0), "row": part.column(1), "text_key": part.column(2), "id": [sequence_key(w) for w in own], "n_words": n, "bands": lists})

    keyed = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    return keyed.select("doc_id", F.xxhash64("text_key", "doc_id").alias("row"), "text_key", "text").mapInArrow(run, SIGNED)


def texts_by_key(df: DataFrame, need: DataFrame) -> DataFrame:
    """``(id, text)`` for ``need(id, text_key)``: one text for each key.

    Texts that nobody needs leave before any shuffle: up to ``MOST_KEYS`` keys are sent to all
    executors, more are joined by size. Copies are dropped before the shuffle, too."""
    need = written(need.select("id", "text_key"), "needed")
    keys = need.select("text_key")
    keys = F.broadcast(keys) if need.count() <= MOST_KEYS else keys
    first = Window.partitionBy("text_key").orderBy("text_key")
    kept = df.select(text_key().alias("text_key"), "text").join(keys, "text_key", "left_semi")
    one = kept.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    return one.join(need, "text_key").select("id", "text")


def similar_pairs(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose texts reach the Jaccard similarity of their shingle sets, with ``jaccard``."""
    schema = "a long, b long, jaccard double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, left in pieces(batches, "ta"):
            right = part.column(3).to_pylist()
            words, cut = word_hashes([*left, *right])
            sets = [np.unique(shingles(words[x:z], SHINGLE)) for x, z in zip(cut, cut[1:], strict=False)]
            n = len(left)
            score = []
            for x, y in zip(sets[:n], sets[n:], strict=True):
                both = len(x) + len(y) - len(np.union1d(x, y)) if min(len(x), len(y)) >= similarity * max(len(x), len(y)) else 0
                score.append(both / (len(x) + len(y) - both) if both else 0.0)
            keep = [i for i, s in enumerate(score) if s >= similarity]
            yield arrow(schema, {"a": part.column(0).take(pa.array(keep, pa.int64())), "b": part.column(1).take(pa.array(keep, pa.int64())), "jaccard": [score[i] for i in keep]})

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, schema)


def shingle_rows(texts: DataFrame) -> DataFrame:
    """``(id, part)``: the distinct shingles of the texts in ``texts(id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in pieces(batches):
            words, cut = word_hashes(some)
            sets = [np.unique(shingles(words[a:z], SHINGLE)) for a, z in zip(cut, cut[1:], strict=False)]
            ids = np.repeat(part.column(0).to_numpy(), [len(x) for x in sets])
            yield arrow("id long, part long", {"id": ids, "part": np.concatenate(sets).astype(np.int64)})

    return texts.select("id", "text").mapInArrow(run, "id long, part long")


def near_duplicates(df: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``row``, ``class_id`` (smallest doc_id of the class), ``class_row``, ``class_docs``."""
    signed = written(signatures(df), "signed")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "text_key")
    nodes = signed.filter("n_words > 0").groupBy("id").agg(F.min(rank).alias("best"), F.first("bands").alias("bands"), F.count("*").alias("docs"))
    nodes = written(nodes, "nodes")

    def texts(ids: DataFrame) -> DataFrame:
        return texts_by_key(df, nodes.join(ids, "id").select("id", F.col("best.text_key").alias("text_key")))

    def verify(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        return similar_pairs(pairs, written(texts(ids), "texts"), similarity)

    groups, _ = linked_groups(nodes.select(F.explode("bands").alias("bucket"), "id"), verify, lambda ids: shingle_rows(texts(ids)), similarity)
    rooted = nodes.join(groups, "id", "left").select("id", F.coalesce("root", "id").alias("root"), "best", "docs")
    classes = rooted.groupBy("root").agg(F.min("best").alias("top"), F.sum("docs").alias("class_docs"))
    named = written(rooted.select("id", "root").join(classes, "root").select("id", F.col("top.doc_id").alias("class_id"), F.col("top.row").alias("class_row"), "class_docs"), "classes")
    out = signed.filter("n_words > 0").select("doc_id", "row", "id").join(named, "id").drop("id")
    alone = signed.filter("n_words = 0").select("doc_id", "row", F.col("doc_id").alias("class_id"), F.col("row").alias("class_row"), F.lit(1).cast("long").alias("class_docs"))
    return out.unionByName(alone)


def drop_near_duplicates(df: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that stay: one document of each class."""
    found = near_duplicates(df, similarity)
    keep = found.filter("row = class_row").select(F.col("row").alias("__row")).distinct()
    first = Window.partitionBy("__row").orderBy("__row")
    keyed = df.withColumn("__row", F.xxhash64(text_key(), F.col("doc_id").cast("long")))
    once = keyed.withColumn("__n", F.row_number().over(first)).filter("__n = 1")
    return once.join(keep, "__row", "left_semi").select(*df.columns)
