"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three characters of every labelled text by
language and hash bucket, summed in each task and then by a shuffled
aggregate. The smoothed log-probability matrix (languages x buckets; its size
is fixed by ``CELLS``, not by the corpus) is broadcast, and texts are scored in
numpy: the sparse bucket counts of a text times the matching matrix rows.

Characters are lower-cased; every run of characters that aren't letters counts
as one blank. Texts are used whole.

Defined results: null text or text without a letter gives ``und`` and score 0;
with no labelled text at all every prediction is ``und``; a null ``doc_id``
counts as the empty string when the held-out part is drawn; repeated rows are
repeated observations; ties go to the language first in code point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow, pieces

CELLS = 1 << 22  # bound of the broadcast matrix: 4 million numbers
MOST_BUCKETS = 1 << 14
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that nothing is learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    if len(codes) and codes.max() >= 1 << 16:
        out = _letters[0][np.minimum(codes, (1 << 16) - 1)]
        for code in np.unique(codes[codes >= 1 << 16]):
            out[codes == code] = chr(code).isalpha()
        return out
    return _letters[0][codes]


def ngram_buckets(text: str | None, buckets: int) -> np.ndarray:
    """Hash buckets of all n-grams of a text; empty if it holds no letter. ``buckets`` is a power of two."""
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter(codes)
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of each run of other characters stands for the run
    c = np.concatenate([[32], np.where(letter, codes, 32)[keep], [32]]).astype(np.uint32)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    return (np.concatenate([one, two, three]) >> shift).astype(np.int64)


def train(df: DataFrame) -> dict:
    """Fit on the rows of ``df(text, lang)`` with a language. Returns languages, prior and log-probabilities."""
    labelled = df.filter(F.col("lang").isNotNull()).select(F.col("text"), F.col("lang").cast("string").alias("lang"))
    langs = sorted(r[0] for r in labelled.select("lang").distinct().collect())  # language codes: bounded by the world's languages
    if len(langs) > 1 << 14:
        raise ValueError(f"{len(langs)} values of lang: not a column of language codes")
    buckets = MOST_BUCKETS
    while buckets * max(1, len(langs)) > CELLS:
        buckets //= 2
    place = {name: i for i, name in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        docs: dict[int, int] = {}
        for part, texts in pieces(batches):
            for text, lang in zip(texts, part.column(1).to_pylist(), strict=True):
                at = ngram_buckets(text, buckets)
                if len(at):
                    k = place[lang]
                    if k not in found:
                        found[k] = np.zeros(buckets, np.int64)
                    found[k] += np.bincount(at, minlength=buckets)
                    docs[k] = docs.get(k, 0) + 1
        for k, n in found.items():
            some = np.flatnonzero(n)
            cells = np.concatenate([k * (buckets + 1) + some, [k * (buckets + 1) + buckets]])
            yield arrow("cell long, n long", {"cell": cells, "n": np.concatenate([n[some], [docs[k]]])})

    cells = labelled.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(len(langs) * (buckets + 1))
    for cell, n in cells:
        table[cell] = n
    table = table.reshape(len(langs), buckets + 1)
    seen = table[:, buckets] > 0
    table, langs = table[seen], [name for name, s in zip(langs, seen, strict=True) if s]
    counts, docs = table[:, :buckets], table[:, buckets]
    logs = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * buckets)) if len(langs) else counts
    return {"langs": langs, "buckets": buckets, "prior": np.log(docs / docs.sum()) if len(langs) else docs, "logs": np.ascontiguousarray(logs.T)}


def score_text(text: str | None, model: dict) -> tuple[str, float]:
    """Most probable language of one text and its posterior probability."""
    at = ngram_buckets(text, model["buckets"])
    if not len(at) or not model["langs"]:
        return UNKNOWN, 0.0
    n = np.bincount(at, minlength=model["buckets"])
    some = np.flatnonzero(n)
    total = n[some].astype(float) @ model["logs"][some] + model["prior"]
    best = int(np.argmax(total))
    return model["langs"][best], float(1.0 / np.exp(total - total[best]).sum())


def identify(df: DataFrame, model: dict, predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with two more columns, named ``predicted`` and ``score``; only the text is looked at."""
    columns = [c for c in df.columns if c.lower() not in (predicted, score)]
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = df.select(*columns)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            found = [score_text(text, shared.value) for text in texts]
            more = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, predicted, score])

    schema = T.StructType([*kept.schema.fields, T.StructField(predicted, T.StringType()), T.StructField(score, T.DoubleType())])
    return kept.mapInArrow(predict, schema)
