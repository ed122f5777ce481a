"""Collocations: phrases that occur more often than their parts suggest, mined by sorted count streams.

Words and pieces: ``A``-``Z`` lower-cased, pieces end at ``. , ; : ! ?`` and line ends,
words are runs of other characters than blank and tab. Counts are kept for
each language apart (null: ``und``).

Counting goes order by order over all texts: a phrase of ``k`` words is counted only where
both its parts of ``k - 1`` words are frequent enough, which loses nothing, since no
phrase occurs more often than its parts. Which parts are frequent is told by a bit
array of at most ``MOST_BITS`` bits, whatever the table's size: a bit that is set for
another phrase costs a row, never a result. A last scan counts the phrases that are left by their text.

The frequent phrases then pass twice as sorted streams, as in external language
model estimation: in prefix order, where a phrase comes right after the phrases it
begins with, and in suffix order, the same for the reversed words. Each pass keeps
a stack of at most ``longest + 1`` open phrases and reads off the counts of all first
parts (then all last parts) and the largest count among one-word extensions to the
right (then to the left). No hash join or group is needed. The empty phrase, whose count
is ``n``, begins every phrase. Streams are range-partitioned over the whole word sequence, so a
frequent first word is spread over tasks; at most ``longest`` open phrases per border are handed on.

Defined results: null and empty texts have no words; a language without frequent
phrases has no rows; repeated rows count again; equal scores are ordered by count, then
phrase; long texts are read whole; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, written
from tidemark.llm.tokens import U, Words, byte_table, hash_of, slabs
from tidemark.llm.words import mix
from tidemark.session import partitions_for

LONGEST = 5
LEAST = 100
TOP = 2000
MOST_BITS = 1 << 27  # 16 MB
FLUSH = 1 << 21
TABLE = byte_table(b" \t", b".,;:!?\n\x0b\x0c\r")
UNKNOWN = "und"
_BASE = U(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ phrases of a slab


def _runs(w: Words, k: int, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of the phrase of ``k`` words at each word, and whether it lies in one piece."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, bool)
    with np.errstate(over="ignore"):
        key = w.hash[:n] + seed[w.row[:n]]
        for j in range(1, k):
            key = mix(key * _BASE + w.hash[j : j + n])
    return key, w.piece[:n] == w.piece[k - 1 :]


class Bits:
    """A set of keys as a bit array by their leading bits."""

    def __init__(self, data: np.ndarray, bits: int):
        self.data, self.shift = data, U(64 - bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.data[at >> U(3)] >> (at & U(7)).astype(np.uint8)) & 1 > 0


def bit_array(keys: DataFrame) -> Bits:
    """``keys(key)`` as bits, 64 for each key (fewer beyond ``MOST_BITS``), packed in tasks by blocks of 2**15."""
    bits = min(MOST_BITS.bit_length() - 1, max(16, (64 * keys.count()).bit_length()))
    at = F.shiftrightunsigned("key", 64 - bits)
    blocks = keys.select(F.shiftright(at, 15).alias("block"), at.bitwiseAND(32767).cast("int").alias("bit"))
    blocks = blocks.groupBy("block").agg(F.collect_set("bit").alias("set"))  # at most 32,768 numbers each

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = np.zeros(32768, bool)
                row[batch.column(1)[i].values.to_numpy()] = True
                yield arrow("block long, bits binary", {"block": [batch.column(0)[i].as_py()], "bits": [np.packbits(row, bitorder="little").tobytes()]})

    data = np.zeros(max(1, (1 << bits) >> 3), np.uint8)
    for block, part in blocks.mapInArrow(pack, "block long, bits binary").collect():  # 16 MB at most
        data[block * 4096 : block * 4096 + 4096] = np.frombuffer(part, np.uint8)
    return Bits(data, bits)


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """Words of all texts, with the seed of each row's language and the languages."""
    seeds: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang in set(langs) - seeds.keys():
            seeds[lang] = int(mix(np.array([hash_of(lang)], U))[0])  # mixed again: "es" in en is not "en" in es
        seed = np.array([seeds[x] for x in langs], U)
        for w in slabs(batch.column(1), TABLE):
            yield w, seed, langs
        if len(seeds) > 100_000:
            seeds.clear()


# ------------------------------------------------------------------ counting


def _frequent(texts: DataFrame, k: int, least: int, parts: Bits | None) -> DataFrame:
    """Keys of the phrases of ``k`` words that occur ``least`` times (a few more by chance)."""
    shared = texts.sparkSession.sparkContext.broadcast(parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, shared.value

        def flush() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return arrow("key long, n long", {"key": key.astype(np.int64), "n": n})

        for w, seed, _ in _slabs(batches):
            key, whole = _runs(w, k, seed)
            if known is not None and len(key):
                part, _ = _runs(w, k - 1, seed)
                ok = known.has(part)
                whole = whole & ok[:-1] & ok[1:]
            held.append(key[whole])
            size += len(held[-1])
            if size >= FLUSH:
                yield flush()
                size = 0
        if size:
            yield flush()

    counted = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return written(counted.filter(F.col("n") >= least).select("key"), f"phrases-{k}")


def _by_text(texts: DataFrame, longest: int, known: Bits) -> DataFrame:
    """``(lang, words, n)`` of all phrases whose key is known, and of the empty phrase (all words)."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        total: dict[str, int] = {}
        schema = "lang string, size int, phrase string, n long"

        def rows() -> pa.RecordBatch:
            out = [*((x[0], x[1], x[2].decode(), x[3]) for x in found.values()), *((lang, 0, "", n) for lang, n in total.items())]
            found.clear()
            total.clear()
            return arrow(schema, dict(zip(("lang", "size", "phrase", "n"), map(list, zip(*out, strict=True)), strict=True)))

        for w, seed, langs in _slabs(batches):
            in_row = np.bincount(w.row) if len(w.row) else np.zeros(0, np.int64)
            for r in np.flatnonzero(in_row):
                total[langs[r]] = total.get(langs[r], 0) + int(in_row[r])
            for k in range(1, longest + 1):
                key, whole = _runs(w, k, seed)
                at = np.flatnonzero(whole & shared.value.has(key)) if len(key) else []
                if not len(at):
                    break  # no longer phrase is frequent either
                each, first, n = np.unique(key[at], return_index=True, return_counts=True)
                for x, i, c in zip(each.tolist(), at[first].tolist(), n.tolist(), strict=True):
                    old = found.get(x)
                    if old is None:
                        found[x] = [langs[w.row[i]], k, w.text(i, k), c]
                    else:
                        old[3] += c
            if len(found) + len(total) > 1 << 18:
                yield rows()
        if found or total:
            yield rows()

    parts = texts.mapInArrow(count, "lang string, size int, phrase string, n long")
    summed = parts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    words = F.when(F.col("size") == 0, F.array().cast("array<string>")).otherwise(F.split("phrase", " ", -1))
    return summed.select("lang", words.alias("words"), "n")


def phrase_counts(df: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Exact counts of all phrases of 1 to ``longest`` words that occur ``least`` times in their language, and of all words (no words)."""
    texts = df.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    keys, parts, last = None, None, None
    for k in range(1, longest + 1):
        if k > 1:
            parts = bit_array(last)
            if not parts.data.any():
                break
        last = _frequent(texts, k, least, parts)
        keys = last if keys is None else keys.unionByName(last)
    counts = _by_text(texts, longest, bit_array(keys))
    return written(counts.filter((F.col("n") >= least) | (F.size("words") == 0)), "phrase-counts")


# ------------------------------------------------------------------ sorted streams


def _stream(batches: Iterator[pa.RecordBatch], carried: list[str]) -> Iterator[tuple]:
    """``(lang, words, n, counts of the parts it begins with, largest extension, carried columns)`` of a sorted stream.

    Counts are -1 for parts that stand in an earlier partition. Those parts follow with
    ``n`` None and the largest extension seen here."""
    stack: list[list] = []  # [words, n, counts, ext, carried], each beginning with the one before
    lang, outside = None, {}

    def close(to: int) -> Iterator[tuple]:
        while len(stack) > to:
            words, n, counts, ext, more = stack.pop()
            yield lang, words, n, counts, ext, more

    for batch in batches:
        for row in batch.to_pylist():
            words = row["words"]
            if row["lang"] != lang:
                yield from close(0)
                lang = row["lang"]
            while stack and words[: len(stack[-1][0])] != stack[-1][0]:
                yield from close(len(stack) - 1)
            counts = [-1] * len(words)
            for begun in stack:
                counts[len(begun[0])] = begun[1]
            if words:
                if stack and len(stack[-1][0]) == len(words) - 1:
                    stack[-1][3] = max(stack[-1][3], row["n"])
                else:  # the part one word shorter is in an earlier partition
                    part = (lang, tuple(words[:-1]))
                    outside[part] = max(outside.get(part, 0), row["n"])
                for k in range(len(words) - 1):
                    if counts[k] < 0:
                        outside.setdefault((lang, tuple(words[:k])), 0)
            stack.append([words, row["n"], counts, 0, [row[c] for c in carried]])
    yield from close(0)
    for (own, words), ext in outside.items():
        yield own, list(words), None, [], ext, [None for _ in carried]


class Borders:
    """What streams hand on across partition borders: counts of open phrases, and their extensions seen later."""

    def __init__(self, rows: list):
        self.count = {(r.lang, tuple(r.words)): r.n for r in rows}
        self.later = {(r.lang, tuple(r.words)): r.ext for r in rows}

    def parts(self, lang: str, words: list[str], counts: list[int]) -> list[int]:
        return [self.count[lang, tuple(words[:k])] if c < 0 else c for k, c in enumerate(counts)]

    def extension(self, lang: str, words: list[str], ext: int) -> int:
        return max(ext, self.later.get((lang, tuple(words)), 0))


def _borders(passed: DataFrame, words: str = "words") -> Borders:
    """At most ``longest`` phrases for each partition of the stream."""
    late = passed.filter(F.col("n").isNull()).groupBy("lang", words).agg(F.max("ext").alias("ext"))
    own = passed.filter(F.col("n").isNotNull()).select("lang", words, "n")
    return Borders(own.join(F.broadcast(late), ["lang", words]).select("lang", F.col(words).alias("words"), "n", "ext").collect())


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange(partitions_for(rows), "lang", "words").sortWithinPartitions("lang", "words")


def with_parts(counts: DataFrame) -> tuple[DataFrame, Borders]:
    """Both passes over ``counts(lang, words, n)``: adds ``first`` (counts of the parts a phrase begins with, by their
    length), ``right``, ``last`` (counts of the parts it ends with) and ``ext``, the largest left extension; the
    borders complete ``last`` and ``ext`` and belong to reversed words (column ``words``)."""
    one = "lang string, words array<string>, n long, first array<long>, ext long"
    two = "lang string, words array<string>, n long, first array<long>, right long, last array<long>, ext long"

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _grouped(_stream(batches, [])):
            yield _record(one, [x[:5] for x in out])

    ahead = written(_sorted(counts).mapInArrow(prefix, one), "prefix-order")
    borders = _borders(ahead)
    rest = ahead.filter(F.col("n").isNotNull()).select("lang", F.reverse("words").alias("words"), "n", "first", "ext")

    def suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _grouped(_stream(batches, ["first", "ext"])):
            full = []
            for lang, words, n, parts, ext, (first, right) in out:
                if n is not None:
                    forward = words[::-1]
                    first, right = borders.parts(lang, forward, first), borders.extension(lang, forward, right)
                full.append((lang, words, n, first, right, parts, ext))
            yield _record(two, full)

    back = written(_sorted(rest).mapInArrow(suffix, two), "suffix-order")
    return back.filter(F.col("n").isNotNull()), _borders(back)


def _grouped(rows: Iterator[tuple], size: int = 4096) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def _record(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def collocations(df: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    ``score`` is ``floor(1000 a n / (l r))`` at the cut with the lowest one (the first of equals), in exact integers.
    A phrase that a longer one contains as often goes."""
    rows, borders = with_parts(phrase_counts(df, longest, least))
    schema = "lang string, phrase string, a long, l long, r long, n long, score long"

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words, a, first = row["words"], row["n"], row["first"]  # words in reverse
                if len(words) < 2 or max(row["right"], borders.extension(row["lang"], words, row["ext"])) >= a:
                    continue
                last, n = borders.parts(row["lang"], words, row["last"]), first[0]
                score, cut = min((1000 * a * n // (first[k] * last[len(words) - k]), k) for k in range(1, len(words)))
                out.append((row["lang"], " ".join(reversed(words)), a, first[cut], last[len(words) - cut], n, score))
            yield _record(schema, out)

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.mapInArrow(rate, schema).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows in SQL, by counting every phrase of every piece.
COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
slices AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS r(k)),
f AS (SELECT lang, w[i:i + k - 1] AS p, count(*) AS a FROM slices GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT * FROM f WHERE len(p) > 1),
inside AS (
  SELECT DISTINCT s.lang, s.sub FROM (
    SELECT lang, a, p[i:j] AS sub FROM (SELECT lang, a, p, i, unnest(range(i + 1, len(p) + 1)) AS j FROM (SELECT *, unnest(range(1, len(p))) AS i FROM cand))
    WHERE j - i + 1 < len(p)) s
  JOIN f ON f.lang = s.lang AND f.p = s.sub WHERE 100 * s.a >= 100 * f.a),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM cand),
rated AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, t.n,
    CAST((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:] JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
kept AS (SELECT *, array_to_string(p, ' ') AS phrase FROM best b WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.sub = b.p))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
