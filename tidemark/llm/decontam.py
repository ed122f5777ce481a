"""Benchmark decontamination: random-walk embedding, bit-sampling LSH and exact edit verification.

Texts are sequences of words. A window is the run of words that starts at any
word of a document and is as long as a benchmark item (plus the edits allowed).

1. Random-walk embedding (CGK): a walk copies the current word to its output
   and moves on to the next word or stays, by a random bit of the word and the
   step. Sequences within a small edit distance get outputs within a small
   Hamming distance, as the walks meet again after an edit.
2. Bit sampling: each of ``ROUNDS`` independent walks reads ``SAMPLES`` random
   positions of its output; a window and an item that agree in all of them are
   candidates. The rounds are as many as ``RECALL`` asks for at the given edit
   distance.
3. Verification: a candidate counts if the item and some end of the window lie
   within ``floor((1 - similarity) * words)`` word edits (exact dynamic program).

Windows that cannot be within that distance aren't embedded: ``e`` edits leave
at least ``words - 1 - 2 e`` of the item's word pairs and ``words - 2 - 3 e`` of its
word triples intact, so a window must hold that many of the benchmark's. This
filter loses nothing. A walk ends early for windows whose samples so far agree
with no item.

Documents are scanned once, without a shuffle; the benchmark is the stated
query set, sent to the tasks in blocks of bounded size (``BLOCK_BYTES``), with
one scan for each block however many there are.

Defined results: null or wordless texts and items match nothing; items of
fewer than ``1 / (1 - similarity)`` words match only exactly; repeated items and
rows give repeated results; in each document the best place for an item is
reported (fewest edits, then leftmost); extra columns are kept.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, pieces, text_key
from tidemark.llm.words import U, mix, word_hashes

SIMILARITY = 0.8
SAMPLES = 2
RECALL = 0.999
AGREE = 0.35  # share of output positions that agree at the allowed distance, a cautious estimate
ROUNDS = math.ceil(math.log(1 - RECALL) / math.log(1 - AGREE**SAMPLES))
BLOCK_BYTES = 16 << 20
GROWTH = 1.25
_STEP = U(0x9E3779B97F4A7C15)


def edits_allowed(words: int, similarity: float) -> int:
    return int(math.floor((1 - similarity) * words + 1e-9))


def walk(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: np.ndarray, seed: int, known: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the output of one random walk at the given (ascending) steps, for windows ``[start, end)`` of ``tokens``.

    Past its end a window puts out 0. With ``known`` (for each step the sorted
    hashes of the items so far) windows that agree with no item any more are
    left out as the walk goes on. Returns the numbers of the windows left and their hashes."""
    left, at, done = np.arange(len(starts)), starts, 0
    h = np.zeros(len(starts), U)
    top = len(tokens) - 1
    with np.errstate(over="ignore"):
        for k, step in enumerate(steps):
            for j in range(done, step):
                word = tokens[np.minimum(at, top)]
                at = at + ((mix(word ^ (U(j + 1) * _STEP + U(seed))) >> U(63)).astype(np.int64) & (at < ends))
            done = step
            out = np.where(at < ends, tokens[np.minimum(at, top)], U(0))
            h = mix(h * _STEP + out + U(k + 1))
            if known is not None:
                on = _in_sorted(known[k], h)
                left, at, ends, h = left[on], at[on], ends[on], h[on]
    return left, h


def _in_sorted(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, h)
    return keys[np.minimum(at, len(keys) - 1)] == h


def _sample(seed: int, length: int) -> np.ndarray:
    """Ascending output positions that round ``seed`` reads for items of about ``length`` words.

    A walk stays about two steps on a word, so most of an item is read within twice its words."""
    rng = np.random.default_rng([seed, length])
    return np.sort(rng.choice(max(2 * length, SAMPLES), SAMPLES, replace=False))


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words (none if there are fewer)."""
    n = max(0, len(words) - k + 1)
    with np.errstate(over="ignore"):
        h = np.zeros(n, U)
        for i in range(k):
            h = h * _STEP + words[i : i + n]
        return mix(h)


class Marks:
    """Word pairs and word triples of some items as bit maps, and how many of them lie in a window."""

    def __init__(self, items: list[np.ndarray]):
        grams = [np.concatenate([_grams(w, k) for w in items]) for k in (2, 3)]
        self.shift = U(64 - max(16, (64 * max(1, *map(len, grams))).bit_length()))
        self.maps = []
        for g in grams:
            m = np.zeros(1 << (64 - int(self.shift)), bool)
            m[(g >> self.shift).astype(np.int64)] = True
            self.maps.append(m)

    def counts(self, words: np.ndarray, text_end: np.ndarray) -> list[np.ndarray]:
        """For pairs and triples: how many marked ones end at or before each position, inside one text."""
        out = []
        for k, m in zip((2, 3), self.maps, strict=True):
            run = np.zeros(len(words) + 1, np.int32)
            if len(words) >= k:
                hit = m[(_grams(words, k) >> self.shift).astype(np.int64)] & (text_end[: len(words) - k + 1] == text_end[k - 1 :])
                run[k:] = np.cumsum(hit)
            out.append(run)
        return out


class Class:
    """Items of about one length: what a window must hold, and the sampled keys of every round."""

    def __init__(self, members: list[int], words: list[np.ndarray], similarity: float):
        own = [words[n] for n in members]
        sizes = np.array([len(w) for w in own])
        edits = np.array([edits_allowed(int(s), similarity) for s in sizes])
        self.low = int(sizes.min())
        self.length = int((sizes + edits).max())
        self.least = int((sizes - edits).min())
        self.need = [int(max(0, (sizes - (k - 1) - k * edits).min())) for k in (2, 3)]
        self.marks = Marks(own)
        self.single = np.unique(np.concatenate(own)) if self.low == 1 else None
        flat, starts = np.concatenate(own), np.cumsum([0, *sizes])[:-1]
        self.rounds = []
        for seed in range(ROUNDS):
            steps = _sample(seed, self.low)
            known = [np.unique(walk(flat, starts, starts + sizes, steps[: k + 1], seed)[1]) for k in range(len(steps))]
            keys = walk(flat, starts, starts + sizes, steps, seed)[1]
            order = np.argsort(keys, kind="stable")
            self.rounds.append((steps, known, keys[order], np.array(members)[order]))

    def possible(self, words: np.ndarray, text_end: np.ndarray, counts: list[np.ndarray]) -> np.ndarray:
        """Starts of the windows that hold as many marked word pairs and triples as an item within the allowed edits leaves."""
        n = len(words)
        ends = np.minimum(np.arange(n) + self.length, text_end)
        on = ends - np.arange(n) >= self.least
        for k, run, need in zip((2, 3), counts, self.need, strict=True):
            if need:
                on &= run[ends] - run[np.minimum(np.arange(n) + k - 1, n)] >= need
        if self.single is not None:  # one-word items match exactly
            on &= _in_sorted(self.single, words)
        return np.flatnonzero(on)


class Index:
    """A block of benchmark items, grouped by length."""

    def __init__(self, items: list[tuple], similarity: float):
        words, cut = word_hashes([text for _, text in items])
        self.similarity = similarity
        self.ids = [i for (i, _), a, z in zip(items, cut, cut[1:], strict=False) if z > a]
        self.words = [words[a:z] for a, z in zip(cut, cut[1:], strict=False) if z > a]
        by_length: dict[int, list[int]] = defaultdict(list)
        for n, w in enumerate(self.words):
            by_length[int(math.log(len(w)) / math.log(GROWTH))].append(n)
        self.marks = Marks(self.words) if self.words else None
        self.classes = [Class(members, self.words, similarity) for members in by_length.values()]

    def candidates(self, words: np.ndarray, text_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window starts and item numbers that agree in some round. ``text_end`` holds for each word the end of its text."""
        found = [np.zeros((2, 0), np.int64)]
        if not len(words):
            return found[0][0], found[0][1]
        counts = self.marks.counts(words, text_end)
        keep = np.zeros(len(words), bool)  # texts with a window that some class finds possible
        some = np.zeros(len(words) + 1, bool)
        for c in self.classes:
            some[text_end[c.possible(words, text_end, counts)]] = True
        keep = some[text_end]
        place = np.flatnonzero(keep)
        if not len(place):
            return found[0][0], found[0][1]
        part = words[place]
        part_end = np.searchsorted(place, text_end[place])
        for c in self.classes:
            starts = c.possible(part, part_end, c.marks.counts(part, part_end))
            if not len(starts):
                continue
            ends = np.minimum(starts + c.length, part_end[starts])
            for seed, (steps, known, keys, members) in enumerate(c.rounds):
                left, h = walk(part, starts, ends, steps, seed, known)
                if len(left):
                    first = np.searchsorted(keys, h)
                    many = np.searchsorted(keys, h, "right") - first
                    rep = np.repeat(np.arange(len(left)), many)
                    pos = np.arange(len(rep)) - np.repeat(np.cumsum(many) - many, many) + first[rep]
                    found.append(np.stack([place[starts[left[rep]]], members[pos]]))
        both = np.unique(np.concatenate(found, axis=1), axis=1)
        return both[0], both[1]

    def verify(self, words: np.ndarray, text_end: np.ndarray, starts: np.ndarray, items: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(start, item, edits, end)`` of the candidates within the allowed edits."""
        out = []
        sizes = np.array([len(w) for w in self.words])[items] if len(items) else items
        for size in np.unique(sizes):
            most = edits_allowed(int(size), self.similarity)
            for part in np.array_split(np.flatnonzero(sizes == size), max(1, int((sizes == size).sum()) // 4096)):
                s, who = starts[part], items[part]
                goal = np.stack([self.words[i] for i in who])
                edits, length = _banded(words, text_end[s], s, goal, most)
                good = np.flatnonzero(edits <= most)
                out += [(int(s[i]), int(who[i]), int(edits[i]), int(s[i] + length[i])) for i in good]
        return out


def _banded(words: np.ndarray, end: np.ndarray, start: np.ndarray, goal: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest word edits between each row of ``goal`` and a prefix of its window, with the prefix's length (of those the shortest).

    The dynamic program keeps, for all candidates at once, the band of window lengths within ``most`` of the item's."""
    c, size = goal.shape
    band = 2 * most + 1
    far = np.int64(1 << 20)
    offset = np.arange(band) - most
    row = np.where(offset >= 0, offset, far)[None].repeat(c, 0)  # item prefix 0: window length = offset
    room = (end - start)[:, None]
    for i in range(1, size + 1):
        length = i + offset
        at = start[:, None] + length[None] - 1
        valid = (length >= 1)[None] & (length[None] <= room)
        same = valid & (words[np.clip(at, 0, len(words) - 1)] == goal[:, i - 1 : i])
        new = row + ~same  # replace or keep: same offset
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)  # an item word is missing
        new = np.where(valid | ((length == 0)[None] & (row[:, :] >= 0)), new, far)
        if most and (length == 0).any():
            new[:, np.flatnonzero(length == 0)[0]] = i
        new = np.minimum.accumulate(new - np.arange(band), axis=1) + np.arange(band)  # extra window words
        row = np.where((length[None] <= room) & (length >= 0)[None], new, far)
    best = row.min(1)
    return best, size + offset[np.argmax(row == best[:, None], axis=1)]


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The benchmark's items in blocks of bounded bytes (one item at least), streamed through the driver."""
    hold, held = [], 0
    for item_id, text in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        n = len(text or "") * 4 + 64
        if hold and held + n > limit:
            yield hold
            hold, held = [], 0
        hold.append((item_id, text))
        held += n
    if hold:
        yield hold


SCHEMA = "doc_id long, row long, item_id long, edits int, n_words int, start long, end long"


def contaminated(df: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and item found in it: edits, item words, and the place in code points.

    ``row`` keys the document (``doc_id`` and text)."""
    keyed = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_key(), F.col("doc_id").cast("long")).alias("row"), "text")
    context, out = df.sparkSession.sparkContext, None
    for block in blocks(benchmark):
        shared = context.broadcast(block)
        found = keyed.mapInArrow(_scan(shared, similarity), SCHEMA)
        out = found if out is None else out.unionAll(found)
    return out if out is not None else df.sparkSession.createDataFrame([], SCHEMA)


def _scan(shared, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for part, texts in pieces(batches, limit=1 << 22):
            index = index or Index(shared.value, similarity)
            if not index.ids:
                return
            words, cut = word_hashes(texts)
            text_end = np.repeat(cut[1:], np.diff(cut))
            starts, items = index.candidates(words, text_end)
            best: dict[tuple[int, int], tuple] = {}
            for start, item, edits, end in index.verify(words, text_end, starts, items):
                doc = int(np.searchsorted(cut, start, "right")) - 1
                key = (doc, item)
                if key not in best or (edits, start) < best[key][:2]:
                    best[key] = (edits, start, end)
            if not best:
                continue
            ids, rows = part.column(0).to_pylist(), part.column(1).to_pylist()
            lines: list[tuple] = []
            places: dict[int, tuple] = {}
            for (doc, item), (edits, start, end) in sorted(best.items()):
                if doc not in places:
                    places[doc] = word_hashes([texts[doc]], positions=True)[2:]
                first, last = places[doc]
                base = cut[doc]
                lines.append((ids[doc], rows[doc], index.ids[item], edits, len(index.words[item]), int(first[start - base]), int(last[max(start, end - 1) - base])))
            yield arrow(SCHEMA, {c.split()[0]: list(v) for c, v in zip(SCHEMA.split(", "), zip(*lines, strict=True), strict=True)})

    return run


def drop_contaminated(df: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` in which no benchmark item is found; decided inside the scan, without a join."""
    context = df.sparkSession.sparkContext
    for block in blocks(benchmark):
        df = df.mapInArrow(_clean(context.broadcast(block), similarity), df.schema)
    return df


def _clean(shared, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for part, texts in pieces(batches, limit=1 << 22):
            index = index or Index(shared.value, similarity)
            words, cut = word_hashes(texts)
            text_end = np.repeat(cut[1:], np.diff(cut))
            found = index.verify(words, text_end, *index.candidates(words, text_end)) if index.ids else []
            bad = np.zeros(len(texts), bool)
            bad[np.searchsorted(cut, [f[0] for f in found], "right").astype(int) - 1] = True
            yield part.filter(pa.array(~bad))

    return run
