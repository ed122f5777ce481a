"""Interpolated modified Kneser-Ney language model: counted in Spark, stored as sorted hash arrays, scored through memory maps.

Tokens are words (runs of other characters than white space, ``A``-``Z`` lower-cased) and one end for each
text; a start stands before each text and is never predicted. A phrase's key is a 64-bit hash.

Counting: each task sorts the phrases of ``order`` tokens of a few million tokens, adds up equal ones
and sends them as blocks of arrays, one for each shard. A shard's task merges its blocks, stores phrases and
contexts as sorted arrays, and sends on how many different tokens stand before each shorter phrase, which
is the count that Kneser-Ney uses there; the next stage does the same with those, down to
single tokens. A shard is chosen by the context, so that a context's statistics are complete in it; contexts with more
than about an eighth of a shard's share of all tokens (found by a scan that counts words; at most ``8 * shards``) are spread over
all shards by the phrase and their statistics added up. All counts are exact and cover all training texts.

Storage: one file of sorted 64-bit keys and values for each level and shard, in the folder that
driver and executors share; written under another name and then renamed, so a repeated task does no harm. Workers map the
files into memory (a copy in their own file system that has no name any more, where the folder is
not mounted) and look up the sorted keys of about a million tokens at a time, so pages are visited in order and no
task holds the model.

Defined results: null text is an empty one (one token: its end); a null ``doc_id`` counts as the empty string
when held-out texts are drawn; repeated rows count again; without training texts every score is that of ``1 / (V + 1)``, 0;
discounts that counts of counts don't give (none of one to four, or out of range) are 0.5, 1 and 1.5; long texts are scored
whole; further columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow
from tidemark.llm.tokens import U, byte_table, slabs
from tidemark.llm.words import mix
from tidemark.session import partitions_for, scratch_path

ORDER = 2
SHARD_BYTES = 16 << 20  # of input for each shard
FLUSH = 1 << 22  # tokens counted before a task sends blocks
CHUNK = 1 << 20  # tokens scored at once
TABLE = byte_table(b" \t\n\x0b\x0c\r")
START, END = U(0x5374617274), U(0x456E64)
_BASE = U(0x9E3779B97F4A7C15)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the texts that nothing is learned from: crc32 of the id as text leaves 2 modulo 7."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def phrase_key(cols: list[np.ndarray]) -> np.ndarray:
    """Keys of phrases given as one array for each place; that of a single token is its hash."""
    key = cols[0]
    with np.errstate(over="ignore"):
        for c in cols[1:]:
            key = mix(key * _BASE + c)
    return key


# ------------------------------------------------------------------ token sequences


def sequences(column: pa.Array, order: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(tokens, row, place)`` of a text column in chunks of about ``limit`` tokens. ``place`` 0 marks tokens that are
    not predicted (a text's start, or what a cut text's next tokens follow), 1 the first token after the start, and so
    on, up to ``order - 1`` (1 at least) for all others: a token of place p follows p known tokens."""
    most = max(1, order - 1)
    held, size, done, carry = [], 0, 0, None  # done: rows that are complete; carry: last tokens of the row cut

    def chunk(rows: int, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nonlocal held, size, done, carry
        h = np.concatenate([x for x, _ in held]) if held else np.zeros(0, U)
        r = np.concatenate([x for _, x in held]) - done if held else np.zeros(0, np.int64)
        count = np.bincount(r, minlength=rows - done)
        at = np.concatenate([[0], np.cumsum(count + 2)])
        tokens = np.empty(at[-1], U)
        tokens[at[:-1]] = START
        tokens[at[1:] - 1] = END
        tokens[np.arange(len(h)) + 2 * r + 1] = h
        row = np.repeat(np.arange(done, rows), count + 2)
        place = np.minimum(np.arange(len(tokens)) - np.repeat(at[:-1], count + 2), most)
        if not whole:
            tokens, row, place = tokens[:-1], row[:-1], place[:-1]
        if carry is not None:  # the first text goes on
            k, own = len(carry), int(count[0]) + 1
            place[1:own + 1] = np.minimum(place[1:own + 1] + k - 1, most)
            tokens = np.concatenate([carry, tokens[1:]])
            row = np.concatenate([np.full(k, done), row[1:]])
            place = np.concatenate([np.zeros(k, np.int64), place[1:]])
        carry = None if whole else tokens[row == rows - 1][-most:].copy()
        held, size, done = [], 0, rows if whole else rows - 1
        return tokens, row, place

    for w in slabs(column, TABLE):
        if not len(w.hash):
            continue
        if size >= limit:
            same = w.row[0] == held[-1][1][-1]
            yield chunk(int(w.row[0]) + 1 if same else int(w.row[0]), not same)
        held.append((w.hash, w.row))
        size += len(w.hash)
    if done < len(column) or held:
        yield chunk(len(column), True)


def phrases(tokens: np.ndarray, place: np.ndarray, k: int, exact: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of the phrases of ``k`` tokens that end at predicted tokens, and where they end. ``exact``: only those that
    begin with a text's start (they can't be longer)."""
    at = np.flatnonzero(place == k - 1) if exact or k == 1 else np.flatnonzero(place >= k - 1)
    if k == 1:
        at = np.flatnonzero(place > 0)
    return [tokens[at - k + 1 + j] for j in range(k)], at


# ------------------------------------------------------------------ blocks and files


def _pack(x: np.ndarray) -> bytes:
    """An array by planes of bytes, so that the empty ones compress away."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _narrow(x: np.ndarray) -> np.ndarray:
    most = int(x.max()) if len(x) else 0
    return x.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def store(path: str, arrays: list[np.ndarray]) -> None:
    """Write arrays of one length to a file: count, item sizes, then each array from a multiple of eight bytes on."""
    fs, name = pa.fs.FileSystem.from_uri(path)
    fs.create_dir(name.rsplit("/", 1)[0])
    other = f"{name}.{uuid.uuid4().hex}"
    head = np.zeros(8, np.uint64)
    head[0], head[1 : 1 + len(arrays)] = len(arrays[0]), [a.itemsize for a in arrays]
    with fs.open_output_stream(other) as out:
        out.write(head.tobytes())
        for a in arrays:
            out.write(a.tobytes())
            out.write(bytes(-a.nbytes % 8))
    fs.move(other, name)


_maps: OrderedDict[str, list[np.ndarray] | None] = OrderedDict()


def mapped(path: str) -> list[np.ndarray] | None:
    """The arrays of a file, mapped into memory (None: no such file). A worker keeps its latest maps."""
    if path not in _maps:
        fs, name = pa.fs.FileSystem.from_uri(path)
        if fs.get_file_info(name).type != pa.fs.FileType.File:
            _maps[path] = None
        else:
            if isinstance(fs, pa.fs.LocalFileSystem):
                data = np.memmap(name, np.uint8, "r")
            else:
                with tempfile.TemporaryFile() as own:  # the map outlives the file's name
                    with fs.open_input_stream(name) as source:
                        while part := source.read(1 << 24):
                            own.write(part)
                    own.flush()
                    data = np.memmap(own, np.uint8, "r")
            head, at, arrays = data[:64].view(np.uint64), 64, []
            for size in head[1:][head[1:] > 0].tolist():
                arrays.append(data[at : at + int(head[0]) * size].view(f"u{size}"))
                at += -(-int(head[0]) * size // 8) * 8
            _maps[path] = arrays
        while len(_maps) > 1024:
            _maps.popitem(last=False)
    _maps.move_to_end(path)
    return _maps[path]


def look_up(base: str, shard: np.ndarray, key: np.ndarray, values: int) -> list[np.ndarray]:
    """Values of each key (0 where it isn't stored), shard after shard with sorted keys."""
    out = [np.zeros(len(key), np.int64) for _ in range(values)]
    order = np.lexsort((key, shard))
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, z in zip(cuts, [*cuts[1:], len(order)], strict=True):
        arrays = mapped(f"{base}/{int(shard[order[a]]):06d}")
        if arrays is None or not len(arrays[0]):
            continue
        mine = key[order[a:z]]
        i = np.minimum(np.searchsorted(arrays[0], mine), len(arrays[0]) - 1)
        hit = arrays[0][i] == mine
        for v, stored in zip(out, arrays[1:], strict=True):
            v[order[a:z][hit]] = stored[i[hit]]
    return out


# ------------------------------------------------------------------ training

_BLOCK = "level int, shard int, size int, first binary, runs binary, rest binary, near binary, raw binary"


@dataclass
class Layout:
    """What counting and scoring tasks need to know: where the files are, and which shard holds what."""

    path: str
    order: int
    shards: int
    heavy: np.ndarray  # sorted keys of the contexts that are spread over all shards

    def file(self, kind: str, level: int) -> str:
        return f"{self.path}/{kind}-{level}"

    def spread(self, key: np.ndarray) -> np.ndarray:
        return (mix(key) % U(self.shards)).astype(np.int64)

    def shard(self, context: np.ndarray | None, key: np.ndarray) -> np.ndarray:
        if context is None:
            return self.spread(key)
        out = self.spread(context)
        if len(self.heavy):
            i = np.minimum(np.searchsorted(self.heavy, context), len(self.heavy) - 1)
            hot = self.heavy[i] == context
            out[hot] = self.spread(key[hot])
        return out


def _blocks(cols: list[np.ndarray], near: np.ndarray, raw: np.ndarray, at: Layout) -> Iterator[pa.RecordBatch]:
    """Phrases as one row for each shard, sorted by their first token within it."""
    key = phrase_key(cols)
    shard = at.shard(phrase_key(cols[:-1]) if len(cols) > 1 else None, key)
    order = np.lexsort((cols[0], shard))
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, z in zip(cuts, [*cuts[1:], len(order)], strict=True):
        mine = order[a:z]
        first = cols[0][mine]
        begin = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        yield arrow(_BLOCK, {
            "level": [len(cols)], "shard": [int(shard[order[a]])], "size": [z - a],
            "first": [first[begin].tobytes()], "runs": [_pack(np.diff(begin, append=z - a).astype(np.uint32))],
            "rest": [b"".join(c[mine].tobytes() for c in cols[1:])],
            "near": [_pack(near[mine].astype(np.uint64))], "raw": [b"" if raw is near else _pack(raw[mine].astype(np.uint64))],
        })


def _unblock(row: dict) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    first = np.repeat(np.frombuffer(row["first"], U), _unpack(row["runs"], np.uint32))
    rest = np.frombuffer(row["rest"], U).reshape(row["level"] - 1, -1) if row["level"] > 1 else []
    near = _unpack(row["near"], np.uint64)
    return [first, *rest], near, _unpack(row["raw"], np.uint64) if row["raw"] else near


def _merged(cols: list[np.ndarray], near: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted different keys, their phrases and the sums of both counts."""
    key = phrase_key(cols)
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    add = lambda x: np.add.reduceat(x[order], begin) if len(begin) else x
    same = raw is near
    near = add(near)
    return key[begin], [c[order[begin]] for c in cols], near, near if same else add(raw)


def _counted(texts: DataFrame, at: Layout) -> DataFrame:
    """Blocks of the phrases of ``order`` tokens, and of the shorter ones that begin with a text's start."""
    order = at.order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for k, parts in held.items():
                cols = [np.concatenate([p[j] for p in parts]) for j in range(k)]
                parts.clear()
                one = np.ones(len(cols[0]), np.int64)
                _, cols, near, raw = _merged(cols, one, one)
                if len(near):
                    yield from _blocks(cols, near, raw, at)
            held.clear()

        for batch in batches:
            for tokens, _, place in sequences(batch.column(0), order, CHUNK):
                for k in range(min(2, order), order + 1):
                    cols, ends = phrases(tokens, place, k, exact=k < order)
                    held.setdefault(k, []).append(cols)
                    size += len(ends)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    return texts.mapInArrow(count, _BLOCK)


def _statistics(n: np.ndarray) -> list[int]:
    """How many phrases have a count of 1, 2, 3, 4, how many there are, and the sum of their counts."""
    return [*(int((n == c).sum()) for c in (1, 2, 3, 4)), len(n), int(n.sum())]


def _reduced(blocks: DataFrame, level: int, at: Layout, partitions: int) -> DataFrame:
    """Merge the blocks of ``level`` by shard and store them; rows: blocks of the next level, and statistics
    (size -1: of the level, -2: of a heavy context)."""

    def finish(parts: list) -> Iterator[pa.RecordBatch]:
        shard = parts[0]["shard"]
        open_ = [_unblock(p) for p in parts]
        parts.clear()
        cols = [np.concatenate([o[0][j] for o in open_]) for j in range(level)]
        near, raw = np.concatenate([o[1] for o in open_]), np.concatenate([o[2] for o in open_])
        del open_
        key, cols, near, raw = _merged(cols, near, raw)
        note = lambda size, first, values: arrow(_BLOCK, {
            "level": [level], "shard": [shard], "size": [size], "first": [np.array([first], U).tobytes()], "runs": [b""], "rest": [b""],
            "near": [np.array(values, np.int64).tobytes()], "raw": [b""]})
        yield note(-1, 0, [*_statistics(near), int(raw.sum())])
        values = [near, raw] if level == 1 else [near]
        store(f"{at.file('phrases', level)}/{shard:06d}", [key, *map(_narrow, values)])
        if level == 1:
            return
        context = phrase_key(cols[:-1])
        by = np.argsort(context, kind="stable")
        context, n = context[by], near[by]
        begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        each = [np.add.reduceat(x, begin) for x in (n, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n > 2).astype(np.int64))]
        context = context[begin]
        hot = np.isin(context, at.heavy)
        for i in np.flatnonzero(hot):  # complete only with the other shards
            yield note(-2, context[i], [int(x[i]) for x in each])
        store(f"{at.file('contexts', level)}/{shard:06d}", [context[~hot], *(_narrow(x[~hot]) for x in each)])
        # how many tokens stand before what is left without the first
        _, shorter, before, total = _merged(cols[1:], np.ones(len(key), np.int64), raw.astype(np.int64))
        yield from _blocks(shorter, before, total, at)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["size"] < 0 or row["level"] < level:  # passes through
                    yield batch.slice(i, 1)
                    continue
                if parts and parts[0]["shard"] != row["shard"]:
                    yield from finish(parts)
                    parts = []
                parts.append(row)
        if parts:
            yield from finish(parts)

    return blocks.repartition(partitions, "shard").sortWithinPartitions("shard").mapInArrow(merge, _BLOCK)


def heavy_contexts(texts: DataFrame, shards: int) -> np.ndarray:
    """Hashes of the words with more than about an eighth of a shard's share of all tokens: at most ``8 * shards``."""
    share = 16 * shards

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        counts, total = {}, 0

        def add() -> None:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            for k, c in zip(key[n * share > n.sum()].tolist(), n[n * share > n.sum()].tolist(), strict=True):
                counts[k] = counts.get(k, 0) + c
            held.clear()

        for batch in batches:
            for tokens, _, _ in sequences(batch.column(0), 2, CHUNK):
                held.append(tokens[tokens != END])
                total += len(held[-1])
                if sum(map(len, held)) >= CHUNK:
                    add()
        if held:
            add()
        key = np.array([*counts, 0], U)
        yield arrow("key long, n long, tokens long", {"key": key.astype(np.int64), "n": [*counts.values(), 0], "tokens": [*(0 for _ in counts), total]})

    found = texts.mapInArrow(often, "key long, n long, tokens long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))
    total = found.agg(F.sum("tokens")).first()[0] or 0
    keys = found.filter(F.col("n") * 8 * shards > total).select("key").collect()  # at most 8 * shards
    return np.sort(np.array([r[0] for r in keys], np.int64).astype(U))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float, float]:
    """What counts of 0, 1, 2 and more than 2 lose."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x < k for k, x in enumerate(d, 1)):
            return (0.0, *d)
    return 0.0, 0.5, 1.0, 1.5


@dataclass
class Model:
    layout: Layout
    tokens: int  # in training texts
    words: int  # different tokens
    total: int  # sum of the counts of single tokens
    lost: list[tuple]  # discounts by level, from 1 on
    rare: tuple[int, int, int]  # single tokens with a count of 1, 2 and more
    hot: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # level: heavy contexts, their sums


def train(texts: DataFrame, order: int = ORDER, path: str | None = None, shard_bytes: int = SHARD_BYTES) -> Model:
    """Model of ``texts(text)``, stored under ``path`` (by default a scratch folder in the shared folder)."""
    spark = texts.sparkSession
    texts = texts.select("text")
    shards = max(8, partitions_for(texts, shard_bytes) if shard_bytes else 8)
    at = Layout((path or scratch_path(spark, "llm-language-model")).rstrip("/"), order, shards, heavy_contexts(texts, shards))
    rows = _counted(texts, at)
    for level in range(order, 0, -1):
        rows = _reduced(rows, level, at, shards)
    notes = rows.select("level", "size", "first", "near")
    sums: dict[int, np.ndarray] = {}
    hot: dict[int, dict[int, np.ndarray]] = {}
    for r in notes.toLocalIterator():  # a row for each level and shard, and for each heavy context and shard
        v = np.frombuffer(r.near, np.int64)
        if r.size == -1:
            sums[r.level] = sums.get(r.level, 0) + v
        else:
            own = hot.setdefault(r.level, {})
            k = int(np.frombuffer(r.first, U)[0])
            own[k] = own.get(k, 0) + v
    none = np.zeros(7, np.int64)
    one = sums.get(1, none)
    lost = [discounts(*sums.get(k, none)[:4].tolist()) for k in range(1, order + 1)]
    arrays = {k: (np.array(sorted(v), U), np.array([v[x] for x in sorted(v)])) for k, v in hot.items()}
    return Model(at, int(one[6]), int(one[4]), int(one[5]), lost, (int(one[0]), int(one[1]), int(one[4] - one[0] - one[1])), arrays)


# ------------------------------------------------------------------ scoring


def _discounted(n: np.ndarray, lost: tuple) -> np.ndarray:
    return n - np.array(lost)[np.minimum(n, 3)]


def token_scores(tokens: np.ndarray, place: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(where, probability, count)`` of the predicted tokens; ``count``: occurrences in training texts."""
    at = model.layout
    each, back = np.unique(tokens, return_inverse=True)
    near, raw = look_up(at.file("phrases", 1), at.shard(None, each), each, 2)
    one = 1.0 / (model.words + 1)
    if model.total:
        free = sum(d * n for d, n in zip(model.lost[0][1:], model.rare, strict=True)) / model.total
        p = _discounted(near, model.lost[0]) / model.total + free * one
    else:
        p = np.full(len(each), one)
    where = np.flatnonzero(place > 0)
    p, raw = p[back[where]], raw[back[where]]
    for k in range(2, at.order + 1):
        cols, ends = phrases(tokens, place, k, exact=False)
        if not len(ends):
            break
        lost, key, context = model.lost[k - 1], phrase_key(cols), phrase_key(cols[:-1])
        n = look_up(at.file("phrases", k), at.shard(context, key), key, 1)[0]
        some, again = np.unique(context, return_inverse=True)
        sums = np.array(look_up(at.file("contexts", k), at.spread(some), some, 4))
        if k in model.hot:
            keys, values = model.hot[k]
            i = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
            hot = keys[i] == some
            sums[:, hot] = values[i[hot]].T
        total, sums = sums[0][again], sums[1:]
        rest = (np.array(lost[1:])[:, None] * sums).sum(0)[again]
        known = total > 0
        i = np.searchsorted(where, ends)[known]
        p[i] = (_discounted(n[known], lost) + rest[known] * p[i]) / total[known]
    return where, p, raw


def score(df: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row of ``df(doc_id, text)``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            rows = batch.num_rows
            sums = [np.zeros(rows) for _ in range(4)]
            for tokens, row, place in sequences(batch.column(1), m.layout.order, CHUNK):
                where, p, raw = token_scores(tokens, place, m)
                base = np.log10((raw + 1) / (m.tokens + m.words + 1))
                for s, x in zip(sums, (None, raw > 0, base, np.log10(p)), strict=True):
                    s += np.bincount(row[where], x, rows)
            n, known, base, own = sums
            yield arrow(schema, {"doc_id": batch.column(0), "n_tokens": n.astype(np.int64), "n_known": known.astype(np.int64),
                                 "train_tokens": np.full(rows, m.tokens), "base_score": base, "score": own})

    return df.select("doc_id", "text").mapInArrow(run, schema)


def score_held_out(df: DataFrame, order: int = ORDER) -> DataFrame:
    """Every document scored by a model of those that aren't held out."""
    model = train(df.filter(~held_out()).select("text"), order)
    found = score(df, model)
    return found.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
