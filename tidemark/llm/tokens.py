"""Vectorised tokens: the words of an Arrow text column as arrays of 64-bit hashes, without a Python object for each word.

A reader says by a table of 256 entries what each byte is: part of a word, a
blank between words, or a break that no phrase crosses. ``A``-``Z`` are
lower-cased, nothing else is. UTF-8 bytes beyond ASCII are always part of a word, so
words are those of the text. A word's hash is a polynomial of its bytes
modulo 2**64, read off one running sum over all bytes of a slab.

Texts are handled whole in slabs of about ``SLAB`` bytes; a text longer than
that is cut where no word or phrase is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemark.llm.words import SLAB, _power, mix

U = np.uint64
WORD, BLANK, BREAK = 0, 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_table(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    """Kind of every byte: ``BLANK``, ``BREAK`` or, for all others, ``WORD``."""
    table = np.zeros(256, np.uint8)
    table[list(blanks)] = BLANK
    table[list(breaks)] = BREAK
    return table


@dataclass
class Words:
    """The words of a slab: lower-cased bytes, and for each word its hash, first and end byte, row and piece.

    ``row`` counts from ``row0`` of the batch. Two neighbouring words of one
    row belong to one phrase if their ``piece`` is the same."""

    data: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    end: np.ndarray
    row: np.ndarray
    piece: np.ndarray

    def text(self, at: int, count: int = 1) -> bytes:
        """``count`` words from word ``at`` on, joined by one blank each."""
        return b" ".join(self.data[self.first[i] : self.end[i]].tobytes() for i in range(at, at + count))


_sums = np.empty(SLAB + 1, U)


def word_hash(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    up, down = _power(n)
    total = _sums[: n + 1] if n <= SLAB else np.empty(n + 1, U)
    with np.errstate(over="ignore"):
        total[0] = 0
        np.add(data, U(1), out=total[1:], dtype=U)
        np.multiply(total[1:], up[:n], out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        return mix((total[end] - total[first]) * down[first] + (end - first).astype(U))


def hash_of(word: str) -> int:
    """Hash of one word, the same as that of its occurrences."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(word_hash(data, np.array([0]), np.array([len(data)]))[0])


def _words(data: np.ndarray, table: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> Words:
    """``starts``: first byte of each text in ``data``; ``rows``: its row."""
    kind = table.take(data)
    inside = kind == WORD
    edge = np.diff(inside, prepend=False, append=False)
    cuts = np.unique(starts[(starts > 0) & (starts < len(data))])  # empty texts begin where the next one does
    edge_at = np.flatnonzero(edge)
    # a word never runs over the border of two texts: cut it there
    joined = cuts[inside[cuts] & inside[cuts - 1]] if len(cuts) else cuts
    if len(joined):
        edge_at = np.sort(np.concatenate([edge_at, joined, joined]))
    first, end = edge_at[0::2], edge_at[1::2]
    low = _LOWER.take(data)
    owner = np.searchsorted(starts, first, "right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == BREAK), first) + owner  # grows at each break and each text
    return Words(low, word_hash(low, first, end), first, end, rows[owner], piece)


def _long(data: np.ndarray, table: np.ndarray, row: int) -> Iterator[Words]:
    """One long text in slabs cut after a break (after a blank if the table knows no breaks)."""
    stops = np.flatnonzero(table.take(data) == (BREAK if (table == BREAK).any() else BLANK)) + 1
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > SLAB:
            k = int(np.searchsorted(stops, at + SLAB, "right"))  # the last stop that fits, else the next one
            if k and stops[k - 1] > at:
                end = int(stops[k - 1])
            elif k < len(stops):
                end = int(stops[k])
        yield _words(data[at:end], table, np.array([0]), np.array([row]))
        at = end


def slabs(column: pa.Array, table: np.ndarray) -> Iterator[Words]:
    """The words of a string column (null: no words), slab after slab in row order.

    A row's words may come in several slabs only if its text is longer than ``SLAB``."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return
    data = np.frombuffer(column.buffers()[2], np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLAB, "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        if len(part) > SLAB:
            yield from _long(part, table, i)
        elif len(part):
            yield _words(part, table, offsets[i:j] - offsets[i], np.arange(i, j))
        i = j
