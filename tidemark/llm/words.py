"""Vectorised word hashing: texts to arrays of 64-bit word hashes without a Python loop over words.

A word is a maximal run of ASCII letters, ASCII digits, ``_`` and non-ASCII
characters of the lower-cased text. Each word gets a polynomial hash modulo
2**64 of its UTF-8 bytes, read off one running sum over all bytes, so the cost
is a few numpy passes over the bytes whatever the number of words. Texts are
handled whole, in slabs of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

U = np.uint64
SLAB = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_WORD = np.zeros(256, bool)
for _a, _b in ((48, 58), (95, 96), (97, 123), (128, 256)):
    _IS_WORD[_a:_b] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def lowered(text: str) -> str:
    """Lower case with one character for each character, so that positions stay those of ``text``."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = SLAB
    while size < n:
        size *= 2
    if size not in _powers:
        with np.errstate(over="ignore"):
            up = np.multiply.accumulate(np.concatenate([[U(1)], np.full(size, U(_BASE))]))
            down = np.multiply.accumulate(np.concatenate([[U(1)], np.full(size, U(_INVERSE))]))
        if size > SLAB:
            return up, down
        _powers[size] = (up, down)
    return _powers[size]


def _slab(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word of one slab."""
    b = np.frombuffer(data, np.uint8)
    word = _IS_WORD[b]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    first, end = edge[0::2], edge[1::2]
    up, down = _power(len(b))
    with np.errstate(over="ignore"):
        total = np.concatenate([[U(0)], np.cumsum((b.astype(U) + U(1)) * up[: len(b)])])
        h = (total[end] - total[first]) * down[first]
        return mix(h + U(1) * (end - first).astype(U)), first, end


def _cuts(data: bytes) -> list[int]:
    """Slab borders of one text, each at a byte that is no word byte (a word longer than a slab stays whole)."""
    cuts, at = [0], 0
    while len(data) - at > SLAB:
        cut = at + SLAB
        back = data.rfind(b" ", at, cut)
        if back <= at:
            step = np.flatnonzero(~_IS_WORD[np.frombuffer(data, np.uint8, offset=cut)])
            cut = cut + int(step[0]) if len(step) else len(data)
        else:
            cut = back
        if cut >= len(data):
            break
        cuts.append(cut)
        at = cut
    return [*cuts, len(data)]


def word_hashes(texts: Sequence[str | None], positions: bool = False):
    """``(hashes, offsets)``: the words of text ``i`` are ``hashes[offsets[i]:offsets[i + 1]]``.

    With ``positions`` also the first and end character of every word in its
    text. Null and wordless texts have no words."""
    parts, counts, firsts, ends = [], np.zeros(len(texts), np.int64), [], []
    hold: list[tuple[int, bytes]] = []

    def flush() -> None:
        if not hold:
            return
        joined = b"\n".join(d for _, d in hold)
        h, first, end = _slab(joined)
        starts = np.cumsum([0, *(len(d) + 1 for _, d in hold)])
        owner = np.searchsorted(starts, first, "right") - 1
        counts[[i for i, _ in hold]] += np.bincount(owner, minlength=len(hold))
        parts.append(h)
        if positions:
            b = np.frombuffer(joined, np.uint8)
            chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
            base = chars[starts[:-1]][owner]
            firsts.append(chars[first] - base)
            ends.append(chars[end] - base)
        hold.clear()

    held = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        data = lowered(text).encode("utf-8", "surrogatepass")
        if len(data) > SLAB:
            flush()
            held = 0
            cuts, shift = _cuts(data), 0
            for a, z in zip(cuts, cuts[1:], strict=False):
                h, first, end = _slab(data[a:z])
                counts[i] += len(h)
                parts.append(h)
                if positions:
                    chars = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8, z - a, a) & 0xC0) != 0x80)])
                    firsts.append(chars[first] + shift)
                    ends.append(chars[end] + shift)
                    shift += int(chars[-1])
            continue
        if held + len(data) > SLAB:
            flush()
            held = 0
        hold.append((i, data))
        held += len(data) + 1
    flush()
    offsets = np.concatenate([[0], np.cumsum(counts)])
    hashes = np.concatenate(parts) if parts else np.zeros(0, U)
    if not positions:
        return hashes, offsets
    none = np.zeros(0, np.int64)
    return hashes, offsets, np.concatenate(firsts) if firsts else none, np.concatenate(ends) if ends else none


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words; a text of fewer words (but one at least) is one shingle."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    with np.errstate(over="ignore"):
        h = np.zeros(n - width + 1, U)
        for i in range(width):
            h = h * U(_BASE) + words[i : n - width + 1 + i]
        return mix(h + U(width))


def sequence_key(words: np.ndarray) -> int:
    """Signed 64-bit key of a whole word sequence."""
    n = len(words)
    with np.errstate(over="ignore"):
        place = mix(np.arange(1, n + 1, dtype=U) * U(_BASE))
        total = np.bitwise_xor.reduce(mix(words + place)) if n else U(0)
        total = mix(np.array([total + U(n)], U))[0]
    return int(total.astype(np.int64))
