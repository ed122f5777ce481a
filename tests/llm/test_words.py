import re

import numpy as np
from llm_data import odd_rows, words

from tidemark.llm import words as W

WORD = re.compile(r"[a-z0-9_\u0080-\U0010ffff]+")


def test_words_and_positions_match_a_pattern():
    import random

    rnd = random.Random(1)
    texts = [t for _, t in odd_rows()] + [words(rnd, 90000), "ü" * 400000, "Äb " * 100, None]
    h, cut, first, last = W.word_hashes(texts, positions=True)
    seen = {}
    for i, t in enumerate(texts):
        found = [(m[0], m.start(), m.end()) for m in WORD.finditer(W.lowered(t or ""))]
        a, z = cut[i], cut[i + 1]
        assert [(int(x), int(y)) for x, y in zip(first[a:z], last[a:z])] == [f[1:] for f in found]
        for x, (word, _, _) in zip(h[a:z].tolist(), found):
            assert seen.setdefault(word, x) == x
    assert len(set(seen.values())) == len(seen)  # no two words share a hash
    assert np.array_equal(W.word_hashes(texts)[0], h)


def test_shingles_and_keys():
    h, _ = W.word_hashes(["a b c d e f", "a b c d e f", "f e d c b a", "a b"])
    assert len(W.shingles(h[:6], 5)) == 2 and len(W.shingles(h[18:], 5)) == 1
    assert W.sequence_key(h[:6]) == W.sequence_key(h[6:12]) != W.sequence_key(h[12:18])
