import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import docs, odd_rows

from tidemark.llm import kneser_ney as kn

LOWER = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return ["<s>", *re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "</s>"]


class Brute:
    """Counts in dictionaries, probabilities by the textbook."""

    def __init__(self, texts, order):
        self.order = order
        self.count = [None] + [Counter() for _ in range(order)]
        self.raw = Counter()
        before = defaultdict(set)
        for t in texts:
            seq = tokens(t)
            self.raw.update(seq[1:])
            for i in range(1, len(seq)):
                for k in range(1, order + 1):
                    if i - k + 1 >= 0:
                        g = tuple(seq[i - k + 1 : i + 1])
                        if k == order or g[0] == "<s>":
                            self.count[k][g] += 1
                    if k < order and i - k >= 0:
                        before[tuple(seq[i - k + 1 : i + 1])].add(seq[i - k])
        for g, s in before.items():
            self.count[len(g)][g] = len(s)
        self.lost, self.sums = [None], [None]
        for k in range(1, order + 1):
            of = Counter(self.count[k].values())
            self.lost.append(kn.discounts(*(of[c] for c in (1, 2, 3, 4))))
            sums = defaultdict(lambda: [0, 0.0])
            for g, c in self.count[k].items():
                sums[g[:-1]][0] += c
                sums[g[:-1]][1] += self.lost[k][min(c, 3)]
            self.sums.append(sums)

    def p(self, context, word):
        out = 1.0 / (len(self.raw) + 1)
        for k in range(1, min(self.order, len(context) + 1) + 1):
            own = tuple(context[len(context) - k + 1 :])
            if own in self.sums[k]:
                total, free = self.sums[k][own]
                c = self.count[k].get((*own, word), 0)
                out = (c - self.lost[k][min(c, 3)]) / total + free / total * out
        return out

    def score(self, text):
        seq = tokens(text)
        n, v = sum(self.raw.values()), len(self.raw)
        base = sum(math.log10((self.raw[w] + 1) / (n + v + 1)) for w in seq[1:])
        return len(seq) - 1, sum(w in self.raw for w in seq[1:]), n, base, sum(math.log10(self.p(seq[:i], seq[i])) for i in range(1, len(seq)))


def out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def check(df, rows, order):
    model = Brute([t for d, t in rows if not out(d)], order)
    got = sorted(map(tuple, kn.score_held_out(df, order).collect()), key=repr)
    want = sorted([(d, out(d), *model.score(t)) for d, t in rows], key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(sorted(got, key=lambda x: (repr(x[:5]), x[5:])), sorted(want, key=lambda x: (repr(x[:5]), x[5:])), strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return got


def make(seed, n, vocabulary=60):
    rnd = random.Random(seed)
    nxt = defaultdict(lambda: [rnd.randrange(vocabulary) for _ in range(5)])
    rows = []
    for i in range(n):
        w, text = 0, []
        for _ in range(rnd.randrange(0, 40)):
            w = rnd.choice(nxt[w]) if rnd.random() < 0.8 else min(rnd.randrange(vocabulary), rnd.randrange(vocabulary))
            text.append(rnd.choice(["{}", "{}", "W{}", "é{}"]).format(w))
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(text)))
    return rows


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_the_textbook(spark, order):
    rows = make(1, 300)
    got = check(docs(spark, rows), rows, order)
    held = [g for g in got if g[1]]
    assert order < 2 or sum(g[6] for g in held) > sum(g[5] for g in held)


def test_many_blocks_shards_and_heavy_contexts(spark, monkeypatch):
    monkeypatch.setattr(kn, "FLUSH", 500)
    monkeypatch.setattr(kn, "CHUNK", 100)
    rows = make(2, 200) + [(1000 + i, "the " + " the ".join(f"x{i}{j}" for j in range(20))) for i in range(60)]
    df = docs(spark, rows).repartition(5)
    model = kn.train(df.select("text"), 2)
    assert len(model.layout.heavy) and 2 in model.hot
    check(df, rows, 2)


def test_probabilities_add_up_to_one(spark):
    rows = make(3, 150, 20)
    model = kn.train(docs(spark, rows).select("text"), 3)
    words = sorted({w for _, t in rows for w in tokens(t)[1:-1]})
    for context in ("", "1 2", "never seen", words[0], f"{words[3]} {words[4]}"):
        total = 0.0
        for w in [*words, None, "unknown-word"]:
            text = context if w is None else f"{context} {w}"
            for seq, _, place in kn.sequences(pa.array([text]), 3, 1000):
                _, p, _ = kn.token_scores(seq, place, model)
                total += p[-1] if w is None else p[-2]
        assert total == pytest.approx(1.0, abs=1e-9)


def test_cut_sequences_keep_their_contexts():
    from tidemark.llm import tokens as tk

    rnd = random.Random(4)
    long = " ".join(f"w{rnd.randrange(9)}" for _ in range(3 * tk.SLAB // 3))
    column = pa.array(["a b", None, long, "", long[:50], "c"])
    for order in (2, 3):
        whole = [x for x in kn.sequences(column, order, 1 << 30)]
        assert len(whole) == 1
        seq, row, place = whole[0]
        parts = list(kn.sequences(column, order, 1000))
        assert len(parts) > 3
        for k in range(1, order + 1):
            cols, ends = kn.phrases(seq, place, k, exact=False)
            keys, rows = kn.phrase_key(cols), row[ends]
            cut = [(kn.phrase_key(kn.phrases(s, p, k, exact=False)[0]), r[kn.phrases(s, p, k, exact=False)[1]]) for s, r, p in parts]
            assert np.array_equal(keys, np.concatenate([c[0] for c in cut])) and np.array_equal(rows, np.concatenate([c[1] for c in cut]))


def test_odd_rows_clashing_names_and_empty_table(spark):
    rows = odd_rows()
    check(docs(spark, rows, extra=True), rows, 2)
    assert kn.score_held_out(docs(spark, [])).count() == 0
    only = [d for d in range(100) if out(d)][:3]  # nothing to learn from
    for r in kn.score_held_out(docs(spark, [(d, "some words") for d in only])).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)
