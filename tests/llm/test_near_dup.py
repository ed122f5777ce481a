import random
from collections import defaultdict

import numpy as np
from conftest import SF_SMALL
from llm_data import docs, odd_rows, words

from tidemark.llm import near_dup as N
from tidemark.llm.words import shingles, word_hashes


def changed(rnd, text, share):
    return " ".join(f"c{rnd.randrange(10**6)}" if rnd.random() < share else w for w in text.split(" "))


def brute_classes(rows, similarity=0.8):
    """Class of every (doc_id, text): smallest doc_id over the links of the five-word shingle sets."""
    h, cut = word_hashes([t for _, t in rows])
    sets = [frozenset(shingles(h[a:z], 5).tolist()) for a, z in zip(cut, cut[1:])]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            by[x].add(i)
    seen = set()
    for group in by.values():
        for i in group:
            for j in group:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                        parent[top(j)] = top(i)
    best = {}
    for i, (d, _) in enumerate(rows):
        if sets[i]:
            r = top(i)
            best[r] = min(best.get(r, (True, 0)), (d is None, d if d is not None else 0))
    return [((None if best[top(i)][0] else best[top(i)][1]) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def check(spark, rows):
    out = N.near_duplicates(docs(spark, rows, extra=True))
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.class_id)
    want = defaultdict(list)
    for (d, _), c in zip(rows, brute_classes(rows)):
        want[d].append(c)
    key = lambda x: (x is None, x or 0)
    assert {d: sorted(c, key=key) for d, c in got.items()} == {d: sorted(c, key=key) for d, c in want.items()}
    return out


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    items = rng.integers(1, 2**63, 300).astype(np.uint64)
    x, y = rng.gamma(1.0, size=300), rng.gamma(1.0, size=300)
    x[:60], y[60:120] = 0, 0
    exact = sum(1 / np.maximum(x / x[d], y / y[d]).sum() for d in range(300) if x[d] and y[d])
    m = 20000
    one = N.probminhash(items[x > 0], x[x > 0], np.zeros((x > 0).sum(), int), 1, m)[0]
    two = N.probminhash(items[y > 0], y[y > 0] * 7, np.zeros((y > 0).sum(), int), 1, m)[0]  # scale doesn't matter
    assert abs((one == two).mean() - exact) < 4 * (exact / m) ** 0.5
    both = N.probminhash(np.concatenate([items[x > 0], items[y > 0]]), np.concatenate([x[x > 0], y[y > 0] * 7]), np.repeat([0, 1], [(x > 0).sum(), (y > 0).sum()]), 2, m)
    assert (both[0] == one).all() and (both[1] == two).all()  # signatures don't depend on the batch
    assert (N.probminhash(items[:0], x[:0], np.zeros(0, int), 2, 8) == 0).all()


def test_classes_match_all_pairs(spark):
    rnd = random.Random(11)
    rows, n = [], 0
    for _ in range(40):
        text = words(rnd, rnd.randrange(20, 200))
        for share in (0.0, 0.0, 0.01, 0.02, 0.04, 0.08, 0.3):
            rows.append((n, changed(rnd, text, share)))
            n += 1
    rows += [(5000 + i, words(rnd, 100)) for i in range(100)] + [(9000 + (d or 0) if d is not None else None, t) for d, t in odd_rows()]
    check(spark, rows)


def test_a_large_group_of_near_copies(spark):
    rnd = random.Random(12)
    text = words(rnd, 150)
    rows = [(i, changed(rnd, text, rnd.choice((0.005, 0.02, 0.05)))) for i in range(400)] + [(1000 + i, text) for i in range(200)]
    check(spark, rows)


def test_one_row_of_each_class_stays(spark):
    rnd = random.Random(13)
    text = words(rnd, 60)
    rows = [(3, text), (2, text + "!"), (2, text + "!"), (2, text + "!"), (7, words(rnd, 60)), (None, text), (8, None), (9, None), (8, None), (10, "")]
    df = docs(spark, rows, extra=True)
    out = N.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.text) == sorted([(2, text + "!"), (7, rows[4][1])])
    assert sorted(r.doc_id for r in out.collect() if not r.text) == [8, 9, 10]
    assert N.drop_near_duplicates(docs(spark, [])).count() == 0 and N.near_duplicates(docs(spark, [])).count() == 0


def test_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(spark, rows)
