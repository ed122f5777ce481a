import hashlib
import random
import re
from collections import Counter, defaultdict

from llm_data import docs, odd_rows, words

from tidemark.llm import mixing


def key(doc_id, text):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    return int(md5(f"{'' if doc_id is None else doc_id}:{md5(text or '')}")[:15], 16)


def brute(rows):
    """Targets by repeated sharing, taken words by sorting; rows are (doc_id, text, source)."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(int)
    for _, t, s in rows:
        by[s] += size(t)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    w = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(by.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * by[s] for s in capped)
        share = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if w[s] * share > 3 * by[s]}
        if not over:
            break
        capped |= over
    target = {s: 3.0 * by[s] if s in capped else w[s] * share for s in names}
    out = Counter()
    for s in names:
        if not by[s]:
            continue
        whole = 3 if target[s] >= 3 * by[s] else int(target[s] // by[s])
        budget, run = int(target[s] - whole * by[s]), 0
        for d, t, _ in sorted((r for r in rows if r[2] == s and size(r[1])), key=lambda r: key(r[0], r[1])):
            run += size(t)
            out[d, t, s, size(t) * (whole + (run <= budget))] += 1
    for d, t, s in rows:
        if not size(t):
            out[d, t, s, 0] += 1
    return target, by, out


def make(seed, n=600):
    rnd = random.Random(seed)
    names = ["a", "b", "c", "é", "z", None, "big"]
    return [(i, words(rnd, rnd.randrange(0, 30)), "big" if rnd.random() < 0.5 else rnd.choice(names)) for i in range(n)]


def test_taken_words_match_sorting(spark):
    rows = make(1)
    rows += [(7000, "the same row again", "a")] * 60 + [(d, t, "odd") for d, t in odd_rows() if d != 5]
    target, by, want = brute(rows)
    df = docs(spark, [(d, t, "en", s) for d, t, s in rows])
    out = mixing.mix_digest(df).collect()
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r["size"], r.taken) for r in out) == Counter({(k[0], len(re.findall(r"[^\x20\x09-\x0D]+", k[1] or "")), k[3]): 0 for k in want}) + sum((Counter({(k[0], len(re.findall(r"[^\x20\x09-\x0D]+", k[1] or "")), k[3]): n}) for k, n in want.items()), Counter())
    taken = defaultdict(int)
    for r in out:
        taken[round(r.target, 6), r.source_size] += r.taken
        assert r.taken <= 3 * r["size"]
    assert {k for k in taken} == {(round(target[s], 6), by[s]) for s in by}
    assert all(abs(v - k[0]) <= 81 for k, v in taken.items())


def test_mixed_rows_agree_with_the_digest_and_reruns(spark):
    rows = make(2, 300)
    df = docs(spark, [(d, t, "en", s) for d, t, s in rows], extra=True)
    first = sorted((r.doc_id, r["size"], r.taken) for r in mixing.mix_digest(df).collect())
    assert first == sorted((r.doc_id, r["size"], r.taken) for r in mixing.mix_digest(df.repartition(5)).collect())
    out = mixing.mix(df)
    assert out.columns == df.columns
    times = Counter(r.doc_id for r in out.collect())
    assert times == Counter({d: t // s for d, s, t in first if t})


def test_empty_table_and_texts_without_words(spark):
    assert mixing.mix_digest(docs(spark, [])).count() == 0 and mixing.mix(docs(spark, [])).count() == 0
    out = mixing.mix_digest(docs(spark, [(1, None, None, None), (2, " \n", None, "x")])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in out] == [(0, 0, 0.0, 0)] * 2
    assert mixing.mix(docs(spark, [(1, None, None, None)])).count() == 0
