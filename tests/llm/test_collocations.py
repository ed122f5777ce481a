import random
import re
from collections import Counter, defaultdict

from llm_data import docs, odd_rows

from tidemark.llm import collocations


def brute(rows, longest=5, least=100, top=2000):
    """All phrases counted by their text; rows are (doc_id, text, lang)."""
    f, n = defaultdict(Counter), Counter()
    lower = {i: i + 32 for i in range(65, 91)}
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = {q[i:j] for q, a in found.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and count[q[i:j]] <= a}
        scored = []
        for p, a in found.items():
            if p not in inside:
                s, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(scored)[:top])]
    return sorted(out)


def frame(spark, rows):
    return docs(spark, [(d, t, lang, "s") for d, t, lang in rows])


def make(seed, n, vocabulary, least=40):
    rnd = random.Random(seed)
    fixed = ["New York City", "the Quick brown fox jumps", "a b a b a", "é è ê", "x x x x x x"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(0, least)):
            parts.append(rnd.choice(fixed) if rnd.random() < 0.3 else f"w{min(rnd.randrange(vocabulary), rnd.randrange(vocabulary))}")
            parts.append(rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "]))
        rows.append((i, "".join(parts), rnd.choice(["en", "en", "de", None])))
    return rows


def test_empty_texts_between_others_add_no_words(spark):
    rows = [(i, ["ab cd", "", None, "", "ab cd"][i % 5], "en") for i in range(600)]
    same(frame(spark, rows), rows)


def test_a_language_named_like_a_word(spark):
    rows = [(i, "es x en y es", "en") for i in range(150)] + [(i, "en z es en q", "es") for i in range(130)]
    same(frame(spark, rows), rows)


def same(df, rows, **params):
    assert sorted(tuple(r) for r in collocations.collocations(df, **params).collect()) == brute(rows, **params)


def test_rows_equal_a_count_of_all_phrases(spark):
    rows = make(1, 900, 9)
    assert len(brute(rows)) > 20
    same(frame(spark, rows), rows)


def test_short_top_and_streams_over_many_partitions(spark):
    rows = make(2, 400, 25)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")  # borders between a phrase and its parts
    try:
        same(frame(spark, rows).repartition(3), rows, least=3, top=15)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_few_bits_only_cost_rows(spark, monkeypatch):
    rows = make(3, 200, 30)
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 16)
    same(frame(spark, rows), rows, least=20)


def test_long_texts_overlaps_odd_rows_and_clashing_names(spark):
    rows = [(d, t, "en") for d, t in odd_rows()] + [(50, "a a " * 90 + "b c. " * 120_000, None), (51, "\x00q \x1f q" * 130, "zz")]
    df = docs(spark, [(d, t, lang, "s") for d, t, lang in rows], extra=True)
    same(df, rows)
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(1, None, None), (2, "", "en"), (3, "rare words", "en")])).count() == 0
