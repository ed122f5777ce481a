"""Small hand-made tables for the tests of the training-data operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names an operator might use itself.
CLASHING = "id long, row long, size long, shard string, slot string, target string, score string, bucket long, text_key string, root long, start long"


def words(rnd, n, vocabulary=4000):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def docs(spark, rows, extra=False):
    """``rows``: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    if extra:
        full = [(*r, 1, 2, 3, "x", "y", "z", "s", 7, "k", 9, 5) for r in full]
        return spark.createDataFrame(full, f"{DOCS}, {CLASHING}")
    return spark.createDataFrame(full, DOCS)


def odd_rows(seed=5):
    """Nulls, empty and very long texts, ties, repeated rows, and signs beyond the basic plane."""
    rnd = random.Random(seed)
    long = "\n".join(words(rnd, 400) for _ in range(150))
    same = words(rnd, 80)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "!!! ... ###"), (None, "no id on this row at all"), (5, long), (6, same), (7, same), (7, same), (7, same),
        (8, "one"), (9, "İstanbul ǅ 𝒳𝒴   ß ﬁ naïve ŐŰ"), (9, "another text under the same id"), (10, "x" * 30000), (11, "a\x00b\r\nc"), (12, None),
    ]
