import random
import re

import numpy as np
from conftest import SF_MED
from llm_data import docs, odd_rows, words

from tidemark.llm import decontam as D
from tidemark.llm import queries


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, 5) for r in rows], "item_id long, text string, edits int")


def fewest_edits(item, text):
    """Fewest word edits between the item and any run of the text's words."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def edited(rnd, item, n):
    out = list(item)
    for _ in range(n):
        at = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out[at] = f"new{rnd.randrange(10**6)}"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, f"more{rnd.randrange(10**6)}")
    return out


def test_banded_edits_match_the_full_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size, most = int(rng.integers(1, 12)), int(rng.integers(0, 4))
        text, goal = rng.integers(0, 3, 15).astype(np.uint64), rng.integers(0, 3, size).astype(np.uint64)
        start = int(rng.integers(0, 15))
        end = int(rng.integers(start, 16))
        edits, length = D._banded(text, np.array([end]), np.array([start]), goal[None], most)
        # the window begins at start; its end is free
        table = [list(range(end - start + 1))]
        for i, x in enumerate(goal, 1):
            row = [i]
            for j, y in enumerate(text[start:end], 1):
                row.append(min(table[-1][j] + 1, row[-1] + 1, table[-1][j - 1] + (x != y)))
            table.append(row)
        want = min(table[-1])
        assert (edits[0] == want) if want <= most else edits[0] > most
        if want <= most:
            assert table[-1][length[0]] == want


def test_planted_items_match_brute_force(spark):
    rnd = random.Random(6)
    items = [(i, words(rnd, rnd.choice((6, 15, 30, 59)), 500).split(" ")) for i in range(30)]
    rows = []
    for d in range(300):
        body = words(rnd, rnd.randrange(0, 120), 500).split(" ")
        if d % 2:
            item = rnd.choice(items)[1]
            at = rnd.randrange(len(body) + 1)
            body[at:at] = edited(rnd, item, rnd.randrange(0, int(0.2 * len(item)) + 2))
        rows.append((d, " ".join(body)))
    want = {(d, i) for d, t in rows for i, item in items if fewest_edits(item, t.split(" ")) <= D.edits_allowed(len(item), 0.8)}
    df = docs(spark, rows, extra=True)
    bench = benchmark(spark, [(i, " ".join(w).upper()) for i, w in items])
    out = D.contaminated(df, bench).collect()
    got = {(r.doc_id, r.item_id) for r in out}
    assert got <= want and len(want - got) <= 0.01 * len(want), want - got
    text = dict(rows)
    for r in out:
        item = dict(items)[r.item_id]
        assert fewest_edits(item, text[r.doc_id].split(" ")) == r.edits == fewest_edits(item, text[r.doc_id][r.start : r.end].split(" "))
    clean = {r.doc_id for r in D.drop_contaminated(df, bench).collect()}
    assert clean == {d for d, _ in rows} - {d for d, _ in got} and D.drop_contaminated(df, bench).columns == df.columns


def test_blocks_odd_rows_and_empty_tables(spark):
    rnd = random.Random(7)
    item = words(rnd, 40)
    bench = benchmark(spark, [(1, None), (2, ""), (3, "..."), (4, item), (4, item), (None, "one"), (6, "two words")])
    df = docs(spark, [*odd_rows(), (30, item), (30, item), (31, "here are two words"), (32, item.upper() + "?")], extra=True)
    got = sorted((r.doc_id or 0, r.item_id or 0) for r in D.contaminated(df, bench).collect())
    # item 4 occurs twice, and so does document 30
    assert got == sorted([(8, 0), (31, 6), (30, 4), (30, 4), (30, 4), (30, 4), (32, 4), (32, 4)])
    assert D.drop_contaminated(df, bench).count() == df.count() - 5
    assert [len(b) for b in D.blocks(bench, 300)] != [7] and sum(len(b) for b in D.blocks(bench, 300)) == 7
    assert D.contaminated(docs(spark, []), bench).count() == 0 and D.contaminated(df, bench.limit(0)).count() == 0
    assert D.drop_contaminated(df, bench.limit(0)).count() == df.count()


def test_all_exact_items_of_the_table(spark):
    tokens = lambda t: " " + " ".join(re.findall(r"[a-z0-9_\u0080-\U0010ffff]+", (t or "").lower())) + " "
    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{SF_MED}/benchmark.parquet").collect()}
    texts = {r.doc_id: tokens(r.text) for r in spark.read.parquet(f"{SF_MED}/documents.parquet").collect()}
    want = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id): r.edits for r in queries.op1_random_walk_decontamination(spark, SF_MED).collect()}
    assert want and want <= set(got) and {k for k, e in got.items() if e == 0} == want
