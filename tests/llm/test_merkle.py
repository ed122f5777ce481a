import hashlib
import random
import zlib
from collections import Counter

from llm_data import docs, odd_rows

from tidemark.llm import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(nodes):
    return [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]


def brute(rows):
    """Whole trees, level by level; rows are (doc_id, text, lang, source, n_chars)."""
    digest = lambda d, t, lang, s, n: sha(field(d) + field(s) + field(lang) + field(n) + field(t))
    leaves = {}
    for r in rows:
        leaves.setdefault(r[2], []).append((r[0], digest(*r), r))
    order = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        leaves[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        levels = [[x[1] for x in leaves[lang]]]
        while len(levels[-1]) > 1:
            levels.append(up(levels[-1]))
        trees[lang] = levels
    top = [[trees[lang][-1][0] for lang in order]]
    while len(top[-1]) > 1:
        top.append(up(top[-1]))
    out = Counter()
    for k, lang in enumerate(order):
        for i, (d, leaf, r) in enumerate(leaves[lang]):
            tampered = d is not None and zlib.crc32(str(d).encode()) % 7 == 0 and r[4] is not None
            node, proof = (digest(*r[:4], r[4] + 1) if tampered else leaf), ""
            for levels, at in ((trees[lang], i), (top, k)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    node = sha(other + node if at & 1 else node + other)
                    proof += other
                    at //= 2
            out[d, leaf, trees[lang][-1][0], top[-1][0], sha(proof), node, node == top[-1][0]] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def random_rows(seed, sizes):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(10**6), f"text {i} é", lang, rnd.choice(["a", "b", None]), rnd.choice([None, i])) for lang, n in sizes.items() for i in range(n)]
    rnd.shuffle(rows)
    return rows


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_rows_equal_whole_trees_at_any_stored_height(spark):
    rows = random_rows(1, {"en": 150, "de": 64, "fr": 1, None: 5, "zz": 2, "é": 17})
    rows += rows[:9] + [(d, t, "odd", None, None) for d, t in odd_rows()]
    want = brute(rows)
    for height in (3, 10):
        assert got(merkle.verified_documents(frame(spark, rows), height)) == want
    assert sum(n for r, n in want.items() if not r[-1]) > 10


def test_many_trees_of_one_leaf(spark):
    rows = [(i, "t", f"lang{i % 37}", "s", 1) for i in range(37)]
    assert got(merkle.verified_documents(frame(spark, rows), 2)) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert merkle.verified_documents(docs(spark, [])).count() == 0
    rows = odd_rows()
    out = merkle.verified_documents(docs(spark, rows, extra=True))
    assert got(out) == brute([(d, t, "en", "s", len(t or "")) for d, t in rows])


def test_stored_manifest_gives_proofs_of_wanted_leaves(spark, tmp_path):
    rows = random_rows(2, {"en": 700, "de": 90})
    m = merkle.build(merkle.document_leaves(frame(spark, rows)), height=3)
    assert [lev.count() for lev in m.levels] == [790, 88 + 12, 11 + 2, 2 + 1, 1]  # every third level, and each tree's root
    m.save(str(tmp_path / "m"))
    back = merkle.Manifest.load(spark, str(tmp_path / "m"))
    wanted = spark.createDataFrame([(0, 3), (1, 699), (1, 0)], "tree long, idx long")
    proofs = back.proofs(wanted).collect()
    assert len(proofs) == 3 and all(merkle.fold(p.digest, p.path) == m.root for p in proofs)
    assert not any(merkle.fold(merkle.h(p.digest), p.path) == m.root for p in proofs)
    assert back.proofs().count() == 790


def test_sql_twin_agrees(spark):
    import duckdb
    import pandas as pd

    rows = random_rows(3, {"en": 70, "de": 33, None: 3})
    con = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"n_chars": "Int64"})
    con.register("documents", documents)
    assert Counter(con.execute(merkle.MANIFEST_SQL).fetchall()) == brute(rows)
