import itertools
import random

from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import rules


def brute_force(baskets, min_support, min_conf, min_lift):
    n = len(baskets)
    items = sorted({i for b in baskets for i in b})
    sup = {}
    for k in range(1, len(items) + 1):
        found = False
        for combo in itertools.combinations(items, k):
            c = sum(1 for b in baskets if set(combo) <= b)
            if c / n >= min_support:
                sup[combo] = c / n
                found = True
        if not found:
            break
    out = set()
    for s, v in sup.items():
        if len(s) < 2:
            continue
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                cons = tuple(x for x in s if x not in a)
                conf = v / sup[a]
                lift = conf / sup[cons]
                if conf >= min_conf and lift >= min_lift:
                    out.add((a, cons))
    return sup, out


def make_baskets(spark, seed=7, n=300):
    rnd = random.Random(seed)
    attrs = {"A": ["a1", "a2"], "B": ["b1", "b2", "b3"], "C": ["c1", "c2"], "D": ["d1", "d2"]}
    rows = []
    for i in range(n):
        items = []
        for k, vals in attrs.items():
            if rnd.random() < 0.9:
                items.append(f"{k}={rnd.choice(vals)}")
        rows.append((0, i, sorted(items)))
    return spark.createDataFrame(rows, "batch_index int, row_idx long, items array<string>"), [set(r[2]) for r in rows]


def test_itemsets_and_rules_match_brute_force(spark):
    p = rules.RuleParams(min_support=0.1, min_confidence=0.3, min_lift=1.0)
    bk, py = make_baskets(spark)
    fi = rules.frequent_itemsets(bk, p, C)
    got = {tuple(r["itemset"]): r["support"] for r in fi.collect()}
    sup, exp_rules = brute_force(py, 0.1, 0.3, 1.0)
    assert set(got) == set(sup)
    assert all(abs(got[k] - sup[k]) < 1e-12 for k in sup)
    ar = rules.association_rules(fi, p, C).collect()
    assert {(tuple(r["antecedents"]), tuple(r["consequents"])) for r in ar} == exp_rules
    assert any(len(r["consequents"]) > 1 for r in ar)  # multi-item consequents


def test_wide_baskets_have_no_limit(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        items = [f"x{k:02d}" for k in range(9) if k < 3 or rnd.random() < 0.3]
        rows.append((i // 200, i, sorted(items) + [f"own{j}" for j in range(5)]))
    bk = spark.createDataFrame(rows, "batch_index int, row_idx long, items array<string>")
    p = rules.RuleParams(min_support=0.2)
    got = rules.frequent_itemsets(bk, p, C).collect()
    for b in (0, 1):
        sup, _ = brute_force([set(r[2]) for r in rows if r[0] == b], 0.2, 2, 1)
        assert {tuple(r["itemset"]): r["support"] for r in got if r["batch_index"] == b} == sup
    assert rules.frequent_itemsets(bk.limit(0), p, C).count() == 0


def test_fpgrowth_agrees(spark):
    p = rules.RuleParams(min_support=0.1)
    bk, _ = make_baskets(spark, seed=3)
    a = {tuple(r["itemset"]): r["count"] for r in rules.frequent_itemsets(bk, p, C).collect()}
    b = {tuple(r["itemset"]): r["count"] for r in rules.frequent_itemsets_fpgrowth(bk, 0, p, C).collect()}
    assert a == b


def test_rule_columns_top_and_target(spark):
    bk, _ = make_baskets(spark, seed=5)
    fi = rules.frequent_itemsets(bk, rules.RuleParams(min_support=0.1), C)
    ar = rules.association_rules(fi, rules.RuleParams(min_support=0.1), C)
    assert {"antecedents", "consequents", "support", "confidence", "lift"} <= set(ar.columns)
    top = rules.top_rules(ar, 10, C)
    assert top.count() == min(10, ar.count())
    lifts = [r["lift"] for r in top.orderBy("rank").collect()]
    assert lifts == sorted(lifts, reverse=True)
    tgt = rules.target_rules(ar.withColumn("consequents", F.array(F.lit("Is_Fraud=1"))), 5, C)
    assert tgt.count() == min(5, ar.count())


def test_baskets_items(spark, cleaned_small):
    bk = rules.baskets(cleaned_small.data, C)
    r = bk.first()
    assert any(i.startswith("Amount_") for i in r["items"]) and any(i.startswith("Is_Fraud=") for i in r["items"])
    assert r["items"] == sorted(r["items"])


def test_blocks_of_rows_give_the_same_itemsets(spark):
    p = rules.RuleParams(min_support=0.08)
    bk, py = make_baskets(spark, seed=11, n=700)
    far = bk.withColumn("row_idx", F.col("row_idx") * 1000 + 5)  # row numbers need not be dense
    two = far.unionByName(far.withColumn("batch_index", F.lit(4)).filter("row_idx % 3 = 0"))
    got = {(r.batch_index, tuple(r.itemset)): (r["count"], r.support) for r in rules.frequent_itemsets_blocked(two, p, C, block_rows=1 << 12).collect()}
    want = {(r.batch_index, tuple(r.itemset)): (r["count"], r.support) for r in rules.frequent_itemsets(two, p, C).collect()}
    assert got == want and len(got) > 50
    sup, _ = brute_force(py, 0.08, 0.3, 1.0)
    assert {k[1] for k in got if k[0] == 0} == set(sup)
    assert rules.frequent_itemsets_blocked(bk.limit(0), p, C).count() == 0


def test_rules_of_batches_with_more_items_than_a_long_has_bits(spark):
    """80 items in a batch, several batches: itemsets, rules and the rules that hold one item, by brute force; no scratch table is written."""
    from tidemark import session

    rnd = random.Random(4)
    rows = [(b, 10 * i, sorted({f"i{rnd.randrange(80):02d}" for _ in range(6)} | {f"i{k:02d}" for k in (1, 40, 79) if rnd.random() < 0.5}))
            for b in (3, 7) for i in range(150)]
    rows += [(9, 1, []), (9, 2, [])]
    bk = spark.createDataFrame(rows, "batch_index int, row_idx long, items array<string>")
    p = rules.RuleParams(min_support=0.02, min_confidence=0.2)
    before = dict(session._made)
    fi = rules.frequent_itemsets(bk, p, C)
    got = rules.association_rules(fi, p, C)
    held = rules.association_rules(fi, p, C, holding="i40")
    assert session._made == before and got.schema == held.schema
    pairs = lambda rows: {(r.batch_index, tuple(r.antecedents), tuple(r.consequents), r.support, r.confidence, r.lift) for r in rows}
    got, held = got.collect(), held.collect()
    assert pairs(held) == {x for x in pairs(got) if "i40" in x[2]} and 0 < len(held) < len(got) == len(pairs(got))
    sets = fi.collect()
    assert {r.batch_index for r in sets} == {3, 7} and len({i for r in sets for i in r.itemset}) > 64
    for b in (3, 7):
        py = [set(r[2]) for r in rows if r[0] == b]
        items = {tuple(sorted(c)) for x in py for k in range(1, 6) for c in itertools.combinations(x, k)}
        sup = {c: n / len(py) for c in items if (n := sum(set(c) <= x for x in py)) / len(py) >= p.min_support}
        assert {tuple(r.itemset): r.support for r in sets if r.batch_index == b} == sup
        want = {(b, a, c, v, v / sup[a], v / sup[a] / sup[c]) for s, v in sup.items() for k in range(1, len(s)) for a in itertools.combinations(s, k)
                for c in [tuple(x for x in s if x not in a)] if v / sup[a] >= p.min_confidence and v / sup[a] / sup[c] >= p.min_lift}
        assert {x for x in pairs(got) if x[0] == b} == want
