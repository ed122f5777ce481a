import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches
from tidemark.plans.positions import group_medians, group_quantiles

PROBS = (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randrange(3)}", rnd.choice([rnd.lognormvariate(0, 2), float(rnd.randrange(4)), None])) for _ in range(12000)]
    rows += [("one", 5.0), ("none", None), (None, 1.0), (None, 2.0)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(7)


def by_group(rows):
    out = {}
    for g, v in rows:
        if v is not None:
            out.setdefault(g, []).append(v)
    return out


def test_exact_quantiles_equal_interpolation(spark, table):
    rows, df = table
    got = {(r.g, r.prob): r.quantile for r in group_quantiles(df, ["g"], "v", PROBS, 11).collect()}
    want = {(g, p): float(np.quantile(vs, p)) for g, vs in by_group(rows).items() for p in PROBS}
    assert got == pytest.approx(want)
    medians = {r.g: r.median for r in group_medians(df, ["g"], "v").collect()}
    assert medians == pytest.approx({g: got[g, 0.5] for g, p in got if p == 0.5})


def test_sketches_of_parts_and_of_the_whole_keep_their_error(spark, table):
    rows, df = table
    parts = sketches.quantile_sketches(df.withColumn("part", F.expr("pmod(hash(v), 5)")), ["part", "g"], ["v"])
    whole = sketches.merged(parts, ["g"])
    every = sketches.merged(whole, [])
    values = by_group(rows)
    assert {r.g: r.n for r in whole.collect()} == {g: len(v) for g, v in values.items()}
    for frame, key in ((whole, lambda r: values[r.g]), (every.withColumn("g", F.lit("all")), lambda r: [v for vs in values.values() for v in vs])):
        for r in sketches.quantiles(frame, ["g"], PROBS).collect():
            vs = np.sort(key(r))
            slack = sketches.RANK_ERROR * len(vs) + 1
            assert np.searchsorted(vs, r.quantile, "left") <= r.prob * len(vs) + slack
            assert np.searchsorted(vs, r.quantile, "right") >= r.prob * len(vs) - slack
    assert every.first().n == sum(map(len, values.values())) and every.first()["max"] == max(max(v) for v in values.values())
    assert sketches.quantile_sketches(df.limit(0), ["g"], ["v"]).count() == 0
