import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import batches, profile
from tidemark.session import scratch_path
from tidemark.sources.store import BatchStore
from tidemark.sources.tables import transactions
from tidemark.streaming import micro


def test_no_row_lost_and_sizes(spark):
    src = transactions(spark, SF_SMALL)
    b = batches.assign_batches(src, 500, C)
    assert b.count() == src.count()
    sizes = sorted((r[0], r[1]) for r in b.groupBy(C.batch).count().collect())
    assert all(n == 500 for _, n in sizes[:-1]) and 0 < sizes[-1][1] <= 500
    rows = b.select(C.row).orderBy(C.row).collect()
    assert [r[0] for r in rows] == list(range(len(rows)))


def test_order_is_date_then_id(spark):
    b = batches.assign_batches(transactions(spark, SF_SMALL), 500, C)
    got = [(r[0], r[1]) for r in b.orderBy(C.row).select(C.time, C.id).collect()]
    assert got == sorted(got)


def test_nulls_sort_last_and_skewed_key_splits(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "Transaction_ID long, Transaction_Date timestamp_ntz")
    b = batches.assign_batches(df, 100, C, num_partitions=7)
    last = b.filter(F.col(C.batch) == 2).select(F.count_if(F.col(C.time).isNull())).first()[0]
    assert last == 100  # the 100 NULL dates are the last batch
    assert b.select(C.row).distinct().count() == 300


def test_pending_and_store_round_trip(spark):
    b = batches.assign_batches(transactions(spark, SF_SMALL), 500, C)
    st = BatchStore(spark, scratch_path(spark, "test-store"))
    empty = spark.createDataFrame([], "batch_index int")
    first = batches.next_batch(b, empty, C)
    assert {r[0] for r in first.select(C.batch).distinct().collect()} == {0}
    st.save_batches(first, profile.batch_meta(first, C))
    pend = {r[0] for r in batches.pending_batches(b, st.read("batch_meta"), C).collect()}
    assert 0 not in pend and pend == set(range(1, 4))
    st.save_batches(first, profile.batch_meta(first, C))  # same index overwrites
    assert st.load_all_batches().count() == first.count()


def test_stream_equals_batch(spark):
    b = batches.assign_batches(transactions(spark, SF_SMALL), 500, C)
    base = scratch_path(spark, "test-stream")
    micro.write_landing(b, base + "/landing")
    out = micro.run_stream(spark, base + "/landing", b.schema, lambda df: profile.quality_report(df, C),
                           base + "/q", base + "/ck")
    exp = profile.quality_report(b, C)
    cols = exp.columns
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, exp.collect()))


def test_group_medians_exact_with_a_hot_group(spark):
    from tidemark.plans.positions import group_medians

    hot = [("hot", float(i % 17)) for i in range(3000)]
    cold = [("a", 1.0), ("a", 2.0), ("a", 10.0), ("a", 11.0), ("b", 5.0), ("b", None)]
    df = spark.createDataFrame(hot + cold, "g string, v double")
    got = {r["g"]: r["median"] for r in group_medians(df, ["g"], "v", num_partitions=7).collect()}
    import statistics

    assert got["a"] == 6.0 and got["b"] == 5.0
    assert got["hot"] == statistics.median([float(i % 17) for i in range(3000)])


def test_store_rewrite_replaces_only_its_batches(spark):
    st = BatchStore(spark, scratch_path(spark, "test-store-groups"), group_size=4)
    df = spark.createDataFrame([(b, i, "v1") for b in range(6) for i in range(3)], "batch_index int, i int, tag string")
    st.write("t", df)
    st.write("t", spark.createDataFrame([(1, 0, "v2"), (5, 0, "v2")], "batch_index int, i int, tag string"))
    got = st.read("t")
    assert "batch_group" not in got.columns
    rows = sorted((r["batch_index"], r["i"], r["tag"]) for r in got.collect())
    exp = sorted([(b, i, "v1") for b in (0, 2, 3, 4) for i in range(3)] + [(1, 0, "v2"), (5, 0, "v2")])
    assert rows == exp


def test_rows_of_one_group_stay_spread(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import rules
    from tidemark.plans.positions import positions_within_groups

    df = spark.range(4000, numPartitions=8).select(F.lit(0).alias("batch_index"), F.col("id").alias("row_idx"), (F.col("id") % 90).cast("double").alias("Transaction_Amount"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, ("-1", "false"), strict=True):
            spark.conf.set(name, value)
        placed = positions_within_groups(df, ["batch_index"], [F.col("Transaction_Amount").asc()], "at", "n", 8)
        bk = rules.baskets(df, bounded=False)
        most = [max(r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()) for d in (placed, bk)]
        at = placed.agg(F.countDistinct("at"), F.min("at"), F.max("at"), F.min("n"), F.max("n")).first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(most) < 3000  # all 4000 in one task when joined by group alone
    assert tuple(at) == (4000, 0, 3999, 4000, 4000)
    items = {r["items"][0]: r["n"] for r in bk.groupBy("items").agg(F.count("*").alias("n")).collect()}
    assert sum(items.values()) == 4000 and set(items) == {"Amount_high", "Amount_low"}
