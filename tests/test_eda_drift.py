import datetime as dt

from pyspark.sql import functions as F

from conftest import tx_frame
from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import drift, eda

T = dt.datetime(2024, 1, 1)


def frame(spark, amount_scale=1.0, batch=0):
    rows = []
    for i in range(60):
        rows.append((i, T, (100.0 + i) * amount_scale, 50.0 + (i % 7), 20 + i % 40, ["Deposit", "Transfer"][i % 2],
                     ["Laptop", "Phone", "Tablet"][i % 3], "NY", int(i % 10 == 0), i, batch))
    return tx_frame(spark, rows)


def test_describe_and_profile(spark, cleaned_small):
    d = eda.describe_numeric(cleaned_small.data, cleaned_small.dropped, C)
    assert {"count", "mean", "std", "min", "p25", "p50", "p75", "max"} <= set(d.columns)
    h = eda.profile_header(cleaned_small.data, cleaned_small.dropped, C)
    assert h.filter(F.col("numeric_cols").contains("Transaction_Amount")).count() == h.count()
    assert h.filter(F.col("cat_cols").contains("Bank_Branch")).count() == 0  # dropped everywhere


def test_histogram_last_bin_closed_and_constant(spark):
    df = frame(spark)
    h = eda.histogram(df, None, 30, C)
    amt = h.filter(F.col("column_name") == C.amount)
    assert amt.agg(F.sum("count")).first()[0] == 60
    assert amt.agg(F.max("bin")).first()[0] == 29  # the maximum lands in the last bin
    const = df.withColumn(C.balance, F.lit(5.0))
    hc = eda.histogram(const, None, 30, C).filter(F.col("column_name") == C.balance).collect()
    assert len(hc) == 30 and {r["bin"]: r["count"] for r in hc if r["count"]} == {15: 60}  # empty bins stay


def test_correlation_constant_is_null(spark):
    df = frame(spark).withColumn(C.balance, F.lit(5.0))
    c = eda.correlation(df, None, C)
    assert c.filter((F.col("col_a") == C.balance) & (F.col("col_b") == C.amount)).first()["corr"] is None
    assert c.filter((F.col("col_a") == C.amount) & (F.col("col_b") == C.amount)).first()["corr"] == 1.0


def test_top_categories_and_rates(spark):
    df = frame(spark)
    t = eda.top_categories(df, 3, C).filter(F.col("column_name") == C.device).orderBy("rank").collect()
    assert [r["value"] for r in t] == ["Laptop", "Phone", "Tablet"]  # equal counts: by value
    r = eda.target_rate_by_category(df, C).filter(F.col("column_name") == C.txn_type)
    assert r.count() == 2


def test_no_drift_on_same_data_and_drift_on_shift(spark):
    same = frame(spark, 1.0, 0).unionByName(frame(spark, 1.0, 1))
    f = drift.drift_features(same, None, C)
    d = drift.drift_summary(drift.drift_deltas(f, drift.reference_features(f, 0, C), cols=C), C).first()
    assert d["drift_detected"] is False
    shifted = frame(spark, 1.0, 0).unionByName(frame(spark, 1000.0, 1))
    f2 = drift.drift_features(shifted, None, C)
    d2 = drift.drift_summary(drift.drift_deltas(f2, drift.reference_features(f2, 0, C), cols=C), C).first()
    assert d2["drift_detected"] is True and "Transaction_Amount_mean" in d2["drifted_features"]


def test_zero_reference_uses_absolute_value(spark):
    feats = spark.createDataFrame([(0, "x", 0.0), (1, "x", 0.5), (1, "y", 1.0)], "batch_index int, feature string, value double")
    d = drift.drift_deltas(feats, drift.reference_features(feats, 0, C), cols=C).collect()
    assert len(d) == 1 and d[0]["delta_pct"] == 50.0 and d[0]["drifted"] is True


def test_approximate_options_close_to_exact(spark, cleaned_small):
    from tidemark.operators import clean, profile

    ex = {r["column_name"]: r["p50"] for r in eda.describe_numeric(cleaned_small.data, None, C).collect()}
    ap = {r["column_name"]: r["p50"] for r in eda.describe_numeric(cleaned_small.data, None, C, exact=False).collect()}
    assert set(ex) == set(ap)
    for k in ex:
        assert abs(ex[k] - ap[k]) <= 0.02 * (abs(ex[k]) + 1.0)
    m1 = profile.batch_meta(cleaned_small.data, C).first()["unique_states"]
    m2 = profile.batch_meta(cleaned_small.data, C, approx_distinct=True).first()["unique_states"]
    assert m1 == m2 == 25
