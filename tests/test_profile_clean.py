import datetime as dt

from pyspark.sql import functions as F

from conftest import tx_frame
from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import clean, profile

T = dt.datetime(2024, 1, 1)


def rows_basic():
    return [
        (1, T, 10.0, 100.0, 30, "Deposit", "Laptop", "NY", 0, 0, 0),
        (1, T, 10.0, 100.0, 30, "Deposit", "Laptop", "NY", 0, 1, 0),   # duplicate
        (2, T, None, 200.0, 40, "Transfer", None, "CA", 1, 2, 0),
        (2, T, None, 200.0, 40, "Transfer", None, "CA", 1, 3, 0),       # duplicate with NULLs
        (3, T, 30.0, -5.0, 50, "Deposit", "Phone", "TX", 0, 4, 0),      # negative balance
        (4, T, -1.0, 50.0, 20, "Transfer", "Phone", "NY", 0, 5, 0),     # negative amount
        (5, T, 20.0, 70.0, 130, "Deposit", "Laptop", "NY", 0, 6, 0),    # age > 120
        (6, T, 40.0, 80.0, 60, "Deposit", "Phone", "TX", 0, 7, 0),
    ]


def rows_clean():
    extra = [
        (7, T, 50.0, 90.0, 25, "Deposit", "Phone", "CA", 0, 8, 0),
        (8, T, 60.0, 90.0, 25, "Deposit", "Laptop", "CA", 0, 9, 0),
        (9, T, 70.0, 90.0, 25, "Deposit", "Phone", "CA", 0, 10, 0),
        (10, T, 80.0, 90.0, 25, "Deposit", "Laptop", "CA", 0, 11, 0),
    ]
    return rows_basic() + extra


def test_quality_report_fields_and_duplicates(spark):
    df = tx_frame(spark, rows_basic())
    rep = profile.quality_report(df, C).first().asDict()
    assert rep["n_rows"] == 8 and rep["duplicates_count"] == 2 and rep["duplicates_pct"] == 25.0
    assert rep["fraud_count"] == 2 and rep["legit_count"] == 6
    assert set(["missing_ok", "duplicates_ok", "fraud_rate_ok", "passed"]) <= set(rep)
    assert rep["duplicates_ok"] is False and rep["passed"] is False


def test_gate_fails_on_missing(spark):
    rows = [(i, T, None, 1.0, 30, "Deposit", "Laptop", "NY", 0, i, 0) for i in range(10)]
    rep = profile.quality_report(tx_frame(spark, rows), C, profile.QualityThresholds(max_missing_pct=5.0)).first()
    assert rep["missing_pct_total"] > 5.0 and rep["missing_ok"] is False and rep["passed"] is False


def test_batch_meta_mode_ties_smallest(spark):
    m = profile.batch_meta(tx_frame(spark, rows_basic()), C).first()
    assert m["top_transaction_type"] == "Deposit"  # 5 vs 3
    assert m["top_device_type"] == "Laptop"  # Laptop 3, Phone 3 -> smallest
    assert m["unique_states"] == 3 and m["n_cols"] == 9


def test_clean_steps(spark):
    df = tx_frame(spark, rows_clean())
    c = clean.clean(df, C, materialize=False)
    out = c.data.collect()
    ids = sorted(r[C.id] for r in out)
    assert ids == [1, 2, 6, 7, 8, 9, 10]  # dups removed, invalid rows removed
    assert c.dropped.count() == 0  # 2 of 10 de-duplicated rows miss a value: 20 %
    r2 = [r for r in out if r[C.id] == 2][0]
    # median of the de-duplicated amounts, negatives included (-1 .. 80) = 40
    assert r2[C.amount] == 40.0
    # mode of the de-duplicated devices: Laptop 4, Phone 5
    assert r2[C.device] == "Phone"
    assert c.data.filter(F.col(C.amount) < 0).count() == 0
    assert c.data.select([F.sum(F.col(x).isNull().cast("int")) for x in c.data.columns]).first() == tuple(
        [0] * len(c.data.columns))


def test_sparse_column_dropped_strictly(spark):
    # 4 of 10 rows miss State -> 40 % > 30 % -> dropped; 3 of 10 -> kept (not >)
    rows = []
    for i in range(10):
        rows.append((i, T, 1.0 + i, 1.0, 30, "Deposit", None if i < 3 else "Laptop", None if i < 4 else "NY", 0, i, 0))
    c = clean.clean(tx_frame(spark, rows), C, materialize=False)
    dropped = {r["column_name"] for r in c.dropped.collect()}
    assert dropped == {"State"}
    assert c.data.filter(F.col("State").isNotNull()).count() == 0
    assert c.data.filter(F.col(C.device).isNull()).count() == 0


def test_median_interpolates(spark):
    rows = [(i, T, v, 1.0, 30, "D", "L", "NY", 0, i, 0) for i, v in enumerate([1.0, 2.0, 3.0, 4.0])]
    rows.append((9, T, None, 1.0, 30, "D", "L", "NY", 0, 9, 0))
    c = clean.clean(tx_frame(spark, rows), C, materialize=False)
    assert c.data.filter(F.col(C.id) == 9).first()[C.amount] == 2.5


def test_audit(spark):
    df = tx_frame(spark, rows_clean())
    a = clean.clean_audit(df, clean.clean(df, C, materialize=False), C).first()
    assert (a["rows_before"], a["duplicates_removed"], a["invalid_removed"], a["rows_after"]) == (12, 2, 3, 7)
