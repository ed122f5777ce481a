import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.exprs import parse_mixed_timestamp
from tidemark.session import scratch_path
from tidemark import session
from tidemark.sources import csv_source
from tidemark.sources.store import BatchStore


def test_mixed_layouts_month_first(spark):
    vals = ["2025-01-05 10:11:12", "05-01-2025", "23-01-2025", "2025/01/07", "01/31/2025",
            "2025-01-05T01:02:03", "2025-01-05 10:11:12.123", "garbage", None]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(parse_mixed_timestamp("t")).collect()]
    assert got[0] == dt.datetime(2025, 1, 5, 10, 11, 12)
    assert got[1] == dt.datetime(2025, 5, 1)  # ambiguous: month first
    assert got[2] == dt.datetime(2025, 1, 23)  # 23 cannot be a month
    assert got[3] == dt.datetime(2025, 1, 7)
    assert got[4] == dt.datetime(2025, 1, 31)
    assert got[5] == dt.datetime(2025, 1, 5, 1, 2, 3)
    assert got[6] == dt.datetime(2025, 1, 5, 10, 11, 12, 123000)
    assert got[7] is None and got[8] is None


def test_layouts_by_shape_equal_trying_every_layout(spark):
    from tidemark.functions import exprs

    when = dt.datetime(2024, 5, 3, 4, 5, 6, 120000)
    vals = [None, "", "garbage", "13/13/2024", "20240105", "a.b", "5/6/24", "2024-01-05x", "001/02/2024", "Sept 3, 2024", "12:30", "2024-13-01"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").unionByName(
        spark.createDataFrame([(f, when) for f in exprs.DEFAULT_DATE_FORMATS], "f string, t timestamp").selectExpr(
            "CASE f " + " ".join(f"WHEN {f!r} THEN date_format(t, {f!r})".replace("\"", "'") if "'" not in f else f"WHEN \"{f}\" THEN date_format(t, \"{f}\")"
                                 for f in exprs.DEFAULT_DATE_FORMATS) + " END AS v"))
    c = F.trim("v")
    both = df.select("v", parse_mixed_timestamp("v").alias("new"), F.coalesce(*[exprs._parsed(c, f) for f in exprs.DEFAULT_DATE_FORMATS]).alias("old")).collect()
    assert all(r.new == r.old for r in both) and sum(r.new is not None for r in both) == len(exprs.DEFAULT_DATE_FORMATS) + 1
    known = {s for f in exprs.DEFAULT_DATE_FORMATS for s in exprs.layout_shapes(f)}
    shapes = {r[0] for r in df.filter("v LIKE '%2024%'").select(exprs.text_shape(F.col("v"))).collect()}
    assert len(shapes & known) > 20


def write_csv(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)


def test_csv_tokens_and_types(spark):
    path = scratch_path(spark, "test-csv")
    write_csv(path, "Transaction_ID,Transaction_Date,Transaction_Amount,Device_Type\n"
                    "1,2025-01-05,NaN,NA\n2,05-01-2025,12.5,Laptop\n3,2025-01-06, ,null\n")
    types = {"Transaction_ID": "bigint", "Transaction_Date": "timestamp", "Transaction_Amount": "double", "Device_Type": "string"}
    df = csv_source.read_transactions_csv(spark, path, types)
    rows = {r["Transaction_ID"]: r for r in df.collect()}
    assert rows[1]["Transaction_Amount"] is None and rows[1]["Device_Type"] is None
    assert rows[2]["Transaction_Amount"] == 12.5 and rows[2]["Transaction_Date"] == dt.datetime(2025, 5, 1)
    assert rows[3]["Transaction_Amount"] is None and rows[3]["Device_Type"] is None
    assert df.filter(F.isnan("Transaction_Amount")).count() == 0


def test_csv_unparsed_date_raises(spark):
    path = scratch_path(spark, "test-csv-bad")
    write_csv(path, "Transaction_ID,Transaction_Date\n1,not-a-date\n")
    with pytest.raises(csv_source.UnparsedDatesError):
        csv_source.read_transactions_csv(spark, path, {"Transaction_ID": "bigint", "Transaction_Date": "timestamp"})


def test_csv_columns_by_name_extra_columns_and_bad_values(spark):
    types = {"Transaction_ID": "bigint", "Transaction_Date": "timestamp", "Transaction_Amount": "double", "Account_Balance": "double"}
    path = scratch_path(spark, "test-csv-order")
    write_csv(path, "Note,Account_Balance,Transaction_Amount,Code,Rate,Transaction_Date,Transaction_ID\n"
                    "x,1.0,2.0,7,1.5,1/5/2025,1\n4,3.0,NA,8,2,Jan 6 2025,2\n".replace("Jan 6 2025", '"Jan 6, 2025"'))
    df = csv_source.read_transactions_csv(spark, path, types)
    assert df.dtypes == [("Transaction_ID", "bigint"), ("Transaction_Date", "timestamp_ntz"), ("Transaction_Amount", "double"), ("Account_Balance", "double"),
                         ("Note", "string"), ("Code", "bigint"), ("Rate", "double")]
    assert [tuple(r)[1:4] for r in df.orderBy("Transaction_ID").collect()] == [(dt.datetime(2025, 1, 5), 2.0, 1.0), (dt.datetime(2025, 1, 6), None, 3.0)]
    path = scratch_path(spark, "test-csv-values")
    write_csv(path, "Transaction_ID,Transaction_Date,Transaction_Amount,Account_Balance\n1,2025-01-05,abc,1\n")
    with pytest.raises(csv_source.UnparsedValuesError):
        csv_source.read_transactions_csv(spark, path, types)
    with pytest.raises(ValueError):
        csv_source.read_transactions_csv(spark, path, types | {"Age": "int"})


def test_more_layouts(spark):
    vals = ["1/5/2025", "2025-01-05T10:00:00Z", "2025-01-05T10:00:00+02:00", "Jan 5, 2025", "5 Jan 2025", "January 5, 2025", "2025-1-5"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "t string").select(parse_mixed_timestamp("t")).collect()]
    assert got == [dt.datetime(2025, 1, 5), dt.datetime(2025, 1, 5, 10), dt.datetime(2025, 1, 5, 8)] + [dt.datetime(2025, 1, 5)] * 4


def test_store_replaces_batches_that_have_no_rows_any_more(spark):
    st = BatchStore(spark, scratch_path(spark, "test-store-replace"), group_size=2)
    rows = lambda *r: spark.createDataFrame(r, "batch_index int, v string")
    st.write("t", rows((0, "a"), (1, "old"), (2, "c")))
    again = spark.createDataFrame([(0,), (1,)], "batch_index int")
    st.write("t", rows((0, "b")), ids=again)
    assert sorted(tuple(r) for r in st.read("t").collect()) == [(0, "b"), (2, "c")]
    st.write("t", spark.createDataFrame([], "batch_index int, v string"), ids=spark.createDataFrame([(2,)], "batch_index int"))
    assert sorted(tuple(r) for r in st.read("t").collect()) == [(0, "b")]
    assert [tuple(r) for r in st.read_batches("t", again).collect()] == [(0, "b")]


def test_scratch_is_dropped(spark):
    df = session.materialize(spark.range(10).withColumn("batch_index", F.lit(1)), "test-drop", bucket_col="batch_index", buckets=2)
    path = df._tidemark_path
    assert df.count() == 10 and session.path_exists(spark, path) and session.list_names(spark, path)
    session.discard(df)
    assert not session.path_exists(spark, path) and session.list_names(spark, path) == []
    assert session.partitions_for(spark.range(10)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.partitions_for(spark.range(10), 1) > 8
