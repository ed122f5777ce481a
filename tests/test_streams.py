"""Streams: numbering on arriving rows, the update job behind it, CSV files with bad ones among them, scoring with a model refresh."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.operators import batches, features, model_tables, serve
from tidemark.plans import jobs
from tidemark.session import scratch_path
from tidemark.sources.commits import CommitLog
from tidemark.sources.store import BatchStore
from tidemark.sources.tables import transactions
from tidemark.streaming import csv_stream, scoring, update

CFG = jobs.PipelineConfig(batch_size=250)


class Killed(BaseException):
    pass


def killed(*_, **__):
    raise Killed


@pytest.fixture(scope="module")
def slices(spark):
    """The fixture's rows in order, cut where no batch ends."""
    placed = batches.assign_batches(transactions(spark, SF_SMALL), 250)
    cuts = [0, 130, 740, 740, 1530]
    parts = [placed.filter((F.col("row_idx") >= a) & (F.col("row_idx") < z)).drop("row_idx", "batch_index") for a, z in zip(cuts, cuts[1:])]
    return placed, parts


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_every_row_gets_one_number_whatever_is_killed(spark, slices, monkeypatch):
    placed, parts = slices
    counter = update.RowCounter(BatchStore(spark, scratch_path(spark, "count")), "first", CFG)
    for epoch, part in enumerate(parts):
        if epoch in (1, 3):  # killed before the commit, and before the rows are written
            for target, name in ((CommitLog, "append"), (BatchStore, "_put"), (BatchStore, "write")):
                with monkeypatch.context() as m:
                    m.setattr(target, name, killed)
                    try:
                        counter.append(part, epoch)
                    except Killed:
                        pass
        counter = update.RowCounter(counter.store, "first", CFG)  # nothing lives in the driver
        counter.append(part, epoch)
        assert counter.append(part, epoch) is False
    assert counter.counted() == 1530
    assert rows_of(counter.store.read("raw")) == rows_of(placed)
    other = update.RowCounter(counter.store, "second", CFG)  # a new checkpoint starts its epochs again
    assert other.append(parts[0].limit(7), 0) and other.counted() == 1537
    assert counter.store.read("raw").filter("batch_index = 6").count() == 37


def test_full_batches_are_processed_once_and_after_a_stop(spark, slices, monkeypatch):
    _, parts = slices
    seen, fail = [], []

    def process(spark_, store, ids, cfg):
        found = sorted(r[0] for r in ids.collect())
        if fail:
            fail.pop()
            raise Killed
        seen.append(found)
        store.write("progress", ids.select(C.batch), ids=ids)

    monkeypatch.setattr(jobs, "process", process)
    counter = update.RowCounter(BatchStore(spark, scratch_path(spark, "steps")), "s", CFG)
    update.step(counter, parts[0], 0)
    assert seen == []  # 130 rows: no full batch
    fail.append(1)
    with pytest.raises(Killed):
        update.step(counter, parts[1], 1)
    update.step(counter, parts[1], 1)
    assert seen == [[0, 1]]
    update.step(counter, parts[2], 2)
    update.step(counter, parts[3], 3, every=9)
    assert seen == [[0, 1]]
    update.finish(counter)
    update.finish(counter, closed=True)
    update.finish(counter, closed=True)
    assert seen == [[0, 1], [2, 3, 4, 5], [6]]


def test_bad_files_and_rows_are_set_aside(spark, tmp_path):
    types = {"Transaction_ID": "bigint", "Transaction_Date": "timestamp", "Transaction_Amount": "double", "State": "string"}
    land = tmp_path / "in"
    land.mkdir()
    (land / "a.csv").write_text('Transaction_ID,Transaction_Date,Transaction_Amount,State\n1,2024-01-02,5.5,"x, y"\n2,3/4/2024,NaN,NA\n')
    (land / "b.csv").write_text("State,more,Transaction_Amount,Transaction_Date,Transaction_ID\nz,9,7,2024/05/06,3\nz,9,many,never,4\nz,9,7,2024/05/06\n")
    (land / "c.csv").write_text("Transaction_ID,State\n5,q\n")
    (land / "d.csv").write_text("\n")
    got = []
    side, check = str(tmp_path / "side"), str(tmp_path / "check")
    csv_stream.stream_csv(spark, str(land), types, lambda df, epoch: got.extend(df.collect()), side, check, 2)
    assert sorted((r[0], str(r[1]), r[2], r[3]) for r in got) == [
        (1, "2024-01-02 00:00:00", 5.5, "x, y"), (2, "2024-03-04 00:00:00", None, None), (3, "2024-05-06 00:00:00", 7.0, "z")]
    bad = {r.file.rsplit("/", 1)[-1]: r.reason for r in spark.read.parquet(side + "/bad_files").collect()}
    assert set(bad) == {"c.csv", "d.csv"} and "Transaction_Amount" in bad["c.csv"]
    rows = spark.read.parquet(side + "/bad_rows").collect()
    assert sorted(tuple(r["columns"]) for r in rows) == [("*",), ("Transaction_Date", "Transaction_Amount")] or sorted(
        tuple(sorted(r["columns"])) for r in rows) == [("*",), ("Transaction_Amount", "Transaction_Date")]
    (land / "e.csv").write_text("Transaction_ID,Transaction_Date,Transaction_Amount,State\n6,2024-01-02,1,w\n")
    got.clear()
    csv_stream.stream_csv(spark, str(land), types, lambda df, epoch: got.extend(df.collect()), side, check, 2)
    assert [r[0] for r in got] == [6]


def test_scoring_takes_the_model_promoted_between_epochs(spark, slices):
    _, parts = slices
    root, out = scratch_path(spark, "root"), scratch_path(spark, "out")
    st = BatchStore(spark, root)
    fitted = features.fit(parts[3])
    fitted.save(spark, st.path("fitted_features"))

    def promote(p1):
        nodes = spark.createDataFrame([(0, 0, -1, None, -1, -1, [1 - p1, p1])], model_tables.NODES)
        path = model_tables.TableModels(fitted.output_columns(), nodes).save(scratch_path(spark, "model"))
        serve.register(spark, st.path("registry"), "best", "rf", path, None, "f1", 0)
        serve.promote(spark, st.path("registry"))

    scorer = scoring.Scorer(spark, root, out)
    with pytest.raises(serve.NoModelError):
        scorer.each(parts[0], 0)
    promote(0.9)
    scorer.each(parts[0], 0)
    scorer.each(parts[0], 0)  # a replay
    promote(0.1)
    scorer.each(parts[1], 1)
    scored = spark.read.parquet(out + "/scored").groupBy("epoch").agg(F.min("predict"), F.max("predict"), F.count("*")).orderBy("epoch").collect()
    assert [tuple(r) for r in scored] == [(0, 1, 1, 130), (1, 0, 0, 610)]
    log = spark.read.parquet(out + "/log").orderBy("epoch").collect()
    assert [(r.n_rows, r.model_name) for r in log] == [(130, "rf"), (610, "rf")] and log[0].model_number < log[1].model_number
    assert serve.performance_summary(spark.read.parquet(out + "/log")).first().n_calls == 2
