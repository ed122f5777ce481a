import zlib

from conftest import SF_MED
from llm_data import docs, odd_rows

from tidemark.llm import langid, queries


def test_held_out_accuracy_on_the_table(spark):
    out = {r.doc_id: r for r in queries.op8_naive_bayes_language(spark, SF_MED).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MED}/documents.parquet").select("doc_id", "lang").collect()}
    assert set(out) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 for d, r in out.items())
    held = [d for d in out if out[d].held_out]
    assert sum(out[d].lang_pred == truth[d] for d in held) >= 0.97 * len(held)


def test_odd_rows_and_no_training_rows(spark):
    train = [(i, "der die das und ist nicht ein", "de", "s") for i in range(5)] + [(i, "the of and is not a one", "en", "s") for i in range(5, 12)]
    model = langid.train(docs(spark, [*train, (99, None, "fr", "s"), (98, "...", "es", "s"), (97, "texte", None, "s")]))
    assert model["langs"] == ["de", "en"]
    df = docs(spark, odd_rows(), extra=True)
    out = langid.identify(df, model, "pred", "p")
    assert out.columns == [*df.columns, "pred", "p"] and out.count() == df.count()
    got = {(r.doc_id, r.text): (r.pred, r.p) for r in out.collect()}
    for d, t in ((1, None), (2, ""), (3, "   \n\t "), (4, "!!! ... ###")):
        assert got[d, t] == ("und", 0.0)
    assert langid.score_text("und die", model)[0] == "de" and langid.score_text("THE one", model)[0] == "en"
    clash = langid.identify(df, model)  # an input column named score is replaced
    assert dict(clash.dtypes)["score"] == "double"
    none = langid.train(docs(spark, []))
    assert {r.lang_pred for r in langid.identify(df.select("doc_id", "text"), none).collect()} == {"und"}


def test_training_counts_every_row_once_and_ignores_the_rest(spark):
    a = langid.train(docs(spark, [(1, "ab", "x", "s"), (2, "cd", "y", "s")]).repartition(3))
    b = langid.train(docs(spark, [(8, "ab", "x", "t"), (9, "cd", "y", None)]).coalesce(1))
    assert (a["logs"] == b["logs"]).all() and (a["prior"] == b["prior"]).all()
