from collections import Counter, defaultdict

import corpus_pipeline as C
from conftest import SF_SMALL
from llm_data import docs, odd_rows
from test_decontam import fewest_edits
from test_mixing import brute as mixed
from test_near_dup import brute_classes

from tidemark.llm import decontam, langid
from tidemark.llm.words import word_hashes


def test_run_matches_a_brute_force_version(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in table.collect()]
    model = langid.train(table.filter(~langid.held_out()))
    rows = [r for r in rows if langid.score_text(r[1], model)[1] >= 0.5]
    classes = brute_classes([(d, t) for d, t, _ in rows])
    rows = [r for r, c in zip(rows, classes) if r[0] == c]
    split = lambda t: (lambda h: h[0].tolist())(word_hashes([t]))
    items = [split(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(len(set(x) & set(w)) >= 0.5 * len(set(x)) and fewest_edits(x, w) <= decontam.edits_allowed(len(x), 0.8) for w in [split(r[1])] for x in items if x)]
    _, _, taken = mixed(rows)
    want = Counter()
    for (d, t, _, words), n in taken.items():
        size = len(t.split()) if t else 0
        want[d] += n * (words // size if size else 0)
    out = C.run(spark, SF_SMALL)
    assert set(out.columns) == {*table.columns, "shard", "slot"}
    got = out.collect()
    assert Counter(r.doc_id for r in got) == +want
    size, slots = defaultdict(int), defaultdict(list)
    for r in got:
        size[r.shard] += len(r.text.encode()) + 8
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(len(r.text.encode()) for r in got) + 8
    assert max(size.values()) - min(size.values()) <= 2.5 * longest


def test_stages_keep_columns_on_odd_rows_and_empty_tables(spark):
    assert [n for n, _ in C.STAGES] == ["language", "near duplicates", "decontamination", "mix", "shards"]
    for df in (docs(spark, odd_rows(), extra=True), docs(spark, [], extra=True)):
        for name, stage in C.STAGES:
            out = stage(spark, df, SF_SMALL)
            if name != "shards":
                assert out.columns == df.columns
            assert out.count() <= 3 * df.count()
