import zlib
from collections import Counter, defaultdict

from llm_data import docs, odd_rows, words

from tidemark.llm import sharding


def test_shards_are_balanced_gapless_and_keep_copies_together(spark):
    import random

    rnd = random.Random(3)
    rows = [(i, words(rnd, rnd.randrange(1, 60))) for i in range(3000)]
    rows += [(4000 + i, rows[i % 40][1]) for i in range(200)]
    out = sharding.shard_digest(docs(spark, rows), 24).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    text = dict(rows)
    bytes_in, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in out:
        assert r["size"] == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        bytes_in[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        where[text[r.doc_id]].add(r.shard)
    assert set(bytes_in) == set(range(24))
    target = sum(bytes_in.values()) / 24
    assert all(abs(b - target) < 0.05 * target for b in bytes_in.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())


def test_one_repeated_row_fills_many_shards_evenly(spark):
    rows = [(1, "the very same row")] * 900 + [(i, f"text {i}") for i in range(2, 500)]
    out = sharding.shard_digest(docs(spark, rows), 6).collect()
    size = defaultdict(int)
    for r in out:
        size[r.shard] += r["size"]
    assert len(out) == len(rows) and max(size.values()) - min(size.values()) < 60
    assert len({(r.shard, r.slot) for r in out}) == len(rows)


def test_odd_rows_extra_columns_and_empty_table(spark):
    df = docs(spark, odd_rows(), extra=True)
    out = sharding.shard(df, 4)
    assert sorted(out.columns) == sorted(df.columns) and out.count() == df.count()
    assert dict(out.dtypes)["shard"] == "int" and dict(out.dtypes)["slot"] == "bigint"
    rows = {(r.doc_id, r["size"]): r.text_crc32 for r in sharding.shard_digest(df, 4).collect()}
    assert rows[(1, 8)] == 0 and rows[(2, 8)] == 0
    assert sharding.shard(docs(spark, []), 4).count() == 0 and sharding.shard_digest(docs(spark, []), 4).count() == 0
