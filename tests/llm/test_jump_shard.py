import os
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spindle.llm import jump_shard as J
from tests.llm.conftest import EDGE_ROWS


def plain_jump(key, buckets):
    """The published loop, on 64-bit unsigned integers."""
    key, b, j = key % (1 << 64), -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 40, 1000])
def test_against_the_published_loop(spark, shards):
    keys = [0, 1, 2, 10, 256, -1, -2, 123456789, (1 << 63) - 1, -(1 << 63)] + list(range(1000, 1400))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for r in df.select("k", J.jump(F.col("k"), shards).alias("to")).collect():
        assert (r["to"].shard, r["to"].grown) == (plain_jump(r.k, shards), plain_jump(r.k, shards + 1))


def test_balance_and_growth(spark):
    got = spark.range(40_000).select(J.jump(F.col("id"), 40)["shard"].alias("a"), J.jump(F.col("id"), 40)["grown"].alias("b")).collect()
    sizes = Counter(r.a for r in got)
    assert set(sizes) == set(range(40)) and max(sizes.values()) < 1200 and min(sizes.values()) > 800
    moved = [r for r in got if r.a != r.b]
    assert all(r.b == 40 for r in moved) and 0.8 / 41 < len(moved) / 40_000 < 1.2 / 41


def check(rows, df, shards, **how):
    got = J.assign(df, shards, **how).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        key = -1 if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (plain_jump(key, shards), plain_jump(key, shards + 1))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_whole_table(small_docs):
    check([(r.doc_id, r.text) for r in small_docs.collect()], small_docs, 40)


def test_edges_and_hot_rows(spark, edge_docs, no_docs, monkeypatch):
    rows = [(a, t) for a, t, *_ in EDGE_ROWS]
    check(rows, edge_docs, 3)
    check(rows, edge_docs, 3, parts=1)
    assert J.assign(no_docs, 5).collect() == []
    monkeypatch.setattr(J, "RUN", 7)
    hot = [(1, "same")] * 100 + [(i, "x") for i in range(30)]
    check(hot, spark.createDataFrame(hot, "doc_id long, text string"), 4)
    with pytest.raises(ValueError):
        J.jump(F.col("k"), 0)


def test_written_shards(spark, small_docs, scratch):
    path = os.path.join(scratch, "shards")
    J.write_shards(small_docs, path, 5, files_per_shard=2)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(small_docs).count() == 0 and back.count() == small_docs.count()
    assert all(plain_jump(r.doc_id, 5) == r.shard for r in back.select("doc_id", "shard").collect())


def test_written_shards_keep_an_own_column(spark, scratch):
    docs = spark.createDataFrame([(1, "a", "mine")], "doc_id long, text string, Shard string")
    with pytest.raises(ValueError, match="column shard"):
        J.write_shards(docs, scratch + "/out", 4)
