"""Index properties: merge, storage round trip, views, bad input."""

import json
import os

from pyspark.sql import functions as F

from spindle.operators.index import (Index, build_index, forward_blocks, forward_lookup,
                                     inverted_blocks, merge_index, merge_postings)
from spindle.operators.rank import rank
from spindle.plans.jobs import add_job, build_job
from spindle.sources.documents import corpus, read_documents_json
from spindle.sources.store import load_index, save_index
from tests.conftest import SF_SMALL


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_postings_unique_and_positive(spark):
    post = build_index(corpus(spark, SF_SMALL)).flat().cache()
    assert post.where(F.col("tf") < 1).count() == 0
    assert post.count() == post.select("title", "term").distinct().count()


def test_merge_micro_fixture(spark):
    old = spark.createDataFrame([("A", "x", 1), ("A", "y", 2)], "title string, term string, tf bigint")
    new = spark.createDataFrame([("A", "x", 9), ("B", "z", 1)], "title string, term string, tf bigint")
    assert rows(merge_postings(old, new)) == [("A", "x", 9), ("A", "y", 2), ("B", "z", 1)]


def test_merge_disjoint_equals_full_build(spark):
    docs = corpus(spark, SF_SMALL)
    a = docs.where(F.col("title").cast("int") < 100)
    b = docs.where(F.col("title").cast("int") >= 100)
    merged = merge_index(build_index(a), build_index(b)).flat()
    assert rows(merged) == rows(build_index(docs).flat())


def test_merge_with_itself_is_identity(spark):
    idx = build_index(corpus(spark, SF_SMALL))
    assert rows(merge_index(idx, idx).flat()) == rows(idx.flat())


def test_same_title_rows_are_one_document(spark):
    docs = spark.createDataFrame([("A", "hat hat"), ("A", "hat cat")], "title string, text string")
    assert rows(build_index(docs).flat()) == [("A", "cat", 1), ("A", "hat", 3)]


def test_store_round_trip(spark, scratch):
    idx = build_index(corpus(spark, SF_SMALL))
    stored = save_index(idx, os.path.join(scratch, "idx"), n_buckets=4)
    assert stored.n_buckets == 4
    assert rows(stored.flat()) == rows(idx.flat())
    assert rows(stored.forward()) == rows(idx.flat())
    assert rows(stored.lexicon()) == rows(idx.lexicon())
    assert rows(stored.documents()) == rows(idx.documents())
    assert rows(stored.stats()) == rows(idx.stats())
    again = load_index(spark, os.path.join(scratch, "idx"))
    q = "esat estion the"
    for method in ("bm25", "naive"):
        assert rows(rank(again, q, method, None, decimals=9)) == rows(rank(idx, q, method, None, decimals=9))


def test_add_job_new_wins_and_old_terms_survive(spark, scratch):
    old = spark.createDataFrame([("A", "xx yy yy"), ("B", "zz")], "title string, text string")
    new = spark.createDataFrame([("A", "xx xx ww"), ("C", "vv")], "title string, text string")
    build_job(old, os.path.join(scratch, "old"), n_buckets=2)
    merged = add_job(spark, new, os.path.join(scratch, "old"), os.path.join(scratch, "new"))
    assert rows(merged.flat()) == [("A", "ww", 1), ("A", "xx", 2), ("A", "yy", 2),
                                   ("B", "zz", 1), ("C", "vv", 1)]
    s = merged.stats().first()
    assert (s.d, s.n_postings) == (3, 5)


def test_blocks_flatten_back(spark):
    idx = build_index(corpus(spark, SF_SMALL))
    inv = inverted_blocks(idx, block_size=16)
    assert inv.agg(F.max("n")).first()[0] < 16 * 3
    flat_inv = inv.select("term", F.explode("titles").alias("title"))
    assert rows(flat_inv, "title", "term") == rows(idx.flat(), "title", "term")
    fwd = forward_blocks(idx, block_size=16)
    flat_fwd = fwd.select("title", F.explode("vec").alias("e")).select("title", "e.term", "e.tf")
    assert rows(flat_fwd) == rows(idx.flat())


def test_forward_maps_lookup(spark):
    from spindle.operators.index import forward_maps, map_tf
    idx = build_index(spark.createDataFrame([("A", "hat hat cat")], "title string, text string"))
    m = forward_maps(idx, block_size=8).select(map_tf(F.col("vec"), F.lit("hat")).alias("h"),
                                               map_tf(F.col("vec"), F.lit("dog")).alias("d")).first()
    assert (m.h, m.d) == (2, 0)


def test_forward_lookup_defaults_to_zero(spark):
    idx = build_index(spark.createDataFrame([("A", "hat hat cat")], "title string, text string"))
    pairs = spark.createDataFrame([("A", "hat"), ("A", "dog"), ("B", "hat")], "title string, term string")
    assert rows(forward_lookup(idx, pairs)) == [("A", "dog", 0), ("A", "hat", 2), ("B", "hat", 0)]


def test_json_bad_input(spark, scratch):
    path = os.path.join(scratch, "docs.json")
    with open(path, "w") as fh:
        fh.write(json.dumps({"title": "A", "text": "foo bar", "id": 1}) + "\n")
        fh.write("{bad\n")
        fh.write(json.dumps({"title": "B"}) + "\n")
    docs = read_documents_json(spark, path)
    assert sorted(docs.collect(), key=lambda r: (r.title or "", r.text or "")) == \
        sorted([(None, None), ("A", "foo bar"), ("B", None)], key=lambda r: (r[0] or "", r[1] or ""))
    assert rows(build_index(docs).flat()) == [("A", "bar", 1), ("A", "foo", 1)]


def test_empty_index(spark):
    docs = spark.createDataFrame([("A", "! ?"), ("B", None)], "title string, text string")
    idx = build_index(docs)
    s = idx.stats().first()
    assert s.d == 0 and s.avgdl is None
    assert rank(idx, "hello", "bm25", 10).collect() == []
    assert rank(idx, "hello", "naive", None).collect() == []


def test_rank_all_has_one_row_per_document(spark):
    idx = build_index(corpus(spark, SF_SMALL))
    d = idx.stats().first().d
    assert rank(idx, "esat the", "bm25", None).count() == d


def test_bm25_ignores_query_repeats_naive_does_not(spark):
    idx = build_index(corpus(spark, SF_SMALL))
    one = rows(rank(idx, "esat estion", "bm25", None, decimals=9))
    rep = rows(rank(idx, "esat esat estion", "bm25", None, decimals=9))
    assert one == rep
    n1 = rows(rank(idx, "esat estion", "naive", None, decimals=9))
    n2 = rows(rank(idx, "esat esat estion", "naive", None, decimals=9))
    assert n1 != n2


def test_deterministic_across_partition_counts(spark):
    docs = corpus(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = rows(rank(build_index(docs), "esat the", "bm25", None, decimals=9))
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = rows(rank(build_index(docs), "esat the", "bm25", None, decimals=9))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


def test_rank_job_on_stored_index(spark, scratch):
    from spindle.plans.jobs import rank_job
    root = os.path.join(scratch, "idx")
    idx = build_job(corpus(spark, SF_SMALL), root, n_buckets=3, n_files=5)
    got = [(r.title, r.score) for r in rank_job(spark, root, "bm25", "esat estion").collect()]
    want = [(r.title, r.score) for r in rank(build_index(corpus(spark, SF_SMALL)), "esat estion", "bm25").collect()]
    assert [t for t, _ in got] == [t for t, _ in want]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, want))
    assert idx.n_buckets == 3


def test_add_layouts_agree_with_lazy_merge(spark, scratch):
    from spindle.operators.joins import BROADCAST_ROWS_CONF
    docs = corpus(spark, SF_SMALL)
    old_docs = docs.where(F.col("title").cast("int") % 3 != 0)
    new_docs = docs.where(F.col("title").cast("int") % 2 == 0).withColumn(
        "text", F.concat(F.col("text"), F.lit(" extra words here")))
    build_job(old_docs, os.path.join(scratch, "old"), n_buckets=4)
    want = rows(merge_index(build_index(old_docs), build_index(new_docs)).flat())
    fast = add_job(spark, new_docs, os.path.join(scratch, "old"), os.path.join(scratch, "fast"))
    full = add_job(spark, new_docs, os.path.join(scratch, "old"), os.path.join(scratch, "full"), layout="resort")
    spark.conf.set(BROADCAST_ROWS_CONF, "0")
    try:
        small = add_job(spark, new_docs, os.path.join(scratch, "old"), os.path.join(scratch, "small"))
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)
    for idx in (fast, full, small):
        assert rows(idx.flat()) == want
        assert rows(idx.forward()) == want
        assert rows(idx.lexicon()) == rows(lexicon_of(spark, want))
    assert rows(fast.stats()) == rows(full.stats())
    assert rows(fast.documents()) == rows(full.documents())
    merged_docs = spark.createDataFrame(want, "title string, term string, tf bigint").groupBy(
        "title").agg(F.count("*").alias("n_terms"), F.sum("tf").alias("n_tokens"))
    assert rows(fast.documents()) == rows(merged_docs)


def test_no_size_stops_the_stream_or_a_registered_add(spark, scratch):
    from spindle.operators.joins import BROADCAST_ROWS_CONF
    from spindle.plans import catalog
    from spindle.streaming.add import IndexAppender
    docs = corpus(spark, SF_SMALL)
    parts = [docs.where(F.col("title").cast("int") % 3 == i) for i in range(3)]
    app = IndexAppender(os.path.join(scratch, "idx"), "run", refresh_rows=1)
    spark.conf.set(BROADCAST_ROWS_CONF, "10")
    try:
        for epoch, part in enumerate(parts):
            app(part, epoch)
        assert not app._pending(spark)
        got = app.current(spark)
        want = rows(build_index(docs).flat())
        assert rows(got.flat()) == want and rows(got.lexicon()) == rows(lexicon_of(spark, want))
        catalog._ADDED.clear()
        catalog._ADDED_NULL.clear()
        assert catalog.added_index(spark, SF_SMALL).flat().count() and catalog.added_null_title(spark, SF_SMALL).flat().count()
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)
        catalog._ADDED.clear()
        catalog._ADDED_NULL.clear()


def lexicon_of(spark, postings):
    df = spark.createDataFrame(postings, "title string, term string, tf bigint")
    return df.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def test_compact_keeps_content(spark, scratch):
    from spindle.sources.store import compact_index
    docs = corpus(spark, SF_SMALL)
    build_job(docs.where(F.col("title").cast("int") < 100), os.path.join(scratch, "a"), n_buckets=4)
    add_job(spark, docs.where(F.col("title").cast("int") >= 100), os.path.join(scratch, "a"),
            os.path.join(scratch, "b"))
    compact = compact_index(spark, os.path.join(scratch, "b"), os.path.join(scratch, "c"))
    assert compact.n_buckets == 4
    assert rows(compact.flat()) == rows(build_index(docs).flat())


def test_concurrent_writes_propagate_failures():
    import pytest
    from spindle.sources.store import run_concurrently
    done = []

    def ok():
        done.append(1)

    def boom():
        raise RuntimeError("write failed")

    with pytest.raises(RuntimeError, match="write failed"):
        run_concurrently(ok, boom)
    assert done == [1]


NULL_DOCS = [(None, "alpha beta"), ("A", "beta gamma"), ("B", "gamma"), (None, "beta delta")]


def test_null_title_is_a_title(spark, scratch):
    docs = spark.createDataFrame(NULL_DOCS, "title string, text string")
    old = build_job(docs, os.path.join(scratch, "old"), n_buckets=2)
    new = spark.createDataFrame([(None, "beta beta omega"), ("C", "beta")], "title string, text string")
    want = {(None, "alpha", 1), (None, "beta", 2), (None, "delta", 1), (None, "omega", 1), ("A", "beta", 1), ("A", "gamma", 1),
            ("B", "gamma", 1), ("C", "beta", 1)}
    lazy = merge_index(old, build_index(new))
    assert {tuple(r) for r in lazy.flat().collect()} == want
    for layout in ("append", "resort"):
        idx = add_job(spark, new, os.path.join(scratch, "old"), os.path.join(scratch, layout), layout=layout)
        for table in (idx.flat(), idx.forward()):
            assert {tuple(r) for r in table.collect()} == want and table.count() == len(want)
        assert {tuple(r) for r in idx.documents().collect()} == {(None, 4, 5), ("A", 2, 2), ("B", 1, 1), ("C", 1, 1)}
        assert {tuple(r) for r in idx.lexicon().collect()} == {tuple(r) for r in lazy.lexicon().collect()}
        assert tuple(idx.stats().first()) == tuple(lazy.stats().first())
        okapi = {r.title: r.score for r in rank(idx, "omega", "bm25", None, length_norm="document").collect()}
        assert set(okapi) == {None, "A", "B", "C"} and okapi[None] > 0


def test_add_without_a_forward_copy_writes_an_ordered_one(spark, scratch):
    docs = corpus(spark, SF_SMALL)
    build_job(docs.where("title < '3'"), os.path.join(scratch, "old"), n_buckets=4, forward=False)
    idx = add_job(spark, docs.where("title >= '3'"), os.path.join(scratch, "old"), os.path.join(scratch, "new"), forward=True)
    assert rows(idx.forward()) == rows(build_index(docs).flat())
    assert add_job(spark, docs.limit(1), os.path.join(scratch, "old"), os.path.join(scratch, "no"), forward=False).forward_df is None


def test_lookup_does_not_move_the_index(spark, scratch):
    from spindle.operators.index import forward_lookup, map_lookup
    idx = build_job(corpus(spark, SF_SMALL), os.path.join(scratch, "idx"), n_buckets=4)
    pairs = spark.createDataFrame([("1", "the"), ("1", "nowhere"), (None, "the"), ("1", "the")], "title string, term string")
    found = forward_lookup(idx, pairs)
    want = {(r.title, r.term): r.tf for r in idx.flat().collect()}
    expected = sorted(((t, w, want.get((t, w), 0)) for t, w in [("1", "the"), ("1", "nowhere"), (None, "the"), ("1", "the")]), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert sorted(map(tuple, map_lookup(idx, pairs, 16).collect()), key=str) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, x in enumerate(plan.split("\n")) if "/forward" in x or "forward]" in x)
    above = plan.split("\n")[:scan]
    depth = len(plan.split("\n")[scan]) - len(plan.split("\n")[scan].lstrip(" :+-*()0123456789"))
    joins = [x for x in above if "LeftSemi" in x]
    assert joins and "BroadcastHashJoin" in joins[0] and depth > 0
