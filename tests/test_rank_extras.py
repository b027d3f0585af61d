"""Batch ranking, average precision, okapi variant, streaming add."""

import pytest
from pyspark.sql import functions as F

from spindle.operators.evaluate import average_precision
from spindle.operators.index import build_index
from spindle.operators.rank import rank, rank_batch
from spindle.sources.documents import corpus
from spindle.streaming.add import streaming_build
from tests.conftest import SF_SMALL


def test_batch_matches_single_query_matched_only(spark, micro):
    idx = build_index(micro)
    queries = spark.createDataFrame([(1, "hello world"), (2, "the hat"), (3, "zzz")],
                                    "query_id int, text string")
    got = rank_batch(idx, queries, "bm25", k=10, decimals=6).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r.query_id, []).append((r.rank, r.title, r.score))
    assert by_q[1] == [(1, "B", 0.656121), (2, "C", 0.252354), (3, "E", 0.252354)]
    assert by_q[2] == [(1, "A", 0.908475), (2, "E", 0.504708)]
    assert 3 not in by_q
    single = rank(idx, "hello world", "bm25", None, matched_only=True, decimals=6).collect()
    assert [(r.title, r.score) for r in single] == [(t, s) for _, t, s in by_q[1]]


def test_average_precision(spark):
    ranked = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "x"), (2, 2, "y")],
        "query_id int, rank int, title string")
    relevant = spark.createDataFrame([("b",), ("c",)], "title string")
    got = {r.query_id: (r.n_relevant, round(r.ap, 6)) for r in average_precision(ranked, relevant).collect()}
    # query 1: hits at ranks 2 and 3 -> (1/2 + 2/3) / 2
    assert got[1] == (2, round((0.5 + 2 / 3) / 2, 6))
    assert got[2] == (0, 0.0)


def test_okapi_uses_document_length(spark):
    # cat is in 2 of 5 documents, so its idf is positive
    docs = spark.createDataFrame([("A", "cat"), ("B", "cat dog dog dog dog"), ("C", "fish"),
                                  ("D", "bird"), ("E", "frog")], "title string, text string")
    idx = build_index(docs)
    corpus_norm = {r.title: r.score for r in rank(idx, "cat", "bm25", None).collect()}
    doc_norm = {r.title: r.score for r in rank(idx, "cat", "bm25", None, length_norm="document").collect()}
    assert corpus_norm["A"] == pytest.approx(corpus_norm["B"])
    assert doc_norm["A"] > doc_norm["B"]


def test_streaming_add_equals_batch_build(spark):
    docs = corpus(spark, SF_SMALL)
    streamed = streaming_build(spark, docs, batches=3).flat()
    batch = build_index(docs).flat()
    assert streamed.exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed).count() == 0


def test_streaming_repeated_title_is_merged(spark, scratch):
    import os
    from spindle.streaming.add import run_streaming_add
    src = os.path.join(scratch, "src")
    spark.createDataFrame([("A", "xx yy")], "title string, text string").write.parquet(src + "/1")
    spark.createDataFrame([("A", "xx xx")], "title string, text string").write.parquet(src + "/2")
    # one source folder with both files, read one file per micro-batch
    flat = os.path.join(scratch, "flat")
    for part in ("1", "2"):
        spark.read.parquet(src + "/" + part).write.mode("append").parquet(flat)
    idx = run_streaming_add(spark, flat, os.path.join(scratch, "idx"), os.path.join(scratch, "ck"))
    got = sorted((r.title, r.term, r.tf) for r in idx.flat().collect())
    assert got in ([("A", "xx", 2), ("A", "yy", 1)], [("A", "xx", 1), ("A", "yy", 1)])


def test_batch_requires_positive_k(spark, micro):
    queries = spark.createDataFrame([(1, "hello")], "query_id int, text string")
    for k in (None, 0):
        with pytest.raises(ValueError):
            rank_batch(build_index(micro), queries, "bm25", k=k)


def test_streaming_sink_skips_replays_and_continues_new_runs(spark, scratch):
    import os
    from spindle.streaming.add import IndexAppender
    root = os.path.join(scratch, "idx")
    b1 = spark.createDataFrame([("A", "xx yy")], "title string, text string")
    b2 = spark.createDataFrame([("B", "zz")], "title string, text string")
    first = IndexAppender(root, run="run-1", refresh_rows=0)
    first(b1, 0)
    first(b1, 0)          # replay of the same epoch: no new version
    second = IndexAppender(root, run="run-2", refresh_rows=0)
    second(b2, 0)         # a new stream: epoch 0 again, must be added
    got = sorted((r.title, r.term, r.tf) for r in second.current(spark).flat().collect())
    assert got == [("A", "xx", 1), ("A", "yy", 1), ("B", "zz", 1)]
    log = spark.read.parquet(os.path.join(root, "_log"))
    assert log.where("kind = 'version'").count() == 2
    assert log.where("kind = 'pending'").count() == 2


def test_streaming_refresh_interval_equals_sequential_adds(spark, scratch):
    import os
    from spindle.streaming.add import IndexAppender
    root = os.path.join(scratch, "idx")
    batches = [
        [("A", "xx yy")],
        [("A", "xx xx"), ("B", "zz")],
        [("B", "ww")],
    ]
    sink = IndexAppender(root, run="r", refresh_rows=1_000_000)
    for epoch, rows_ in enumerate(batches):
        sink(spark.createDataFrame(rows_, "title string, text string"), epoch)
    want = [("A", "xx", 2), ("A", "yy", 1), ("B", "ww", 1), ("B", "zz", 1)]
    # Nothing flushed yet, below the refresh size: logged batches show all the same.
    assert sorted((r.title, r.term, r.tf) for r in sink.current(spark).flat().collect()) == want
    sink.flush(spark)
    sink(spark.createDataFrame(batches[2], "title string, text string"), 2)      # replayed after a flush
    got = sorted((r.title, r.term, r.tf) for r in sink.current(spark).flat().collect())
    assert got == [("A", "xx", 2), ("A", "yy", 1), ("B", "ww", 1), ("B", "zz", 1)]
    stats = sink.current(spark).stats().first()
    assert (stats.d, stats.n_postings) == (2, 4)
