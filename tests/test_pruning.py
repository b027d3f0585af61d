"""Upper bounds in batch ranking, the top k without a join of all documents,
lookups, bad lines and shuffle width."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from spindle.functions.scoring import BM25_K
from spindle.operators.index import build_index, map_lookup
from spindle.operators.pruning import batch_scores, best
from spindle.operators.rank import (all_document_scores, batch_contribution, batch_weights, matched_scores,
                                    rank, rank_batch, top_k)
from spindle.plans.jobs import build_job
from spindle.session import WIDTH_CONF, input_bytes, shuffle_width
from spindle.sources.documents import corpus, load_table, read_documents_json_checked

from conftest import SF_ORACLE, SF_SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return build_job(corpus(spark, SF_ORACLE), str(tmp_path_factory.mktemp("pruning") / "idx"), n_buckets=8)


def plain_batch(index, queries, method, k, id_col, text_col):
    """Every matching document scored in full."""
    on, weights = batch_weights(index, queries, id_col, text_col)
    hits = index.postings.select(*on, "title", "tf").join(weights, on)
    scores = hits.groupBy("query_id", "title").agg(F.round(F.sum(batch_contribution(method)(F.col("tf"))), 9).alias("score"))
    return scores, best(scores, k, F.desc("score"), F.asc("title")).select("query_id", "rank", "title", "score")


def rows(df, places=6):
    return sorted((tuple(round(x, places) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("method", ["bm25", "naive"])
def test_pruned_batch_is_exact_and_scores_fewer_documents(spark, stored, method):
    queries = load_table(spark, SF_ORACLE, "benchmark")
    all_scores, want = plain_batch(stored, queries, method, 10, "item_id", "text")
    assert rows(rank_batch(stored, queries, method, 10, "item_id", "text")) == rows(want)
    on, weights = batch_weights(stored, queries, "item_id", "text")
    found = batch_scores(stored.postings.select(*on, "title", "tf"), on, weights, batch_contribution(method), 10, 9)
    matching, left = all_scores.count(), found.left.count()
    assert matching == 28945 and left < 12_000          # 10,966 for bm25, 6,449 for naive


def test_pruning_edges(spark, micro):
    """Negative idf, ties, fewer matches than k, null and repeated query ids, no query."""
    index = build_index(micro)
    queries = spark.createDataFrame([(1, "hello hat"), (1, "world"), (None, "the the end"), (3, "nowhere"), (4, "the hat hello world end note cat")],
                                    "query_id int, text string")
    for method in ("bm25", "naive"):
        for k in (1, 2, 50):
            from spindle.operators.index import materialize_index
            solid = materialize_index(index)
            assert rows(rank_batch(solid, queries, method, k)) == rows(plain_batch(solid, queries, method, k, "query_id", "text")[1])
    assert rank_batch(index, queries.limit(0)).collect() == []
    assert BM25_K > 0          # bounds hold as contributions grow with tf


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def executed(df):
    """The final adaptive plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", ["esat estion aiment", "in", "nowhere", "hello world", "the in", "esat nowhere"])
def test_top_k_equals_the_join_of_all_documents(stored, query):
    for method in ("bm25", "naive"):
        for k in (1, 10, 2000):
            want = top_k(all_document_scores(stored, matched_scores(stored, query, method)), k).collect()
            assert [tuple(r) for r in rank(stored, query, method, k).collect()] == [tuple(r) for r in want]


def test_top_k_keeps_documents_out_of_the_joins(spark, stored):
    """With k positive scores no row of the documents table is shuffled."""
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        df = rank(stored, "esat estion aiment", "bm25", 10)
        assert "scalar-subquery" in plan_text(df) or "Subquery" in plan_text(df)
        plan = executed(df)
        final = plan.split("== Initial Plan ==")[0]
        # The branch of the other documents is empty at run time: adaptive execution drops it with its joins.
        assert "LeftAnti" not in final
        assert "LeftAnti" in executed(rank(stored, "nowhere esat", "bm25", 2000)).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_map_lookup_moves_only_the_blocks_asked_for(spark, stored):
    pairs = spark.createDataFrame([("1", "the"), ("1", "nowhere"), (None, "the"), ("2", "of"), ("2", "of")], "title string, term string")
    found = map_lookup(stored, pairs, 16)
    tf = {(r.title, r.term): r.tf for r in stored.flat().where("title IN ('1', '2')").collect()}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((t, w, tf.get((t, w), 0)) for t, w in map(tuple, pairs.collect())), key=str)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Between the scan of the index and the join with the blocks asked for stands no exchange.
    lines = plan.split("== Initial Plan ==")[0].split("\n")
    scan = max(i for i, x in enumerate(lines) if "Scan parquet" in x and "tf" in x and "term" in x)
    above = [x for x in lines[:scan] if "Exchange" in x or "Join" in x]
    assert "BroadcastHashJoin" in above[-1]


def test_bad_lines_are_returned(spark, scratch):
    path = os.path.join(scratch, "in")
    lines = ['{"title": "A", "text": "good one"}', '{"title": "B", "text": "cut', "", "   ", "no json", '["an", "array"]', '{"text": "no title"}',
             '{"title": 5, "text": "number as title", "more": 1}', '{"title": "C"}', "{}", "null", '{"title": "D", "text": "x"} trailing']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, bad = read_documents_json_checked(spark, path)
    assert {tuple(r) for r in good.collect()} >= {("A", "good one"), (None, "no title"), ("5", "number as title"), ("C", None)}
    got = {r.line for r in bad.collect()}
    assert got >= {'{"title": "B", "text": "cut', "no json"} and not got & {"", "   "}
    assert all(r.file.startswith("file:") for r in bad.collect())
    assert good.count() + bad.count() == len(lines) - 2


def test_bad_lines_through_the_command_line(spark, scratch, capsys):
    from spindle import cli
    path, index, bad = (os.path.join(scratch, x) for x in ("in", "idx", "bad"))
    spark.createDataFrame([('{"title": "A", "text": "good words"}',), ("broken",)], "value string").write.text(path)
    assert cli.main(["index", path, index, "build", "--bad-lines", bad], spark) == 0
    assert "1 malformed lines" in capsys.readouterr().out
    assert [r.line for r in spark.read.json(bad).collect()] == ["broken"]


def test_shuffle_width_follows_the_input(spark):
    postings = build_index(corpus(spark, SF_SMALL)).flat()
    size = os.path.getsize(os.path.join(SF_SMALL, "documents.parquet"))
    assert size / 2 <= input_bytes(postings) <= 4 * size
    before = spark.conf.get(WIDTH_CONF, None)
    for per_partition, want in ((size // 100, 100), (1 << 40, 8)):
        with shuffle_width(postings, per_partition):
            width = int(spark.conf.get(WIDTH_CONF))
            assert want <= width <= 4 * want
            df = build_index(corpus(spark, SF_SMALL)).flat()
            assert "hashpartitioning(title" in plan_text(df) and f", {width})" in plan_text(df)
        assert spark.conf.get(WIDTH_CONF, None) == before
