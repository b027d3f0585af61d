"""Levels of the stored lists: the floors they give, the rows that a scan skips."""

import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindle.operators.pruning import tf_floors
from spindle.operators.rank import all_document_scores, matched_scores, query_profile, rank, top_k
from spindle.plans.jobs import add_job, build_job
from spindle.sources import store
from spindle.sources.documents import corpus

from conftest import SF_ORACLE

SCHEMA = "title string, text string"


def floors_of(spark, index, query, method, k, decimals=9):
    return tf_floors(index, dict(query_profile(spark, query)), method, k, decimals)


def ranked(df):
    return [(r.title, round(r.score, 6)) for r in df.collect()]


def plain(index, query, method, k):
    """Every posting of the query's terms and every document."""
    return top_k(all_document_scores(index, matched_scores(index, query, method)), k)


def rows_read(df, column):
    """Rows that the scans with ``column`` gave in the run of ``df``."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec" and column in node.simpleString(100).split("[", 1)[1].split("]")[0]:
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """40,000 documents; a word in 12,000 of them, up to 40 times in a few."""
    ids = spark.range(40_000)
    often = F.when(F.col("id") % 997 == 0, F.lit(40)).when(F.col("id") % 101 == 0, F.lit(7)).otherwise(F.lit(2))
    docs = ids.select(F.concat(F.lit("t"), "id").alias("title"), F.concat_ws(
        " ", F.when(F.col("id") % 10 < 3, F.repeat(F.lit("hot "), often)), F.when(F.col("id") % 10 < 4, F.lit("warm")),
        F.concat(F.lit("own"), F.col("id") % 5000)).alias("text"))
    return build_job(docs, str(tmp_path_factory.mktemp("levels") / "idx"), n_buckets=1, n_files=1)


@pytest.mark.parametrize("method", ["bm25", "naive"])
def test_a_hot_list_is_read_down_to_its_floor(spark, hot, method):
    floors = floors_of(spark, hot, "hot", method, 10)
    assert floors == {"hot": 40}
    whole = top_k(matched_scores(hot, "hot", method), 10)
    assert ranked(rank(hot, "hot", method, 10)) == ranked(whole)
    # 12,000 postings of the word; its head is in one page, or in two.
    assert rows_read(top_k(matched_scores(hot, "hot", method, floors=floors), 10), "tf") <= 2 * store.PAGE_ROWS
    assert rows_read(whole, "tf") >= 12_000
    # Another word of small weight moves the floor, not the result.
    assert ranked(rank(hot, "hot warm", method, 10)) == ranked(plain(hot, "hot warm", method, 10))


def test_levels_add_up_to_the_lexicon(spark, hot):
    levels = hot.levels_for_terms(["hot", "warm", "own7", "nowhere"])
    sums = {r.term: (r.df, r.cf) for r in levels.groupBy("term").agg(F.sum("n").alias("df"), F.sum(F.col("n") * F.col("tf")).alias("cf")).collect()}
    assert sums == {r.term: (r.df, r.cf) for r in hot.lexicon_for_terms(["hot", "warm", "own7"]).collect()}
    stored = hot.postings.where("term IN ('hot', 'warm', 'own7')").groupBy("term", "tf").count()
    assert {tuple(r) for r in levels.collect()} == {tuple(r) for r in stored.collect()}


def test_no_floor_without_a_threshold(spark, hot):
    assert floors_of(spark, hot, "nowhere", "bm25", 10) == {}
    assert floors_of(spark, hot, "", "bm25", 10) == {}
    assert floors_of(spark, hot, "hot", "bm25", 12_001) == {}            # fewer postings than k
    assert floors_of(spark, hot, "own7", "bm25", 3) == {}                # one level
    assert len(rank(hot, "hot", "bm25", 12_005).collect()) == 12_005     # filled up with other documents


def test_overwritten_postings_do_not_count(spark, scratch):
    """The largest tf of a word are replaced by small ones: they give no threshold."""
    random.seed(3)
    old = [(f"d{i}", "hot " * (9 if i < 12 else 1 + i % 3) + f"w{i}") for i in range(60)] + [(f"x{i}", "cold") for i in range(80)]
    new = [(f"d{i}", "hot") for i in range(11)] + [("new", "hot hot hot")]
    build_job(spark.createDataFrame(old, SCHEMA), os.path.join(scratch, "a"), n_buckets=2)
    index = add_job(spark, spark.createDataFrame(new, SCHEMA), os.path.join(scratch, "a"), os.path.join(scratch, "b"))
    assert {(r.tf, r.n) for r in index.levels_for_terms(["hot"]).collect()} == {
        (r.tf, r["count"]) for r in index.postings.where("term = 'hot'").groupBy("tf").count().collect()}
    assert floors_of(spark, index, "hot", "bm25", 5) == {"hot": 3}
    for k in (1, 5, 30, 200):
        for method in ("bm25", "naive"):
            assert ranked(rank(index, "hot cold", method, k)) == ranked(plain(index, "hot cold", method, k))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return build_job(corpus(spark, SF_ORACLE), str(tmp_path_factory.mktemp("levels-sf") / "idx"), n_buckets=8)


WORDS = ["the", "in", "of", "and", "esat", "estion", "aiment", "nowhere", "to", "is"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(words=st.lists(st.sampled_from(WORDS), min_size=1, max_size=6), k=st.sampled_from([1, 3, 10, 100]), method=st.sampled_from(["bm25", "naive"]))
def test_floors_change_no_result(stored, words, k, method):
    """Also with terms of a negative idf, repeated terms, ties."""
    query = " ".join(words)
    assert ranked(rank(stored, query, method, k)) == ranked(plain(stored, query, method, k))
