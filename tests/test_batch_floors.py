"""Candidates of a batch by rare terms and by largest postings, and the tf from which a posting counts."""
import os

import pytest
from pyspark.sql import functions as F

from spindle.operators.index import build_index, materialize_index
from spindle.operators.pruning import batch_scores, best
from spindle.operators.rank import asked_postings, batch_contribution, batch_weights, rank_batch
from spindle.plans.jobs import build_job
from spindle.sources.documents import corpus, load_table

from conftest import SF_ORACLE, SF_SMALL


def scored(index, queries, method, k, route):
    on, weights = batch_weights(index, queries)
    args = (index.postings.select(*on, "title", "tf"), on, weights, batch_contribution(method), k, 6)
    found = batch_scores(*args, index.forward(), {"floors": 1 << 40, "title order": 0}[route]) if route else batch_scores(*args)
    brute = args[0].join(weights, on).groupBy("query_id", "title").agg(F.sum(args[3](F.col("tf"))).alias("score"))
    return found, brute


def top(scores, k):
    rounded = scores.withColumn("score", F.round("score", 6))
    return sorted(((r.query_id, r.title, r.score) for r in best(rounded, k, F.desc("score"), F.asc("title")).collect()), key=str)


def test_common_terms_give_the_threshold_where_they_decide(spark):
    """Rare words stand in short documents, the common one decides by its tf: most documents that hold it are out."""
    docs = [(f"common {i:03d}", "alpha " * i) for i in range(1, 301)]
    docs += [(f"rare {i:03d}", f"rare{i % 20} other") for i in range(400)]
    index = materialize_index(build_index(spark.createDataFrame(docs, "title string, text string")))
    queries = spark.createDataFrame([(1, "alpha " + " ".join(f"rare{i}" for i in range(20)))], "query_id int, text string")
    for route in ("floors", "title order", None):
        found, brute = scored(index, queries, "naive", 2, route)
        assert top(found.scores, 2) == top(brute, 2)
        assert found.left.count() < 60          # 300 or more by the rare words alone


def test_naive_batch_leaves_few_documents_of_a_table(spark):
    index = materialize_index(build_index(corpus(spark, SF_ORACLE)))
    queries = load_table(spark, SF_ORACLE, "benchmark").selectExpr("item_id AS query_id", "text")
    found, brute = scored(index, queries, "naive", 10, "floors")
    assert top(found.scores, 10) == top(brute, 10)
    assert found.left.count() < 2000 * 3        # 6,449 before


@pytest.mark.parametrize("method", ["bm25", "naive"])
def test_every_route_gives_the_same_top(spark, scratch, method):
    """Negative idf, repeated words, null titles and query ids, fewer documents than k."""
    docs = corpus(spark, SF_SMALL).withColumn("title", F.when(F.col("title") % 50 != 7, F.col("title")))
    queries = spark.createDataFrame([(1, "the in of and esat"), (2, "esat esat estion aiment"), (3, "in"), (None, "nowhere de la"), (5, "en the unknown"), (6, "in the")],
                                    "query_id int, text string")
    stored = build_job(docs, os.path.join(scratch, "idx"), n_buckets=4)
    plain = materialize_index(build_index(docs))
    for index, k, routes in ((stored, 3, ("floors", "title order")), (asked_postings(plain, queries), 150, ("floors", None))):
        for route in routes:
            found, brute = scored(index, queries, method, k, route)
            assert top(found.scores, k) == top(brute, k)


def test_asked_postings_keep_the_statistics_of_the_index(spark, micro):
    index = materialize_index(build_index(micro))
    queries = spark.createDataFrame([(1, "hat nowhere"), (2, "hello")], "query_id int, text string")
    asked = asked_postings(index, queries)
    assert sorted(map(tuple, asked.flat().collect())) == sorted(map(tuple, index.flat().where("term IN ('hat', 'hello')").collect()))
    assert asked.stats().collect() == index.stats().collect()
    assert rank_batch(asked, queries).collect() == rank_batch(index, queries).collect()


def test_floors_route_prunes_buckets(spark, scratch):
    stored = build_job(corpus(spark, SF_SMALL), os.path.join(scratch, "idx"), n_buckets=8)
    queries = spark.createDataFrame([(1, "esat estion aiment")], "query_id int, text string")
    found, _ = scored(stored, queries, "naive", 3, "floors")
    plan = found.scores._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "SortMergeJoin" not in plan
