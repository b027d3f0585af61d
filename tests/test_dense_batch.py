"""Batches whose essential terms have more postings than the index are summed in title order."""
import os

import pytest
from pyspark.sql import functions as F

from spindle.operators.index import build_index, materialize_index
from spindle.operators.pruning import batch_scores, best
from spindle.operators.rank import batch_contribution, batch_weights
from spindle.plans.jobs import build_job
from spindle.sources.documents import corpus

from conftest import SF_SMALL


def top(scores, k):
    return {(r.query_id, r.title, r.score) for r in best(scores.withColumn("score", F.round("score", 6)), k, F.desc("score"), F.asc("title")).collect()}


@pytest.mark.parametrize("method", ["bm25", "naive"])
def test_title_order_gives_the_same_top(spark, scratch, method):
    docs = corpus(spark, SF_SMALL).withColumn("title", F.when(F.col("title") != "7", F.col("title")))
    queries = spark.createDataFrame([(1, "the in of and esat"), (2, "esat estion aiment"), (3, "in"), (4, "nowhere at all"), (5, "en the unknown")], "query_id int, text string")
    stored = build_job(docs, os.path.join(scratch, method), n_buckets=4)
    for index in (stored, materialize_index(build_index(docs))):
        on, weights = batch_weights(index, queries)
        add = batch_contribution(method)
        args = (index.postings.select(*on, "title", "tf"), on, weights, add, 5, 6)
        dense = batch_scores(*args, index.forward(), 0)
        brute = args[0].join(weights, on).groupBy("query_id", "title").agg(F.sum(add(F.col("tf"))).alias("score"))
        assert top(dense.scores, 5) == top(batch_scores(*args).scores, 5) == top(brute, 5)
        # One pass: nothing is joined with the documents left, and few lists keep their order.
        assert "Join" not in dense.scores._jdf.queryExecution().executedPlan().toString()
        assert "Join" in batch_scores(*args, index.forward(), 1 << 40).scores._jdf.queryExecution().executedPlan().toString()
