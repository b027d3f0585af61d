"""Builds count documents in title order: no shuffle of postings, no title whole
in one task. The tables must hold what the plain aggregate gives."""
import os

from pyspark.sql import functions as F

from spindle.operators.index import build_index, postings_by_title, term_frequency
from spindle.plans.jobs import build_job
from spindle.sources.documents import corpus

from conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.select("title", "term", "tf").collect()), key=repr)


def test_postings_are_not_shuffled_by_title_and_term(spark):
    plan = plan_text(postings_by_title(corpus(spark, SF_SMALL)))
    assert "rangepartitioning(title" in plan and "hashpartitioning(title" not in plan


def test_large_titles_are_cut(spark):
    docs = corpus(spark, SF_SMALL).withColumn("title", F.when(F.col("title").cast("int") % 3 != 0, F.col("title")))
    made = postings_by_title(docs, text_per_task=20_000)
    assert rows(made) == rows(term_frequency(docs))
    holders = made.withColumn("part", F.spark_partition_id()).where("title IS NULL").select("part").distinct().count()
    assert holders > 1


def test_stored_build_holds_the_plain_aggregate(spark, scratch):
    docs = corpus(spark, SF_SMALL)
    want = rows(term_frequency(docs))
    for forward in (True, False):
        made = build_job(docs, os.path.join(scratch, str(forward)), n_buckets=2, forward=forward)
        assert rows(made.postings) == want and rows(made.forward()) == want
        sizes = {tuple(r) for r in made.documents().collect()}
        assert sizes == {tuple(r) for r in build_index(docs).documents().collect()}
