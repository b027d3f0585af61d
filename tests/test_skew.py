"""Hot keys: a title holding a third of the rows, a term in most documents.

The corpus is derived from the driver's documents table; a plain-Python
tokenizer (written from the rules, not from the Spark code) is the brute
force it is checked against.
"""

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import functions as F

from spindle.operators.index import build_index, inverted_blocks, term_frequency
from spindle.sources.documents import corpus
from tests.conftest import SF_SMALL

SPLIT = re.compile(r"[ \t\n\x0b\x0c\r]")
PUNCT = re.compile(r"('s)|([!-,./:-@\[-`{-~])")


def py_terms(text):
    for piece in SPLIT.split(text or ""):
        t = PUNCT.sub(" ", piece).strip("".join(chr(c) for c in range(0x21))).lower()
        if len(t.encode("utf-16-le")) // 2 > 1:
            yield t


def test_hot_title_term_frequency_matches_brute_force(spark):
    docs = corpus(spark, SF_SMALL).withColumn(
        "title", F.when(F.col("title").cast("int") % 3 == 0, F.lit("hot")).otherwise(F.col("title")))
    got = {(r.title, r.term): r.tf for r in term_frequency(docs).collect()}
    want = Counter()
    for r in docs.collect():
        for t in py_terms(r.text):
            want[(r.title, t)] += 1
    assert got == dict(want)


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_term_frequency_plan_combines_map_side(spark):
    assert "partial_count" in plan_text(term_frequency(corpus(spark, SF_SMALL)))


def test_hot_term_posting_list_is_cut_into_bounded_blocks(spark):
    idx = build_index(corpus(spark, SF_SMALL))
    top = idx.lexicon().orderBy(F.desc("df")).first()
    blocks = inverted_blocks(idx, block_size=8).where(F.col("term") == top.term).collect()
    assert sum(b.n for b in blocks) == top.df
    assert len(blocks) >= top.df // 8
    assert max(b.n for b in blocks) <= 8 * 4


def test_blocks_of_a_hot_term_come_from_several_tasks(spark):
    """A term in every document: its join can be split, and its blocks are
    dealt out by an exchange of their own."""
    docs = spark.range(20_000).select(F.col("id").cast("string").alias("title"), F.lit("hot words").alias("text"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        blocks = inverted_blocks(build_index(docs), 64)
        rows = blocks.select("term", "block", "n", F.spark_partition_id().alias("task")).where("term = 'hot'").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(r.n for r in rows) == 20_000 and len(rows) == 313
    assert len({r.task for r in rows}) > 1


def test_planning_term_frequency_runs_nothing(spark):
    docs = spark.createDataFrame([("A", "xx yy"), ("A", "xx yy")], "title string, text string").dropDuplicates()
    group = "plan-only"
    spark.sparkContext.setJobGroup(group, "")
    try:
        term_frequency(docs)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0
