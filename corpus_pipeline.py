"""The corpus pipeline: five stages over ``documents``, each one an operator of
:mod:`spindle.llm`. Every stage is written as a table under
``spark.checkpoint.dir`` and the next one reads that table.

ORACLE_SQL is None: the first and the fourth stage apply trained classifiers
and the second XXH64 fingerprints, which DuckDB cannot express. tests/llm
holds each stage against a brute-force version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import jump_shard, langid, mixing, simhash, template_decon
from spindle.llm.common import solid, table
from spindle.llm.queries import DOMAIN, SHARES


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents that it rejects go."""
    model = langid.fit(docs)
    # Numbered names, so that no column can clash with the prediction's.
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    judged = langid.predict(numbered, model, f"c{docs.columns.index('text')}", *(F.col(c) for c in numbered.columns))
    return judged.where("NOT rejected").select(*numbered.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with the smallest id
    stays (of repeated rows of this id one; of a component without any id one
    that has the smallest text hash)."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that contain an item go."""
    return template_decon.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its fitted rate says."""
    labels = table(spark, sf_dir, "labels")
    domains, steps, *_ = mixing.plan(docs, labels, F.expr(DOMAIN), SHARES)
    return mixing.apply_rates(docs, domains, steps)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: shard and slot of every document (a row for each copy)."""
    return jump_shard.assign(docs, shards=40).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language_id", keep_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing", mix_to_targets),
    ("sharding", assign_shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = solid(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
