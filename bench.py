"""Bench: the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Headline jobs (the reference's published measurements are for the same
three index jobs and for ranking):
  postings_count   tokenize + term frequency, count of postings
  index_build      build + store the index (postings, forward, documents,
                   lexicon, stats)
  index_load       open the stored index and count postings and documents
  index_add        add benchmark passages + conversations to the stored
                   index, write the merged index to a new path
  rank_bm25_top10 / rank_naive_top10   one query on the stored index
  rank_bm25_all    one query, every document scored
  rank_bm25_batch  top 10 for every benchmark passage as a query
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from spindle.operators.index import build_index  # noqa: E402
from spindle.operators.rank import rank, rank_batch  # noqa: E402
from spindle.plans.catalog import Q_MID, Q_REPEAT  # noqa: E402
from spindle.plans.jobs import add_job, build_job  # noqa: E402
from spindle.session import local_session, scratch_path  # noqa: E402
from spindle.sources.documents import corpus, load_table  # noqa: E402
from spindle.sources.store import load_index  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return time.perf_counter() - t0, out


def noop(df) -> None:
    """Run the whole plan, every column and the order included."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "spindle-bench")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spindle-bench-"))
    sf = sf_dir.rsplit("sf", 1)[-1]

    # Warm-up on the smallest data so class loading and codegen are not timed.
    small = "/root/testdata/sf0.001"
    if os.path.isdir(small) and small != sf_dir:
        warm = build_job(corpus(spark, small), scratch_path(spark, "bench-warm"))
        rank(warm, Q_MID, "bm25", 10).collect()
        rank(warm, Q_REPEAT, "naive", None).count()
        rank_batch(warm, load_table(spark, small, "benchmark"), "bm25", 10, "item_id", "text").count()

    results: dict[str, float] = {}
    docs = corpus(spark, sf_dir)

    results["postings_count"], n_post = timed(lambda: build_index(docs).flat().count())

    root = scratch_path(spark, "bench-index")
    results["index_build"], _ = timed(lambda: build_job(docs, root))

    def load_count():
        idx = load_index(spark, root)
        return idx.postings.count(), idx.documents().count()
    results["index_load"], _ = timed(load_count)

    new_docs = corpus(spark, sf_dir, "benchmark").unionByName(
        corpus(spark, sf_dir, "conversations").withColumn("title", F.concat(F.lit("c"), "title")))
    results["index_add"], _ = timed(
        lambda: add_job(spark, new_docs, root, scratch_path(spark, "bench-merged")))

    idx = load_index(spark, root)
    results["rank_bm25_top10"], _ = timed(lambda: rank(idx, Q_MID, "bm25", 10).collect())
    results["rank_naive_top10"], _ = timed(lambda: rank(idx, Q_REPEAT, "naive", 10).collect())
    results["rank_bm25_all"], _ = timed(lambda: noop(rank(idx, Q_MID, "bm25", None)))
    bench_q = load_table(spark, sf_dir, "benchmark")
    results["rank_bm25_batch"], _ = timed(
        lambda: noop(rank_batch(idx, bench_q, "bm25", 10, "item_id", "text")))

    out = {"metric": "total_sec", "value": round(sum(results.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in results.items()},
           "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
           "postings": n_post, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
