"""Command line: the reference's two programs, same arguments.

    spark-submit spindle/cli.py index <input-json> <index-path> build
    spark-submit spindle/cli.py index <input-json> <index-path> add <old-index-path>
    spark-submit spindle/cli.py index <input-json> <index-path> build --bad-lines <path>
    spark-submit spindle/cli.py rank  <index-path> naive|bm25 "<query>" [k]

The master comes from spark-submit (never set here). ``index ... add``
writes the merged index to ``<index-path>``, a new path, as the reference
does (it names the segments of the old index, whose path stays in use). ``rank`` prints the top k ``(title, score)`` rows (10 by default).
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from spindle.operators.rank import METHODS  # noqa: E402
from spindle.plans.jobs import add_job, build_job, rank_job  # noqa: E402
from spindle.session import ensure_checkpoint_dir  # noqa: E402
from spindle.sources.documents import read_documents_json, read_documents_json_checked  # noqa: E402


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spindle")
    sub = p.add_subparsers(dest="command", required=True)
    ix = sub.add_parser("index", help="build an index, or add documents to one")
    ix.add_argument("input", help="JSON-lines documents (file or folder) with title and text")
    ix.add_argument("index", help="where the index is written (must not exist)")
    ix.add_argument("mode", choices=("build", "add"))
    ix.add_argument("old", nargs="?", help="stored index to add to (mode add)")
    ix.add_argument("--bad-lines", metavar="PATH", help="write the input's malformed lines there (file, line) and print their number")
    rk = sub.add_parser("rank", help="rank the documents of a stored index for one query")
    rk.add_argument("index")
    rk.add_argument("method", choices=METHODS)
    rk.add_argument("query")
    rk.add_argument("k", nargs="?", type=int, default=10)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "index" and args.mode == "add" and not args.old:
        parser().error("mode add needs the old index path")
    spark = spark or SparkSession.builder.appName("spindle").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.command == "index":
        docs = read_documents_json(spark, args.input)
        if args.bad_lines:
            docs, bad = read_documents_json_checked(spark, args.input)
            bad.write.mode("errorifexists").json(args.bad_lines)
            print(f"{spark.read.schema('file string, line string').json(args.bad_lines).count()} malformed lines")
        if args.mode == "build":
            build_job(docs, args.index)
        else:
            add_job(spark, docs, args.old, args.index)
        return 0
    for row in rank_job(spark, args.index, args.method, args.query, args.k).collect():
        print(f"{row.score}\t{row.title}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
