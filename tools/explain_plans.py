"""Write PLANS.md: the physical plans of the headline jobs at sf0.01.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spindle.operators.index import build_index, inverted_blocks  # noqa: E402
from spindle.operators.rank import matched_scores, rank, rank_batch  # noqa: E402
from spindle.plans.catalog import Q_MID  # noqa: E402
from spindle.plans.jobs import add_job  # noqa: E402
from spindle.session import local_session, scratch_path  # noqa: E402
from spindle.sources.documents import corpus, load_table  # noqa: E402
from spindle.sources.store import save_index  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue().strip()
    # The trim set holds control characters; print them escaped.
    return "".join(c if c == "\n" or ord(c) >= 0x20 else f"\\x{ord(c):02x}" for c in text)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    docs = corpus(spark, sf)
    lazy = build_index(docs)
    stored_root = scratch_path(spark, "plans-index")
    stored = save_index(lazy, stored_root, n_buckets=8)
    added = add_job(spark, corpus(spark, sf, "benchmark"), stored_root, scratch_path(spark, "plans-added"))
    sections = [
        ("Build: tokenize + term frequency",
         "One scan of (doc_id, text), round-robin spread only because the test file is one "
         "split, explode + code-generated sanitize, partial count, one shuffle on (title, term).",
         lazy.flat()),
        ("Rank, one query, stored index: matched scores",
         "PartitionFilters on term_bucket and PushedFilters In(term) on postings and lexicon; "
         "only bounded broadcasts (the query weights; D and avgdl are literals from the one-row stats); partial + final sum by title.",
         matched_scores(stored, Q_MID, "bm25")),
        ("Rank, top 10 of every document",
         "The matched top 10, and the first titles of the documents without a match behind a scalar "
         "subquery: fewer than 10 positive scores. Adaptive execution drops that branch otherwise.",
         rank(stored, Q_MID, "bm25", 10)),
        ("Rank, every document kept",
         "Documents (title only) left-joined null-safely with the matched scores.",
         rank(stored, Q_MID, "bm25", None)),
        ("Batch ranking over the benchmark table",
         "Last step: what upper bounds left (a written table) and its other terms, in pruned bucket "
         "directories; partial WindowGroupLimit before the shuffle for row_number() <= 10.",
         rank_batch(stored, load_table(spark, sf, "benchmark"), "bm25", 10, "item_id", "text")),
        ("Postings of an added index",
         "The segments as they lie, the older one without the (title, term) that the newer one "
         "overwrites: a join that the planner picks; no Exchange of the old postings.",
         added.postings),
        ("Inverted lists in bounded blocks",
         "Postings joined with the lexicon (df), block = hash(title) mod ceil(df / block_size); "
         "every collect_list group is bounded.",
         inverted_blocks(stored, 512)),
    ]
    out = ["# Physical plans of the headline jobs", "",
           f"Generated by `tools/explain_plans.py` on `{sf}` (local[8], AQE on). "
           "AQE may re-plan at run time; these are the initial plans.", ""]
    for title, note, df in sections:
        out += [f"## {title}", "", note, "", "```", plan(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
