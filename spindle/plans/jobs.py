"""User-level jobs: build, add, rank (the reference's two spark-submit
programs, as functions over a caller-owned session)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindle.operators.index import Index, build_index
from spindle.operators.rank import DEFAULT_TOP_K, check_method, rank
from spindle.sources.store import add_segment, load_index, save_index


def build_job(docs: DataFrame, out_root: str, n_buckets: int | None = None,
              forward: bool = True, n_files: int | None = None) -> Index:
    """Index a document table ``(title, text)`` and store it at ``out_root``."""
    return save_index(build_index(docs), out_root, n_buckets, forward, n_files)


def add_job(spark: SparkSession, new_docs: DataFrame, old_root: str, out_root: str,
            forward: bool = True, n_files: int | None = None, layout: str = "append") -> Index:
    """Add documents to a stored index and write the merged index to a new path.

    A title that is already indexed keeps its old terms, and every term it
    has in the new documents takes the new count ("new wins"). ``layout`` says
    how the result is stored, whatever the sizes: ``append`` writes the new part
    as one more segment and names the old ones (whose folder stays in use);
    ``resort`` writes all of it in one global order, as an index that needs no
    other folder. The contents are the same.
    """
    return merge_into(spark, old_root, build_index(new_docs), out_root, forward, n_files, layout)


def merge_into(spark: SparkSession, old_root: str, new: Index, out_root: str, forward: bool = True,
               n_files: int | None = None, layout: str = "append") -> Index:
    """Store ``merge(index at old_root, new)`` at ``out_root``."""
    if layout not in ("append", "resort"):
        raise ValueError(f"layout must be append or resort, got {layout!r}")
    return add_segment(spark, old_root, new, out_root, forward, n_files, whole=layout == "resort")


def rank_job(spark: SparkSession, root: str, method: str, query: str,
             k: int | None = DEFAULT_TOP_K) -> DataFrame:
    """Top-k ``(title, score)`` of a stored index for one query."""
    return rank(load_index(spark, root), query, check_method(method), k)
