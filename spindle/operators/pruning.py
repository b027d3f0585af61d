"""Exact top-k of many queries without scoring every matching document.

A term adds at most its contribution at the largest tf it has anywhere
(``max_tf``) to a document's score, and never more than 0 where its idf is
negative; its levels tell how many postings have at least which tf. For each
query:

1. The rarest terms that together reach ``SEEDS * k`` documents, and of every term
   the postings of largest tf (``SEEDS * k`` at most), give candidates; the best
   ``CANDIDATES * k`` of them by these postings alone are scored in full, and the
   k-th of these scores is a threshold that the real k-th score reaches too.
2. The terms of the least bounds, together up to ``IDLE`` of the threshold, are set
   aside. What is left of the threshold is shared out among the other terms in
   proportion to their bounds. A document whose postings all stay under their
   term's share stays under the threshold: only documents that hold a posting of
   at least the tf that reaches its share (the term's floor) can enter.
3. Only these documents are scored in full.

Rare terms decide by their idf, common ones by their largest postings (the naive
ranker divides by idf squared, so there the common terms decide); a threshold from
either alone is weak for the other. The levels say how many postings reach their
floors before any is read. With too many of them, documents are scored by the terms
whose bounds together pass the threshold (essential terms), and by all where that
leaves them in question; if the essential terms have as many postings as the index,
both in one pass over the postings in title order, where the rows of a document
stand together.

So the long posting lists of common terms are scanned and met with documents
that are still in question, but never summed up for all documents. A query with
fewer than k candidates has no threshold, and all its postings count.

One query of a stored index is pruned in its scan: :func:`tf_floors` finds in the
levels of its terms (how many postings have which tf) the least tf that matters,
and the stored lists, largest tf first, are read down to it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from spindle.functions.scoring import BM25_K, bm25_param, bm25_term, idf, naive_term
from spindle.operators.index import Index
from spindle.operators.joins import fits_broadcast, join_null_safe, materialize

SEEDS, CANDIDATES, IDLE = 16, 4, 0.1
# A document in question is met with all its asked postings: about so many rows for
# each posting that reaches its floor, against a pass over all postings.
ROWS_PER_HEAD = 16


@dataclass(frozen=True)
class BatchScores:
    """``scores`` (query_id, title, score) holds the top k of each query;
    ``left`` are the (query_id, title) that were scored in full for it."""
    scores: DataFrame
    left: DataFrame
    weights: DataFrame


def every(on: list[str]) -> Column:
    """A comparison that holds for every row: Spark prunes directories at run
    time by a side that has one."""
    return F.length("term") >= 0 if on == ["term"] else F.col(on[0]) >= 0


def bounded(weights: DataFrame, contribution: Callable[[Column], Column], k: int) -> DataFrame:
    """``weights`` (a row per query and term) with ``bound``, ``bounds`` (of the
    query's terms up to this one, in the order of their bounds) and ``start``, the
    least tf of the postings that give candidates."""
    rare = Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    light = Window.partitionBy("query_id").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seed = F.coalesce(F.sum("df").over(rare), F.lit(0)) < SEEDS * k
    heads = F.array_min(F.transform(F.filter("levels", lambda x: x["above"] <= SEEDS * k), lambda x: x["tf"]))
    return (weights.withColumn("bound", F.greatest(contribution(F.col("max_tf")), F.lit(0.0)))
            .withColumn("bounds", F.sum("bound").over(light))
            .withColumn("start", F.when(seed, F.lit(1)).when(F.col("bound") > 0, heads).cast("bigint")))


def with_floors(weights: DataFrame, limit: DataFrame, contribution: Callable[[Column], Column]) -> DataFrame:
    """``weights`` with ``limit`` of their query, the ``floor`` of each term (null:
    none of its postings brings a document in), how many postings reach it
    (``heads``), ``essential`` and the bounds of the ``others`` together."""
    query = Window.partitionBy("query_id")
    held = join_null_safe(weights, limit, ["query_id"], "left")
    idle = F.col("bounds") <= F.lit(IDLE) * F.col("limit")
    essential = F.col("limit").isNull() | (F.col("bounds") >= F.col("limit"))

    def together(chosen: Column) -> Column:
        return F.coalesce(F.max(F.when(chosen, F.col("bounds"))).over(query), F.lit(0.0))

    held = (held.withColumn("essential", essential).withColumn("others", together(~essential))
            .withColumn("total", F.sum("bound").over(query)).withColumn("aside", together(idle)))
    share = (F.col("limit") - F.col("aside")) * F.col("bound") / (F.col("total") - F.col("aside")) * F.lit(1 - 1e-9)
    reached = (F.when(F.col("limit").isNull() | (F.col("limit") <= 0), F.col("levels"))
               .when(~idle, F.filter("levels", lambda x: contribution(x["tf"]) >= share)))
    return (held.withColumn("reached", reached)
            .withColumn("floor", F.array_min(F.transform("reached", lambda x: x["tf"])))
            .withColumn("heads", F.array_max(F.transform("reached", lambda x: x["above"])))
            .drop("reached", "levels", "total", "aside"))


def floored(postings: DataFrame, on: list[str], weights: DataFrame, floor: str, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Postings of a tf of at least ``floor``, a row for each query that asks for
    them; those under all floors of their term meet no query."""
    asked = weights.where(F.col(floor).isNotNull() & every(on))
    least = asked.groupBy(*on).agg(F.min(floor).alias("least"))
    rows = postings.join(hint(least), on).where(F.col("tf") >= F.col("least")).drop("least")
    return rows.join(hint(asked), on).where(F.col("tf") >= F.col(floor))


def with_titles(postings: DataFrame, on: list[str], titles: DataFrame, weights: DataFrame) -> DataFrame:
    """Postings of the terms of ``weights`` in documents of ``titles``
    (query_id, title), a row for each query that asks for both. The planner
    picks the join with the titles by their stored size."""
    asked = postings.join(weights.where(every(on)).select(*on), on, "left_semi")
    met = join_null_safe(asked, titles, ["title"])
    own = [c for c in weights.columns if c not in ("query_id", *on)]
    return join_null_safe(met, weights.select("query_id", *on, *own), ["query_id", *on])


def of_pairs(postings: DataFrame, on: list[str], pairs: DataFrame, weights: DataFrame, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The postings that make up the scores of ``pairs`` (query_id, title, stored):
    those of other titles are left out before queries multiply them."""
    if not fits_broadcast(pairs):
        return with_titles(postings, on, pairs, hint(weights))
    titles = F.broadcast(pairs.select("title").distinct())
    rows = join_null_safe(postings, titles, ["title"], "left_semi").join(hint(weights.where(every(on))), on)
    return join_null_safe(rows, F.broadcast(pairs), ["query_id", "title"], "left_semi")


def best(scores: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each query (planned with a partial group limit)."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return scores.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k)


def batch_scores(postings: DataFrame, on: list[str], weights: DataFrame, contribution: Callable[[Column], Column],
                 k: int, decimals: int | None, by_title: DataFrame | None = None, n_postings: float = 0) -> BatchScores:
    """``postings`` (``on``, title, tf) scored for the queries of ``weights``
    (query_id, ``on``, df, max_tf, levels and what ``contribution`` of a tf needs).
    ``decimals`` is what scores are rounded to afterwards: documents that could
    tie by it stay. ``by_title`` are the same ``n_postings`` rows in title order
    (title, term, tf), read where they are the cheaper ones."""
    leveled = materialize(bounded(weights, contribution, k), "batch-weights")
    weights = leveled.drop("levels")
    # Everything that is a part of the weights or has a column more is as small.
    hint = F.broadcast if fits_broadcast(weights) else (lambda df: df)
    add = contribution(F.col("tf"))

    seeds = floored(postings, on, weights, "start", hint).groupBy("query_id", "title").agg(F.sum(add).alias("part"))
    candidates = materialize(best(seeds, CANDIDATES * k, F.desc("part"), F.asc("title")).select("query_id", "title"), "batch-candidates")
    full = of_pairs(postings, on, candidates, weights, hint).groupBy("query_id", "title").agg(F.sum(add).alias("score"))
    limit = best(full, k, F.desc("score")).where(F.col("rank") == k).select("query_id", F.col("score").alias("limit"))

    # Sums in another order and rounding must not cost a document its place.
    slack = F.lit(1e-9) * (1 + F.abs("limit")) + F.lit(10.0 ** -decimals if decimals is not None else 0.0)
    held = materialize(with_floors(leveled, limit.withColumn("limit", F.col("limit") - slack), contribution), "batch-held")

    heads, dense = held.agg(F.sum("heads"), F.sum(F.when(F.col("essential"), F.col("df")))).first()
    if (heads or 0) * ROWS_PER_HEAD < n_postings:
        left = materialize(floored(postings, on, held, "floor", hint).select("query_id", "title").distinct(), "batch-left")
        scores = of_pairs(postings, on, left, held, hint).groupBy("query_id", "title").agg(F.sum(add).alias("score"))
        return BatchScores(scores, left, held)

    if by_title is not None and (dense or 0) >= n_postings:
        # So many rows to sum: in term order those of a (query, title) lie far apart,
        # often in several tasks. In title order they meet where they are read.
        terms = held.drop(*(c for c in on if c != "term"))
        sums = by_title.join(hint(terms), "term").groupBy("query_id", "title").agg(F.sum(add).alias("score"), F.first("limit").alias("limit"))
        in_question = F.col("limit").isNull() | (F.col("score") >= F.col("limit"))
        left = materialize(sums.where(in_question).select("query_id", "title", "score"), "batch-left")
        return BatchScores(left, left, held)

    in_question = F.col("limit").isNull() | (F.col("part") + F.col("others") >= F.col("limit"))
    parts = (postings.join(hint(held.where(F.col("essential") & every(on))), on).groupBy("query_id", "title")
             .agg(F.sum(add).alias("part"), F.first("limit").alias("limit"), F.first("others").alias("others")))
    left = materialize(parts.where(in_question).select("query_id", "title", "part"), "batch-left")
    # Many documents may be left for many queries: terms first, then what is left.
    rest = join_null_safe(postings.join(hint(held.where(~F.col("essential") & every(on))), on), left.select("query_id", "title"),
                          ["query_id", "title"], "left_semi")
    scores = (left.unionByName(rest.select("query_id", "title", add.alias("part")))
              .groupBy("query_id", "title").agg(F.sum("part").alias("score")))
    return BatchScores(scores, left, held)


# ---------------------------------------------------------------------------
# One query: the least tf that a posting needs
# ---------------------------------------------------------------------------

def term_bounds(index: Index, qtf: dict[str, int], method: str, k: int) -> list[Row]:
    """A row for each query term of a stored index: ``term``, ``idf``, ``param``,
    the largest and the least contribution of its postings (``most``, ``least``)
    and the k-th largest (``kth``, null for shorter lists). Read from the levels,
    whose number is that of a term's distinct tf."""
    c = index.scalars()
    term = Window.partitionBy("term")
    falling = term.orderBy(F.desc("tf")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = F.create_map(*(F.lit(x) for pair in sorted(qtf.items()) for x in pair))
    levels = index.levels_for_terms(list(qtf)).select(
        "term", "tf", F.sum("n").over(falling).alias("above"), idf(c.lit("d"), F.sum("n").over(term)).alias("idf"),
        bm25_param(c.lit("d"), c.lit("avgdl")).alias("param"), F.element_at(counts, F.col("term")).alias("qtf"))
    part = (naive_term(F.col("qtf"), F.col("tf"), F.col("idf")) if method == "naive"
            else bm25_term(F.col("idf"), F.col("tf"), F.col("param")))
    return (levels.withColumn("part", part).groupBy("term", "idf", "param")
            .agg(F.max("part").alias("most"), F.min("part").alias("least"), F.max(F.when(F.col("above") >= k, F.col("part"))).alias("kth"),
                 F.max("tf").alias("max_tf")).collect())


def least_tf(row: Row, qtf: int, method: str, need: float) -> int:
    """The least tf whose contribution can reach ``need``; one more than the
    term's largest tf if none does."""
    if row.most < need:
        return row.max_tf + 1
    if method == "naive":
        tf = need * row.idf * row.idf / qtf
    else:
        tf = need * row.param / (row.idf * (BM25_K + 1.0) - need)
    return max(1, math.ceil(tf * (1 - 1e-9)))


def tf_floors(index: Index, qtf: dict[str, int], method: str, k: int, decimals: int | None) -> dict[str, int]:
    """For terms of one query (``qtf``: their counts) the least tf of a posting
    that can stand in a document of the top ``k``; terms without a floor are left
    out, and without an own k-th score there are none.

    A term with at least k postings puts k documents at its k-th largest
    contribution or above (less what terms of a negative idf may take away), so
    the best such value is a threshold that the k-th score reaches. A document
    with a posting whose contribution stays under it even with all that the other
    terms can add is out. Leaving such postings unread only lowers the sums of
    documents that are out: the result is exact. A threshold of 0 or less gives
    no floors, as documents without a match score 0.
    """
    if not qtf:
        return {}
    rows = term_bounds(index, qtf, method, k)
    taken = sum(min(r.least, 0.0) for r in rows)
    limit = max((r.kth + taken - min(r.least, 0.0) for r in rows if r.kth is not None), default=0.0)
    limit -= 1e-9 * (1 + abs(limit)) + (10.0 ** -decimals if decimals is not None else 0.0)
    if limit <= 0:
        return {}
    added = sum(max(r.most, 0.0) for r in rows)
    floors = {}
    for r in rows:
        need = limit - (added - max(r.most, 0.0))
        if r.most > 0 and need > 0 and (at := least_tf(r, qtf[r.term], method, need)) > 1:
            floors[r.term] = at
    return floors
