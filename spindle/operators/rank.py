"""Rankers: naive TF/IDF and BM25 over an :class:`Index`.

Plan of one query (no Python in the hot path)::

    postings WHERE term IN (query terms)          -- pushed into the scan,
               AND tf >= the term's floor         -- if stored (operators/pruning.py)
      JOIN broadcast(query weights)                -- bounded by the query text
      GROUP BY title  SUM(term score)              -- partial + final
      ORDER BY score DESC, title ASC LIMIT k       -- TakeOrderedAndProject
      [UNION the first k other documents, score 0, if fewer than k are positive]

Query weights = lexicon rows of the query terms (df) joined with the
query's own term counts (qtf); D and avgdl are literals read from the
one-row corpus statistics.

Semantics kept from the reference, on purpose:
* naive  = sum over the query terms in the document of ``qtf * tf / idf^2``
  (it divides by idf squared, so common terms weigh more);
* bm25   = sum over the *distinct* query terms of
  ``idf * tf * (k + 1) / (tf + k * (1 - b + b * D / avgdl))`` -- the
  normaliser uses the corpus size D, not the document length;
* every indexed document is ranked, documents without a query term score 0,
  and negative scores (terms in more than half the documents) sort below
  them. Ties, unordered in the reference, are broken by title ascending.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindle.functions.scoring import (BM25_B, BM25_K, DEFAULT_TOP_K, bm25_param, bm25_term,
                                       idf, naive_term, okapi_param, tfidf)
from spindle.functions.text import tokens
from spindle.operators.index import Index, materialize_index, term_bucket
from spindle.operators.joins import broadcast_if_small, fits_broadcast, join_null_safe, materialize
from spindle.operators.pruning import batch_scores, best, tf_floors

METHODS = ("bm25", "naive")
# Scores are sums whose last bits depend on the order of summation; rounded to
# this many decimals they order the same way on every run.
DEFAULT_DECIMALS = 9


def check_method(method: str) -> str:
    if method not in METHODS:
        raise ValueError(f"ranker must be one of {METHODS}, got {method!r}")
    return method


# ---------------------------------------------------------------------------
# Query side
# ---------------------------------------------------------------------------

def query_tokens(spark: SparkSession, query: str) -> DataFrame:
    """Tokens of one query string, in order, with repeats: ``(pos, term)``."""
    return spark.range(1).select(F.posexplode(tokens(F.lit(query))).alias("pos", "term"))


def query_profile(spark: SparkSession, query: str) -> list[tuple[str, int]]:
    """Distinct query terms with their count in the query, on the driver.

    The tokens come from the same Spark expressions as the documents'; the
    list is bounded by the length of the query string, not by the data, and
    lets the terms go into the scan filter as literals.
    """
    counts: dict[str, int] = {}
    for row in query_tokens(spark, query).collect():
        counts[row.term] = counts.get(row.term, 0) + 1
    return sorted(counts.items())


def query_terms(spark: SparkSession, query: str,
                profile: list[tuple[str, int]] | None = None) -> DataFrame:
    """``(term, qtf)``: distinct query terms and their count in the query."""
    profile = query_profile(spark, query) if profile is None else profile
    return spark.createDataFrame(profile, "term string, qtf bigint")


def query_term_list(spark: SparkSession, query: str) -> list[str]:
    """Distinct query terms on the driver (bounded by the query length)."""
    return [t for t, _ in query_profile(spark, query)]


def idf_table(index: Index, terms: list[str]) -> DataFrame:
    """``(term, df, idf)`` for the given terms that occur in the index."""
    c = index.scalars()
    lex = index.lexicon_for_terms(terms).select("term", "df")
    return lex.select("term", "df", idf(c.lit("d"), F.col("df")).alias("idf"))


def query_weights(index: Index, spark: SparkSession, query: str,
                  profile: list[tuple[str, int]] | None = None) -> DataFrame:
    """One row per distinct query term found in the index:
    ``(term, qtf, df, idf, d, avgdl, param)``. Bounded by the query."""
    profile = query_profile(spark, query) if profile is None else profile
    c = index.scalars()
    lex = index.lexicon_for_terms([t for t, _ in profile]).select("term", "df")
    w = lex.join(F.broadcast(query_terms(spark, query, profile)), "term")
    return w.select("term", "qtf", "df", idf(c.lit("d"), F.col("df")).alias("idf"),
                    c.lit("d").alias("d"), c.lit("avgdl").alias("avgdl"),
                    bm25_param(c.lit("d"), c.lit("avgdl")).alias("param"))


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

def matched_scores(index: Index, query: str, method: str = "bm25",
                   length_norm: str = "corpus", k1: float = BM25_K,
                   b: float = BM25_B, floors: dict[str, int] | None = None) -> DataFrame:
    """``(title, score)`` for the documents holding at least one query term
    (with ``floors``, see :func:`~spindle.operators.pruning.tf_floors`, for those
    that can be among the top k).

    ``length_norm="document"`` switches BM25 to the text-book normaliser
    (each document's own token count over the mean token count).
    """
    check_method(method)
    spark = index.postings.sparkSession
    profile = query_profile(spark, query)
    weights = query_weights(index, spark, query, profile)
    hits = index.postings_for_terms([t for t, _ in profile], floors).join(F.broadcast(weights), "term")
    if method == "naive":
        contrib = naive_term(F.col("qtf"), F.col("tf"), F.col("idf"))
    elif length_norm == "corpus":
        contrib = bm25_term(F.col("idf"), F.col("tf"),
                            bm25_param(F.col("d"), F.col("avgdl"), k1, b), k1)
    elif length_norm == "document":
        docs = index.documents().select("title", "n_tokens")
        avg_tokens = index.scalars().lit("avg_tokens")
        hits = join_null_safe(hits, docs, ["title"])
        contrib = bm25_term(F.col("idf"), F.col("tf"),
                            okapi_param(F.col("n_tokens"), avg_tokens, k1, b), k1)
    else:
        raise ValueError("length_norm must be 'corpus' or 'document'")
    return hits.groupBy("title").agg(F.sum(contrib).alias("score"))


def all_document_scores(index: Index, scores: DataFrame) -> DataFrame:
    """Every indexed document with its score, 0.0 when it matched nothing
    (one left join, whose strategy the planner picks by the sizes it meets)."""
    docs = index.documents().select("title")
    joined = join_null_safe(docs, scores, ["title"], "left")
    return joined.select("title", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))


def top_k(scores: DataFrame, k: int | None = DEFAULT_TOP_K,
          decimals: int | None = DEFAULT_DECIMALS) -> DataFrame:
    """Order by score descending, title ascending; keep ``k`` rows.

    The score is rounded to ``decimals`` first and the order uses the rounded
    value (so runs and engines that sum in a different order agree); None
    leaves raw sums, whose near-ties may change places between runs.
    """
    if decimals is not None:
        scores = scores.withColumn("score", F.round("score", decimals))
    ordered = scores.orderBy(F.desc("score"), F.asc("title"))
    return ordered.limit(k) if k is not None else ordered


def top_k_of_all(index: Index, scores: DataFrame, k: int, decimals: int | None = DEFAULT_DECIMALS) -> DataFrame:
    """The top ``k`` of every indexed document, of which ``scores`` holds those
    that matched; the others score 0.

    The matched top ``k`` come first. Documents without a match can only enter
    if fewer than ``k`` of these score above 0: a scalar subquery, which keeps
    every row of the documents out of the plan's joins otherwise. Of those with
    score 0 the first ``k`` titles are enough.
    """
    matched = top_k(scores, k, decimals)
    positive = matched.agg(F.count(F.when(F.col("score") > 0, F.lit(1))).alias("n")).scalar()
    rest = index.documents().select("title").where(positive < k)
    zeros = (join_null_safe(rest, scores.select("title"), ["title"], "left_anti")
             .select("title", F.lit(0.0).alias("score")).orderBy(F.asc("title")).limit(k))
    return matched.unionByName(zeros).orderBy(F.desc("score"), F.asc("title")).limit(k)


def rank(index: Index, query: str, method: str = "bm25", k: int | None = DEFAULT_TOP_K,
         matched_only: bool = False, length_norm: str = "corpus",
         decimals: int | None = DEFAULT_DECIMALS) -> DataFrame:
    """Ranked ``(title, score)`` for one query string, one lazy plan
    (``k`` None returns every document, ordered).

    ``matched_only=True`` skips documents without a query term (the report's
    planned improvement). Of a stored index only those postings are read whose
    tf leaves their document in question (``tf_floors``). Rank a stored or materialised index: over a lazy one
    each branch of the plan would tokenize the documents again.
    """
    floors = None
    if k and index.level_parts is not None and length_norm == "corpus":
        profile = query_profile(index.postings.sparkSession, query)
        floors = tf_floors(index, dict(profile), check_method(method), k, decimals)
    scores = matched_scores(index, query, method, length_norm, floors=floors)
    if matched_only:
        return top_k(scores, k, decimals)
    if k is None:
        return top_k(all_document_scores(index, scores), None, decimals)
    return top_k_of_all(index, scores, k, decimals)


def tfidf_postings(index: Index) -> DataFrame:
    """``(title, term, tf, df, idf, tfidf)`` for every posting. The postings
    of a lazy index and the term sizes are materialised first: documents are
    tokenized once, and the join of a hot term can be split."""
    index = materialize_index(index)
    d = index.scalars().lit("d")
    lex = index.solid(index.lexicon().select("term", "df"), "lexicon")
    weighted = index.flat().join(lex, "term")
    w_idf = idf(d, F.col("df"))
    return (weighted.select("title", "term", "tf", "df", w_idf.alias("idf"))
            .select("*", tfidf(F.col("tf"), F.col("idf")).alias("tfidf")))


# ---------------------------------------------------------------------------
# Many queries in one job
# ---------------------------------------------------------------------------

def batch_query_terms(queries: DataFrame, id_col: str = "query_id",
                      text_col: str = "text") -> DataFrame:
    """``(query_id, term, qtf)`` for a table of query strings."""
    toks = queries.select(F.col(id_col).alias("query_id"),
                          F.explode(tokens(F.col(text_col))).alias("term"))
    return toks.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def asked_postings(index: Index, queries: DataFrame, id_col: str = "query_id", text_col: str = "text") -> Index:
    """A materialised index with only the postings of the queries' terms, written
    once in the same order: a batch reads them several times. Documents and so D
    and avgdl stay those of the whole index. Too many terms to broadcast: as it is."""
    terms = materialize(batch_query_terms(queries, id_col, text_col).select("term").distinct(), "asked-terms")
    if not fits_broadcast(terms):
        return index
    asked = materialize(index.flat().join(F.broadcast(terms), "term", "left_semi"), "asked-postings")
    return replace(index, postings=asked, documents_df=index.documents())


def batch_weights(index: Index, queries: DataFrame, id_col: str = "query_id", text_col: str = "text") -> tuple[list[str], DataFrame]:
    """The join columns, and a row per query and term of the index:
    ``query_id``, the join columns, ``qtf``, ``df``, ``max_tf``, ``idf``, ``param`` and
    ``levels``: for each tf of the term how many postings have it or a larger one
    (``tf``, ``above``)."""
    qt = batch_query_terms(queries, id_col, text_col)
    c = index.scalars()
    # A stored index is joined on its bucket directories as well: Spark prunes
    # those that no query term falls into when it runs the plan. (It considers
    # that for a side with a comparison; this one holds for every row.)
    on, every = ["term"], F.lit(True)
    if index.n_buckets:
        on, every = ["term_bucket", "term"], F.col("term_bucket") >= 0
        qt = qt.withColumn("term_bucket", term_bucket(F.col("term"), index.n_buckets))
    qt = broadcast_if_small(qt)
    # Levels and postings are reduced to the queries' terms before they are summed.
    asked = qt.where(every).select(*on)
    if index.level_parts is not None:
        parts = index.level_parts.select(*on, "tf", "n").join(asked, on, "left_semi")
        levels = parts.groupBy(*on, "tf").agg(F.sum("n").alias("n")).where("n > 0")
    else:
        levels = index.postings.select(*on, "tf").join(asked, on, "left_semi").groupBy(*on, "tf").agg(F.count(F.lit(1)).alias("n"))
    falling = Window.partitionBy(*on).orderBy(F.desc("tf")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of_term = (levels.withColumn("above", F.sum("n").over(falling)).groupBy(*on)
               .agg(F.sum("n").alias("df"), F.max("tf").alias("max_tf"), F.collect_list(F.struct("tf", "above")).alias("levels")))
    weights = of_term.join(qt, on).select("query_id", *on, "qtf", "df", "max_tf", "levels",
                                          idf(c.lit("d"), F.col("df")).alias("idf"),
                                          bm25_param(c.lit("d"), c.lit("avgdl")).alias("param"))
    return on, weights


def batch_contribution(method: str) -> Callable[[Column], Column]:
    def contribution(tf: Column) -> Column:
        if method == "naive":
            return naive_term(F.col("qtf"), tf, F.col("idf"))
        return bm25_term(F.col("idf"), tf, F.col("param"))
    return contribution


def rank_batch(index: Index, queries: DataFrame, method: str = "bm25",
               k: int = DEFAULT_TOP_K, id_col: str = "query_id",
               text_col: str = "text", decimals: int | None = DEFAULT_DECIMALS) -> DataFrame:
    """Top-k per query for a table of queries: ``(query_id, rank, title, score)``.

    Only documents that hold at least one term of the query are ranked, and of
    these only the ones that upper bounds of their scores leave in question are
    scored in full (:mod:`spindle.operators.pruning`); the result is exact.
    The per-query term table grows with the number of queries, so it is
    broadcast only after a size check; top-k per query uses
    ``row_number() <= k``, which Spark plans with a partial group limit
    before the shuffle, so a query matching most documents never sorts
    them all in one task. ``k`` is therefore required: an unlimited rank
    per query would put a whole match set into one window partition.
    """
    check_method(method)
    if k is None or k < 1:
        raise ValueError("rank_batch needs a positive k (top-k per query)")
    index = materialize_index(index)
    if index.materialized:
        index = asked_postings(index, queries, id_col, text_col)
    on, weights = batch_weights(index, queries, id_col, text_col)
    # Rows of a title stand together in a materialised index, and in the forward table of a stored one.
    by_title, n_postings = None, 0
    if index.materialized:
        by_title, n_postings = index.flat(), index.postings.count()
    elif index.forward_df is not None and index.known_scalars is not None:
        by_title, n_postings = index.forward(), (index.known_scalars.d or 0) * (index.known_scalars.avgdl or 0)
    scores = batch_scores(index.postings.select(*on, "title", "tf"), on, weights, batch_contribution(method), k, decimals,
                          by_title, n_postings).scores
    if decimals is not None:
        scores = scores.withColumn("score", F.round("score", decimals))
    return best(scores, k, F.desc("score"), F.asc("title")).select("query_id", "rank", "title", "score")


def lexicon_idf(index: Index) -> DataFrame:
    """``(term, df, idf)`` for every term of the index."""
    index = materialize_index(index)
    d = index.scalars().lit("d")
    return index.lexicon().select("term", "df", idf(d, F.col("df")).alias("idf"))
