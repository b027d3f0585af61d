"""Scoring formulas as column expressions.

All arithmetic is DOUBLE (literals go through ``F.lit`` of Python floats, so
no DECIMAL creeps in) and counts are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the reference ranker.
#   * BM25 k = 2.0 and b = 0.75
#   * smoothed idf = ln((D - n + 0.5) / (n + 0.5)) + 1e-10
#   * default top-k = 10
# ---------------------------------------------------------------------------
BM25_K = 2.0
BM25_B = 0.75
IDF_HALF = 0.5
IDF_NOISE = 1e-10
DEFAULT_TOP_K = 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idf(d: Column | str, n: Column | str) -> Column:
    """Smoothed idf of a term in ``n`` of ``d`` documents (negative when
    the term is in more than half of them)."""
    d, n = _col(d), _col(n)
    return F.log((d - n + F.lit(IDF_HALF)) / (n + F.lit(IDF_HALF))) + F.lit(IDF_NOISE)


def bm25_param(d: Column | str, avgdl: Column | str, k: float = BM25_K,
               b: float = BM25_B) -> Column:
    """Corpus-wide BM25 normaliser ``k * (1 - b + b * D / avgdl)``.

    The reference normalises with the corpus size D, not with the length of
    each document, so this is one constant for the whole index.
    """
    d, avgdl = _col(d), _col(avgdl)
    return F.lit(k) * (F.lit(1.0) - F.lit(b) + F.lit(b) * d / avgdl)


def okapi_param(doc_len: Column | str, avg_len: Column | str, k: float = BM25_K,
                b: float = BM25_B) -> Column:
    """Text-book BM25 normaliser with the document's own length."""
    doc_len, avg_len = _col(doc_len), _col(avg_len)
    return F.lit(k) * (F.lit(1.0) - F.lit(b) + F.lit(b) * doc_len / avg_len)


def bm25_term(idf_col: Column | str, tf: Column | str, param: Column | str,
              k: float = BM25_K) -> Column:
    """``idf * (tf * (k + 1)) / (tf + param)``."""
    idf_col, tf, param = _col(idf_col), _col(tf), _col(param)
    return idf_col * (tf * F.lit(k + 1.0)) / (tf + param)


def naive_term(qtf: Column | str, tf: Column | str, idf_col: Column | str) -> Column:
    """``qtf * tf / idf^2``; an idf of exactly 0 contributes 0 (the
    reference uses 0.0 to mean "not a query term")."""
    qtf, tf, idf_col = _col(qtf), _col(tf), _col(idf_col)
    return F.when(idf_col != F.lit(0.0), (qtf * tf) / (idf_col * idf_col)).otherwise(F.lit(0.0))


def tfidf(tf: Column | str, idf_col: Column | str) -> Column:
    """Per-posting weight ``tf * idf``."""
    return _col(tf) * _col(idf_col)
