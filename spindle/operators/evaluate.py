"""Ranking quality: average precision at k.

AP of one query = mean of precision@i over the ranks i that hold a relevant
document, 0 when none does (relevance is a per-document flag, e.g.
``labels.quality = 1``). The window is per query over at most k rows, so
no group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def average_precision(ranked: DataFrame, relevant: DataFrame) -> DataFrame:
    """``ranked(query_id, rank, title, ...)`` + ``relevant(title)`` ->
    ``(query_id, n_ranked, n_relevant, ap)``."""
    marks = relevant.select("title").dropDuplicates(["title"]).withColumn("hit", F.lit(1))
    flagged = (ranked.join(marks, "title", "left")
               .withColumn("hit", F.coalesce(F.col("hit"), F.lit(0))))
    w = (Window.partitionBy("query_id").orderBy("rank")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = flagged.withColumn("hits", F.sum("hit").over(w))
    precision_at_hit = F.when(F.col("hit") == 1, F.col("hits") / F.col("rank"))
    return running.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_ranked"),
        F.sum("hit").cast("bigint").alias("n_relevant"),
        F.coalesce(F.try_divide(F.sum(precision_at_hit), F.sum("hit")), F.lit(0.0)).alias("ap"))
