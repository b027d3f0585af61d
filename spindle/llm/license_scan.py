"""Licence scans by canonical digest lookup.

A text's canonical form has no copyright lines, lower-case words only, single
spaces, and one spelling for words that licence matching counts as equal. The
digest of the whole form is hash-joined to the digests of known licences. A
document is looked up as a whole, and each of its lines as a whole, which finds
the licence notices inside other texts.

The known texts are a stated list (``known``, any DataFrame of identifier and
text; without one the texts of :mod:`license_texts` and its published digests of
long licences); its digests are broadcast after a check of their number, else joined by
a shuffle. Documents are not shuffled: only digests that matched are.

Nulls and edges: null, empty and wordless texts and lines have the digest of no
words, which matches nothing; a null id is carried; repeated rows repeat; a
text that fits several identifiers gets them all, in order; an empty table or
an empty list gives no match.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import Batches, small_batches, solid
from spindle.llm.license_texts import DIGESTS, EQUIVALENT, KNOWN

#: A line that states a copyright: (c), a year or a placeholder must follow the word.
COPYRIGHT = re.compile(r"^[^\w]*(?:copyright\s*(?:\(c\)|©|[0-9]{4}|<|\[)|\(c\)\s|©|all rights reserved[^\w]*$)")
BREAK = re.compile(r"[\W_]+")
MAX_KNOWN = 1_000_000
EMPTY = hashlib.sha256(b"").hexdigest()


def canonical(lines: list[str]) -> str:
    """The canonical form of lower-cased ``lines``."""
    words = BREAK.sub(" ", "\n".join(x for x in lines if not COPYRIGHT.match(x))).split()
    return " ".join([EQUIVALENT.get(w, w) for w in words])


def digest(form: str) -> str:
    return hashlib.sha256(form.encode("utf-8", "surrogatepass")).hexdigest()


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``row`` (a number of the row), ``digest`` of the whole text,
    ``n_words`` of its form, and the distinct digests of its ``lines``."""
    def run(batches: Batches) -> Batches:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out = [[], [], [], []]
            for text in b.column("text").to_pylist():
                lines = (text or "").lower().split("\n")
                whole = canonical(lines)
                row += 1
                forms = {canonical([x]) for x in lines} if len(lines) > 1 else {whole}
                for column, x in zip(out, (row, digest(whole), whole.count(" ") + bool(whole), [digest(f) for f in sorted(forms) if f]), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.list_(pa.string()))], names=["doc_id", "row", "digest", "n_words", "lines"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, row long, digest string, n_words long, lines array<string>"))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license string, text string")


def published_digests(spark: SparkSession) -> DataFrame:
    """``license`` and ``key`` of the stated texts and of the long licences
    whose digests alone are stated."""
    return known_digests(known_licenses(spark)).unionByName(spark.createDataFrame(DIGESTS, "license string, key string"))


def known_digests(known: DataFrame) -> DataFrame:
    """``license`` and ``key``, the digest of each known text."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            keys = [digest(canonical((t or "").lower().split("\n"))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("license"), pa.array(keys, pa.string())], names=["license", "key"])
    return (known.select("license", "text").mapInArrow(run, "license string, key string")
            .where((F.col("key") != EMPTY) & F.col("license").isNotNull()).distinct())


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``digest``, ``license`` (of the whole text) and
    ``notices`` (of whole lines; both comma-joined, null without any) of every
    row."""
    spark = docs.sparkSession
    small_batches(spark)
    table = solid(published_digests(spark) if known is None else known_digests(known), "license-known")
    table = F.broadcast(table) if table.count() <= MAX_KNOWN else table
    rows = solid(digests(docs, id_col, text_col), "license-digests")
    kinds = F.explode(F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("digest").alias("key"))),
                               F.transform("lines", lambda k: F.struct(F.lit(False).alias("whole"), k.alias("key"))))).alias("k")
    names = lambda whole: F.array_join(F.array_sort(F.collect_set(F.when(F.col("whole") == whole, F.col("license")))), ",")
    met = (rows.select("row", kinds).select("row", "k.whole", "k.key").join(table, "key")
           .groupBy("row").agg(names(True).alias("license"), names(False).alias("notices")))
    blank = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    return rows.join(met, "row", "left").select("doc_id", "n_words", "digest", blank("license"), blank("notices"))
