"""Document sources.

A document is ``(title STRING, text STRING)``; rows that share a title are
one document. JSON is read with an explicit schema (no inference pass over
the input, extra fields ignored, a malformed line becomes a null row that
tokenizes to nothing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_SCHEMA = "title string, text string"


def spread_input(scan: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer splits than the cluster has cores.

    For readers only: ``scan`` must be a plain scan, whose splits are known
    without running anything. A large input already arrives in many splits and
    is left alone (a repartition would shuffle raw text for nothing); a single
    unsplittable file (one Parquet row group, one gzip JSON) would otherwise
    tokenize in a single task.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def read_documents_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines documents from one file or a directory."""
    return spread_input(spark.read.schema(DOCUMENT_SCHEMA).json(path))


def read_documents_json_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """JSON-lines documents, and beside them the lines that are no JSON object
    with such fields: ``(file, line)``. Blank lines are neither. Both are lazy
    and parse each line once."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    schema = f"{DOCUMENT_SCHEMA}, bad_line string"
    made = F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_line"})
    parsed = lines.where(F.length(F.btrim("line")) > 0).select("file", "line", made.alias("doc"))
    good = F.col("doc").isNotNull() & F.col("doc.bad_line").isNull()
    return parsed.where(good).select("doc.title", "doc.text"), parsed.where(~good).select("file", "line")


def read_documents_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spread_input(spark.read.parquet(path).select("title", "text"))


def table_documents(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """A table as documents: ``title = CAST(key AS STRING)``."""
    return df.select(F.col(key).cast("string").alias("title"), F.col(text).alias("text"))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """The driver tables as documents: ``documents`` keyed by doc_id,
    ``conversations`` by conv_id (many rows per title), ``pages`` by page_id,
    ``benchmark`` by item_id."""
    keys = {"documents": ("doc_id", "text"), "conversations": ("conv_id", "text"),
            "pages": ("page_id", "html"), "benchmark": ("item_id", "text")}
    key, text = keys[name]
    return spread_input(table_documents(load_table(spark, sf_dir, name), key, text))


def write_documents_json(docs: DataFrame, path: str) -> None:
    """Write ``(title, text)`` rows as JSON lines, one file per partition."""
    docs.select("title", "text").write.mode("errorifexists").json(path)
