"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators.joins import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch: few where they carry texts of any length, many where
#: they are a few numbers. (Spark bounds a batch by rows, not by bytes.)
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS, THIN_ROWS = 128, 10_000


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    old = spark.conf.get(BATCH_CONF, str(THIN_ROWS))
    spark.conf.set(BATCH_CONF, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, old)


def small_batches(spark: SparkSession) -> None:
    """For results that are computed after an operator has returned: the
    session's Arrow batches hold TEXT_ROWS rows at most from now on."""
    if int(spark.conf.get(BATCH_CONF, str(THIN_ROWS))) > TEXT_ROWS:
        spark.conf.set(BATCH_CONF, str(TEXT_ROWS))


def solid(df: DataFrame, name: str, rows: int = TEXT_ROWS) -> DataFrame:
    """``df`` as a written table under ``spark.checkpoint.dir``: cuts lineage,
    survives lost executors, and lets the planner see its true size."""
    with batch_rows(df.sparkSession, rows):
        return materialize(df, name)


def give_back() -> None:
    """Return the memory that a collected sample took to the system, after a
    model has been fitted on the driver."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def blobs(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def crc_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def null_safe(pairs: Iterable[tuple[Column, Column]]) -> Column:
    cond = None
    for a, b in pairs:
        part = a.eqNullSafe(b)
        cond = part if cond is None else cond & part
    return cond


Batches = Iterator[pa.RecordBatch]
