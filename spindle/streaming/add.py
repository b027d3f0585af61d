"""Streaming index add: Structured Streaming ``foreachBatch`` that merges
micro-batches of documents into the stored index, with a refresh interval.

The index state lives in Parquet, not in the stream's state store, under
one root:

* ``_pending/``  the postings of each micro-batch, tagged with a sequence
  number (an O(batch) append);
* ``v<seq>-*/``  index versions;
* ``_log/gen=<version>/``  one row per pending batch or version:
  ``(seq, kind, run, epoch, path, rows)``. A version starts a generation, and
  only the newest is read; the version's row keeps the last epoch it holds.

Each micro-batch only appends its postings to ``_pending`` and logs them.
When the pending rows since the last version reach ``refresh_rows`` (by
default REFRESH_ROWS; 0 means every batch),
or on :meth:`IndexAppender.flush`, the pending postings are
resolved with "latest sequence wins per (title, term)". Rows of one title
inside one batch add up first (one build). The result is merged into the
last version like a batch add (new wins, old-only terms stay), giving the
same index as applying the batches one by one. The log append is the
commit point. A replayed ``(run, epoch)`` is skipped; a new stream on the
same root, whose epochs restart at 0, keeps adding; a flush that dies
before its log row leaves an unreferenced folder and is simply redone.
One stream writes to a root at a time.

Pending batches are visible at once: :meth:`IndexAppender.current` merges them
into the last version when it is read, so ``refresh_rows`` trades the work of a
read for write volume, not freshness.

Cost per micro-batch is O(batch). A flush writes the pending part as one more
segment of the index and leaves the others where they are; segments of like size
are merged, so a posting is rewritten a number of times that grows with the
logarithm of index / flush only.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spindle.operators.index import Index, merge_index, postings_by_title
from spindle.plans.jobs import merge_into
from spindle.session import scratch_path
from spindle.sources.documents import DOCUMENT_SCHEMA
from spindle.sources.store import load_index, read_manifest, save_index

LOG = "_log"
REFRESH_ROWS = 4_000_000
LOG_SCHEMA = "seq bigint, kind string, run string, epoch bigint, path string, rows bigint"


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    """The log since the last version: its newest generation."""
    try:
        log = spark.read.schema(f"{LOG_SCHEMA}, gen bigint").parquet(f"{root}/{LOG}")
    except AnalysisException:
        return None
    newest = log.agg(F.max("gen")).first()[0]
    return log.where(F.col("gen") == newest).drop("gen")


def _append_log(spark: SparkSession, root: str, row: tuple, gen: int) -> None:
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{LOG}/gen={gen}")


def latest_version(spark: SparkSession, root: str):
    """The newest version row of the log, or None."""
    log = _log(spark, root)
    if log is None:
        return None
    return log.where(F.col("kind") == "version").orderBy(F.desc("seq")).first()


class IndexAppender:
    """``foreachBatch`` sink that keeps a versioned index under ``root``.

    ``run`` names the stream (its checkpoint location); ``base`` optionally
    names a stored index to start from.
    """

    def __init__(self, root: str, run: str, base: str | None = None,
                 n_buckets: int | None = None, forward: bool | None = None,
                 refresh_rows: int = REFRESH_ROWS):
        self.root = root.rstrip("/")
        self.run = run
        self.base = base
        self.n_buckets = n_buckets
        self.forward = forward
        self.refresh_rows = refresh_rows

    def _next_seq(self, log: DataFrame | None) -> int:
        if log is None:
            return 1
        top = log.agg(F.max("seq")).first()[0]
        return (top or 0) + 1

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        log = _log(spark, self.root)
        if log is not None and log.where(
                (F.col("run") == self.run) & (F.col("epoch") >= epoch_id)).limit(1).count():
            return  # replayed batch, already logged
        seq = self._next_seq(log)
        path = f"{self.root}/_pending/p{seq:08d}-{uuid.uuid4().hex[:8]}"
        (postings_by_title(batch).withColumn("seq", F.lit(seq).cast("bigint"))
         .write.parquet(path))
        rows = spark.read.parquet(path).count()
        last = latest_version(spark, self.root)
        _append_log(spark, self.root, (seq, "pending", self.run, epoch_id, path, rows), last.seq if last is not None else 0)
        if self._pending_rows(spark) >= self.refresh_rows:
            self.flush(spark)

    def _pending(self, spark: SparkSession) -> list:
        """Pending log rows since the last version (bounded by the refresh
        policy: it is the list of batches between two flushes)."""
        log = _log(spark, self.root)
        if log is None:
            return []
        last = latest_version(spark, self.root)
        after = last.seq if last is not None else 0
        return log.where((F.col("kind") == "pending") & (F.col("seq") > after)).collect()

    def _pending_rows(self, spark: SparkSession) -> int:
        return sum(r.rows for r in self._pending(spark))

    def flush(self, spark: SparkSession) -> None:
        """Merge every pending batch into a new index version."""
        pending = self._pending(spark)
        if not pending:
            return
        resolved = self._resolved(spark, pending)
        last = latest_version(spark, self.root)
        old_path = last.path if last is not None else self.base
        seq = self._next_seq(_log(spark, self.root))
        path = f"{self.root}/v{seq:08d}-{uuid.uuid4().hex[:8]}"
        if old_path is None:
            save_index(resolved, path, self.n_buckets, bool(self.forward))
        else:
            # The forward copy of the base is kept unless the caller says otherwise.
            kept = all(s.forward for s in read_manifest(spark, old_path).segments)
            merge_into(spark, old_path, resolved, path, kept if self.forward is None else self.forward)
        epochs = [r.epoch for r in pending if r.run == self.run]
        _append_log(spark, self.root, (seq, "version", self.run, max(epochs) if epochs else None, path, None), seq)

    @staticmethod
    def _resolved(spark: SparkSession, pending: list) -> Index:
        """One batch is a stored index as it is; of several the latest wins."""
        tagged = spark.read.parquet(*[r.path for r in pending])
        if len(pending) == 1:
            return Index(tagged.drop("seq"), materialized=True)
        return Index(tagged.groupBy("title", "term").agg(F.max_by("tf", "seq").alias("tf")))

    def current(self, spark: SparkSession) -> Index:
        """The newest version with every logged batch: those after it are merged
        in lazily."""
        last = latest_version(spark, self.root)
        path = last.path if last is not None else self.base
        pending = self._pending(spark)
        if not pending:
            if path is None:
                raise ValueError(f"no committed index version under {self.root}")
            return load_index(spark, path)
        new = self._resolved(spark, pending)
        return new if path is None else merge_index(load_index(spark, path), new)


def stream_documents(spark: SparkSession, source: str, fmt: str = "parquet",
                     files_per_trigger: int = 1) -> DataFrame:
    """A stream of ``(title, text)`` documents from files dropped in ``source``."""
    return (spark.readStream.schema(DOCUMENT_SCHEMA).format(fmt)
            .option("maxFilesPerTrigger", files_per_trigger).load(source))


def run_streaming_add(spark: SparkSession, source: str, root: str, checkpoint: str,
                      fmt: str = "parquet", files_per_trigger: int = 1,
                      base: str | None = None, refresh_rows: int = REFRESH_ROWS) -> Index:
    """Drain everything currently in ``source`` into the index at ``root``,
    then flush what is still pending."""
    appender = IndexAppender(root, run=checkpoint, base=base, refresh_rows=refresh_rows)
    query = (stream_documents(spark, source, fmt, files_per_trigger).writeStream
             .foreachBatch(appender)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    appender.flush(spark)
    return appender.current(spark)


def streaming_build(spark: SparkSession, docs: DataFrame, batches: int = 4,
                    refresh_rows: int = REFRESH_ROWS) -> Index:
    """Write ``docs`` as Parquet files and index them as a stream of about
    ``batches`` micro-batches (files per trigger follows the file count, so
    a large input does not turn into thousands of micro-batches)."""
    source = scratch_path(spark, "stream-src")
    docs.select("title", "text").write.parquet(source)
    n_files = len(spark.read.parquet(source).inputFiles())
    per_trigger = max(1, math.ceil(n_files / max(1, batches)))
    return run_streaming_add(spark, source, scratch_path(spark, "stream-index"),
                             scratch_path(spark, "stream-ckpt"), files_per_trigger=per_trigger,
                             refresh_rows=refresh_rows)
