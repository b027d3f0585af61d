"""Index storage: segments of Parquet tables under one root path, and a manifest.

Layout::

    <root>/segment-<id>/postings/term_bucket=B/  (title, term, tf)  inverted order:
                                    range-partitioned and sorted by (bucket, term, tf falling, title)
    <root>/segment-<id>/levels/term_bucket=B/  (term, tf, n)  skip data: each level of a
                                    term's list, the postings of one tf, with its size
    <root>/segment-<id>/forward/    (title, term, tf)  forward order: range-
                                    partitioned and sorted by (title, term)
    <root>/segment-<id>/documents/  (title, n_terms, n_tokens)
    <root>/segment-<id>/lexicon/term_bucket=B/  (term, df, cf, max_tf)
    <root>/manifest/                one row per segment, oldest first, with the
                                    totals of the index; written last

The reference stores a forward and an inverted index as serialized object
files; here both are the same flat relation in two sort orders, so a term
lookup prunes ``term_bucket`` directories and then skips row groups by the
term min/max statistics, and a title lookup does the same on ``forward``.
D and avgdl are stored (the report's planned improvement), so ranking never
recounts the corpus.

Inside a term the postings of the largest tf come first, in pages of
``PAGE_ROWS`` rows whose least and largest tf stand in the file's page index. A
filter ``term = t AND tf >= x`` therefore reads the head of a long list only, and
``levels`` tells, before anything of the list is read, which x leaves enough.

A build writes one segment. An add of any size writes one more, which is a
build of the new part, and leaves the old ones where they are; what it replaces
("new wins") stands in three more tables of its folder::

    overwritten/term_bucket=B/      (title, term, tf, segment): postings of older
                                    segments that no longer count
    documents_gone/, lexicon_gone/, levels_gone/term_bucket=B/    their part of the sizes, negative

The manifest names the segments of an index, so the segments of the index that
was added to stay in use: keep its folder, or :func:`compact_index` the new one.
Segments are merged by size: once the newest ones together have half as many
postings as the one before them, that one and they become one. So each segment
has less than half the postings of the one before it, an index of N postings has
about log2(N) segments at most, and since every rewrite makes a posting's segment
grow by half or more, none is rewritten more than log(N) / log(1.5) times.

Every table is complete when the manifest is written; a root without one (a save
that died) is refused, and a manifest whose tables are gone says which.

Range partitioning uses the composite key, so a hot term (or title) is cut
across several files instead of landing in one task. Every table is read
back from storage before the next one is derived from it: the written table
is the lineage cut, and a lost executor only recomputes from there.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spindle.operators.index import CorpusScalars, Index, document_table, level_table, lexicon_of_levels, term_bucket
from spindle.operators.joins import join_null_safe, materialize
from spindle.session import drop_scratch, shuffle_width


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


# Layout sizing: about 4 M postings per bucket directory (tens of MB of
# Parquet), at most 65,536 directories, about 2 M postings per file (what a task
# sorts without spilling), and at least one file per core so the write runs in
# parallel.
ROWS_PER_BUCKET = 4_000_000
MAX_BUCKETS = 65_536
ROWS_PER_FILE = 2_000_000
# Rows of a Parquet page of the postings, the unit that a scan can skip.
PAGE_ROWS = 4096


def buckets_for(rows: int) -> int:
    return int(min(MAX_BUCKETS, max(1, math.ceil(rows / ROWS_PER_BUCKET))))


def files_for(spark: SparkSession, rows: int) -> int:
    return int(max(spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_FILE)))


def run_concurrently(*jobs) -> None:
    """Run independent write jobs from separate driver threads, so Spark
    can schedule their tasks side by side; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
        for future in futures:
            future.result()


def _range(df: DataFrame, n_files: int | None, *cols: str | Column) -> DataFrame:
    return df.repartitionByRange(n_files, *cols) if n_files else df.repartitionByRange(*cols)


def write_postings(postings: DataFrame, root: str, n_buckets: int,
                   n_files: int | None = None) -> DataFrame:
    """Write the inverted-order postings; return them read back.

    ``n_files`` is the number of range partitions (output files); without
    it ``spark.sql.shuffle.partitions`` applies and AQE may coalesce.
    """
    spark = postings.sparkSession
    keyed = postings.select("title", "term", "tf").withColumn(
        "term_bucket", term_bucket(F.col("term"), n_buckets))
    order = ("term_bucket", "term", F.desc("tf"), "title")
    (_range(keyed, n_files, *order).sortWithinPartitions(*order)
     .write.mode("errorifexists").option("parquet.page.row.count.limit", PAGE_ROWS).partitionBy("term_bucket")
     .parquet(table_path(root, "postings")))
    return spark.read.schema(SCHEMAS["postings"]).parquet(table_path(root, "postings"))


def write_forward(postings: DataFrame, root: str, n_files: int | None = None, ordered: bool = False) -> None:
    """``ordered`` postings are cut and sorted by (title, term) already."""
    if not ordered:
        postings = _range(postings.select("title", "term", "tf"), n_files, "title", "term").sortWithinPartitions("title", "term")
    postings.select("title", "term", "tf").write.mode("errorifexists").parquet(table_path(root, "forward"))


def write_once(index: Index, root: str, forward: bool, n_files: int | None = None) -> tuple[DataFrame, list[str]]:
    """The postings of an index as a stored table, from which the others of a
    segment are made: its forward table, or else a scratch table. Returns it
    read back, and the folders to drop at the end."""
    if index.materialized and not forward:
        return index.flat(), []
    spark = index.postings.sparkSession
    postings = index.to_store()
    if forward:
        write_forward(postings, root, n_files, ordered=index.docs is not None)
        return spark.read.schema(SCHEMAS["forward"]).parquet(table_path(root, "forward")), []
    with shuffle_width(postings):
        stored = materialize(postings, "postings")
    return stored, scratch_of(stored)


def write_documents(postings: DataFrame, root: str) -> DataFrame:
    path = table_path(root, "documents")
    document_table(postings.select("title", "term", "tf")).write.mode("errorifexists").parquet(path)
    return postings.sparkSession.read.schema(SCHEMAS["documents"]).parquet(path)


def write_by_term(table: DataFrame, path: str, n_buckets: int, *then: str) -> None:
    """Range-clustered by (bucket, term, ``then``): each bucket directory gets
    few files, and an oversized bucket is still cut across tasks."""
    keyed = table.withColumn("term_bucket", term_bucket(F.col("term"), n_buckets))
    (keyed.repartitionByRange("term_bucket", "term", *then).sortWithinPartitions("term_bucket", "term", *then)
     .write.mode("errorifexists").partitionBy("term_bucket").parquet(path))


def write_lexicon(postings: DataFrame, root: str, n_buckets: int, suffix: str = "", sign: int = 1) -> None:
    """The levels of the postings, and the lexicon. ``sign`` -1 writes sizes as
    negative numbers."""
    write_levels(level_table(postings).withColumn("n", F.lit(sign) * F.col("n")), root, n_buckets, suffix)


def write_levels(levels: DataFrame, root: str, n_buckets: int, suffix: str = "") -> None:
    """The levels, and from them, read back, one row per term."""
    path = table_path(root, "levels" + suffix)
    write_by_term(levels, path, n_buckets, "tf")
    stored = levels.sparkSession.read.schema(SCHEMAS["levels"]).parquet(path)
    write_by_term(lexicon_of_levels(stored), table_path(root, "lexicon" + suffix), n_buckets)


# ---------------------------------------------------------------------------
# Segments and their manifest
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Segment:
    """``rows`` postings; ``gone`` postings of older segments do not count any
    more, ``shared`` of its titles stand in older segments too."""
    path: str
    rows: int
    gone: int = 0
    shared: int = 0
    forward: bool = True

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]


@dataclass(frozen=True)
class Manifest:
    """The segments of an index, oldest first, and its totals."""
    segments: tuple[Segment, ...]
    n_buckets: int
    d: int
    n_postings: int
    n_tokens: int


MANIFEST = ("ordinal int, path string, n_rows bigint, gone bigint, shared bigint, forward boolean, n_buckets int, "
            "d bigint, n_postings bigint, n_tokens bigint")
SCHEMAS = {
    "postings": "title string, term string, tf bigint, term_bucket int",
    "forward": "title string, term string, tf bigint",
    "documents": "title string, n_terms bigint, n_tokens bigint",
    "lexicon": "term string, df bigint, cf bigint, max_tf bigint, term_bucket int",
    "levels": "term string, tf bigint, n bigint, term_bucket int",
    "overwritten": "title string, term string, tf bigint, segment string, term_bucket int",
    "documents_gone": "title string, n_terms bigint, n_tokens bigint",
    "lexicon_gone": "term string, df bigint, cf bigint, max_tf bigint, term_bucket int",
    "levels_gone": "term string, tf bigint, n bigint, term_bucket int",
}


def write_manifest(spark: SparkSession, root: str, m: Manifest) -> None:
    rows = [(i, s.path, s.rows, s.gone, s.shared, s.forward, m.n_buckets, m.d, m.n_postings, m.n_tokens) for i, s in enumerate(m.segments)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(table_path(root, "manifest"))


def manifest_table(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(table_path(root, "manifest"))
    except AnalysisException as missing:
        raise FileNotFoundError(f"no complete index at {root}: it has no manifest, which a save writes last") from missing


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    rows = sorted(manifest_table(spark, root).collect(), key=lambda r: r.ordinal)
    if not rows:
        raise FileNotFoundError(f"no complete index at {root}: its manifest is empty")
    segments = tuple(Segment(r.path, r.n_rows, r.gone, r.shared, r.forward) for r in rows)
    return Manifest(segments, rows[0].n_buckets, rows[0].d, rows[0].n_postings, rows[0].n_tokens)


def segment_table(spark: SparkSession, segment: Segment, name: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMAS[name]).parquet(table_path(segment.path, name))
    except AnalysisException as missing:
        raise FileNotFoundError(f"incomplete index: {segment.path} has no table {name}") from missing


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def live_rows(spark: SparkSession, segments: tuple[Segment, ...], name: str, fresh: DataFrame | None = None) -> list[DataFrame]:
    """``name`` (postings or forward) of each segment without the rows that
    later segments overwrite. The planner picks the anti join's strategy by the
    size of the overwritten rows; without any there is no join. ``fresh`` are the
    postings of the last segment where it has no table of them yet."""
    made = []
    for i, segment in enumerate(segments):
        rows = fresh if fresh is not None and i == len(segments) - 1 else segment_table(spark, segment, name)
        gone = [segment_table(spark, s, "overwritten").where(F.col("segment") == segment.name) for s in segments[i + 1:] if s.gone]
        if gone:
            key = ["term_bucket", "title", "term"] if name == "postings" else ["title", "term"]
            rows = join_null_safe(rows, _union(gone).select(*key), key, "left_anti")
        made.append(rows)
    return made


def sizes(spark: SparkSession, segments: tuple[Segment, ...], name: str) -> list[DataFrame]:
    """``name`` (documents, lexicon or levels) of each segment and, negative, what its
    overwritten rows had."""
    return ([segment_table(spark, s, name) for s in segments]
            + [segment_table(spark, s, f"{name}_gone") for s in segments if s.gone])


def open_segments(spark: SparkSession, m: Manifest, stats: DataFrame) -> Index:
    documents = _union(sizes(spark, m.segments, "documents"))
    if any(s.shared for s in m.segments):
        documents = documents.groupBy("title").agg(F.sum("n_terms").alias("n_terms"), F.sum("n_tokens").alias("n_tokens"))
    parts = sizes(spark, m.segments, "lexicon")
    lexicon = together = _union(parts)
    if len(parts) > 1:
        # max_tf may be that of a posting that is gone: still an upper bound.
        lexicon = (lexicon.groupBy("term_bucket", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.max("max_tf").alias("max_tf"))
                   .select("term", "df", "cf", "max_tf", "term_bucket"))
    complete = all(s.forward for s in m.segments)
    return Index(
        postings=_union(live_rows(spark, m.segments, "postings")),
        documents_df=documents,
        lexicon_df=lexicon,
        lexicon_parts=together,
        level_parts=_union(sizes(spark, m.segments, "levels")),
        stats_df=stats,
        n_buckets=m.n_buckets,
        forward_df=_union(live_rows(spark, m.segments, "forward")) if complete else None,
        known_scalars=CorpusScalars(m.d, m.n_postings / m.d if m.d else None, m.n_tokens / m.d if m.d else None),
    )


def load_index(spark: SparkSession, root: str) -> Index:
    """Open a stored index (lazy apart from reading its manifest)."""
    stats = manifest_table(spark, root).where("ordinal = 0").select(
        "d", "n_postings", "n_tokens", F.try_divide(F.col("n_postings").cast("double"), F.col("d")).alias("avgdl"),
        F.try_divide(F.col("n_tokens").cast("double"), F.col("d")).alias("avg_tokens"))
    return open_segments(spark, read_manifest(spark, root), stats)


def scratch_of(table: DataFrame) -> list[str]:
    """The folder of a materialised table, which its job can drop at its end."""
    return sorted({f.rpartition("/")[0] for f in table.inputFiles()})


def new_segment_path(root: str) -> str:
    return f"{root.rstrip('/')}/segment-{uuid.uuid4().hex[:12]}"


def write_segment(postings: DataFrame, path: str, n_buckets: int, n_files: int | None, forward: bool, then=None, titled: bool = True):
    """The tables of one segment from its postings; the tables after the inverted
    order are written side by side. ``titled``: the postings are a stored table
    that has the rows of a title together, from which the documents are summed up
    without a row for each posting. ``then`` is called with the stored postings
    and documents as soon as both are there, beside the others."""
    stored = write_postings(postings, path, n_buckets, n_files)
    found = []

    def documents() -> None:
        docs = write_documents(postings if titled else stored, path)
        # An aggregate first: a hot term collapses map-side.
        found.append(docs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first())
        found.append(then(stored, docs) if then else None)

    run_concurrently(documents, lambda: write_lexicon(stored, path, n_buckets))
    (d, rows, tokens), extra = found
    return Segment(path, int(rows), forward=forward), int(d), int(tokens), extra


def save_index(index: Index, root: str, n_buckets: int | None = None,
               forward: bool = True, n_files: int | None = None) -> Index:
    """Write the index under ``root`` (which must hold no index) as one segment
    and return it loaded back from storage.

    The postings are written once in title order (a lineage cut after the
    tokenize + aggregate stage), as the forward table if there is to be one;
    everything else is made from that table, and its row count, read from the
    Parquet footers, sizes the bucket directories and files.
    """
    spark = index.postings.sparkSession
    path = new_segment_path(root)
    n_buckets = n_buckets or index.n_buckets
    postings, scratch = write_once(index, path, forward, n_files)
    rows = postings.count()
    n_buckets = n_buckets or buckets_for(rows)
    segment, d, tokens, _ = write_segment(postings, path, n_buckets, n_files or files_for(spark, rows), forward)
    write_manifest(spark, root, Manifest((segment,), n_buckets, d, segment.rows, tokens))
    drop_scratch(spark, *scratch)
    return load_index(spark, root)


def write_overwritten(spark: SparkSession, old: Manifest, stored: DataFrame, docs: DataFrame, path: str, with_sizes: bool = True) -> tuple[int, int, int]:
    """What the new postings ``stored`` replace in the segments of ``old``, as
    tables of the new segment: (titles in both, postings gone, their tokens).

    Only titles that both sides have can hold such postings, so the old ones
    are reduced to these titles first; the planner picks both joins by the
    sizes it meets. Titles that are all new leave the old postings unread.
    """
    known = _union([segment_table(spark, s, "documents").select("title") for s in old.segments])
    shared = materialize(join_null_safe(docs.select("title"), known, ["title"], "left_semi"), "shared-titles")
    n_shared, gone, tokens = shared.count(), 0, 0
    if n_shared:
        keys = stored.select("term_bucket", "title", "term")
        rows = [join_null_safe(join_null_safe(r, shared, ["title"], "left_semi"), keys, ["term_bucket", "title", "term"], "left_semi")
                .select("title", "term", "tf", F.lit(s.name).alias("segment"), "term_bucket")
                for s, r in zip(old.segments, live_rows(spark, old.segments, "postings"), strict=True)]
        lost = materialize(_union(rows), "overwritten")
        gone, tokens = write_gone(lost, path, old.n_buckets, with_sizes)
        drop_scratch(spark, *scratch_of(lost))
    drop_scratch(spark, *scratch_of(shared))
    return n_shared, gone, tokens


def write_gone(lost: DataFrame, path: str, n_buckets: int, with_sizes: bool = True) -> tuple[int, int]:
    """The overwritten postings of a segment and (``with_sizes``) their sizes as
    negative numbers; nothing if there are none. Returns their number and tokens."""
    gone, tokens = lost.agg(F.count(F.lit(1)), F.coalesce(F.sum("tf"), F.lit(0))).first()
    if not gone:
        return 0, 0

    (lost.repartitionByRange("term_bucket", "term", "title").sortWithinPartitions("term_bucket", "term", "title")
     .write.mode("errorifexists").partitionBy("term_bucket").parquet(table_path(path, "overwritten")))
    if not with_sizes:
        return int(gone), int(tokens)
    (document_table(lost).withColumns({n: -F.col(n) for n in ("n_terms", "n_tokens")}).write.mode("errorifexists").parquet(table_path(path, "documents_gone")))
    write_lexicon(lost, path, n_buckets, "_gone", -1)
    return int(gone), int(tokens)


def add_segment(spark: SparkSession, old_root: str, new: Index, root: str, forward: bool = True,
                n_files: int | None = None, whole: bool = False) -> Index:
    """Write ``merge(old, new)`` at ``root``: the segments of the index at
    ``old_root``, and one of the postings of ``new``. The old postings are neither
    rewritten nor shuffled; they are read only where titles of both sides meet.
    Where the newer segments are as large as an older one, or for the ``whole``
    index, these and the new postings become one segment at once: the new ones get
    no tables of their own that a merge would only read again."""
    old = read_manifest(spark, old_root)
    path = new_segment_path(root)
    postings, scratch = write_once(new, path, forward, n_files)
    rows = postings.count()
    at = 0 if whole else first_to_merge([*(s.rows for s in old.segments), rows])
    if at == len(old.segments):
        segment, d, tokens, (shared, gone, gone_tokens) = write_segment(
            postings, path, old.n_buckets, n_files or files_for(spark, rows), forward, lambda stored, docs: write_overwritten(spark, old, stored, docs, path))
    else:
        docs = write_documents(postings, path)
        d, tokens = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
        keyed = postings.withColumn("term_bucket", term_bucket(F.col("term"), old.n_buckets))
        shared, gone, gone_tokens = write_overwritten(spark, old, keyed, docs, path, with_sizes=False)
    m = Manifest((*old.segments, Segment(path, rows, gone, shared, forward)), old.n_buckets, old.d + int(d) - shared, old.n_postings + rows - gone,
                 old.n_tokens + int(tokens) - gone_tokens)
    if at < len(old.segments):
        m = merged(spark, m, at, root, forward, n_files if whole else None, postings)
        drop_scratch(spark, path)
    drop_scratch(spark, *scratch)
    write_manifest(spark, root, m)
    return load_index(spark, root)


def first_to_merge(rows: list[int]) -> int:
    """Position from which the segments become one: an older segment is taken
    in while the newer ones together have at least half as many rows."""
    at, total = len(rows) - 1, rows[-1]
    while at > 0 and rows[at - 1] <= 2 * total:
        at -= 1
        total += rows[at]
    return at


def merged(spark: SparkSession, m: Manifest, at: int, root: str, forward: bool, n_files: int | None = None,
           fresh: DataFrame | None = None) -> Manifest:
    """``m`` with its segments from position ``at`` on as one. ``fresh`` are the
    postings of the last one if it has none stored: of its tables only its
    documents and what it overwrites are there then.

    The postings are put into order once; documents and levels are summed up from
    those of the segments, less what these overwrite in each other, so no postings
    but the fresh ones are counted again.
    """
    inside, before = m.segments[at:], m.segments[:at]
    path = new_segment_path(root)
    n_files = n_files or files_for(spark, sum(s.rows for s in inside))
    complete = all(s.forward for s in inside)
    forward = forward and (complete or not before)
    rows = _union([r.select("title", "term", "tf") for r in live_rows(spark, inside, "forward" if forward and complete else "postings", fresh)])
    replacing = [segment_table(spark, s, "overwritten") for s in inside if s.gone]
    lost = _union(replacing).where(F.col("segment").isin([s.name for s in inside])) if replacing else None
    found = []

    def postings() -> None:
        ordered = rows
        if forward:
            write_forward(rows, path, n_files)
            ordered = spark.read.schema(SCHEMAS["forward"]).parquet(table_path(path, "forward"))
        write_postings(ordered, path, m.n_buckets, n_files)

    def documents() -> None:
        docs = _union([segment_table(spark, s, "documents") for s in inside])
        if any(s.shared for s in inside):
            if lost is not None:
                docs = docs.unionByName(document_table(lost).withColumns({n: -F.col(n) for n in ("n_terms", "n_tokens")}))
            docs = docs.groupBy("title").agg(F.sum("n_terms").alias("n_terms"), F.sum("n_tokens").alias("n_tokens"))
        docs.write.mode("errorifexists").parquet(table_path(path, "documents"))
        stored = spark.read.schema(SCHEMAS["documents"]).parquet(table_path(path, "documents"))
        found.append(stored.agg(F.coalesce(F.sum("n_terms"), F.lit(0))).first()[0])

    def levels() -> None:
        parts = [segment_table(spark, s, "levels").select("term", "tf", "n") for s in (inside if fresh is None else inside[:-1])]
        if fresh is not None:
            parts.append(fresh.select("term", "tf", F.lit(1).cast("bigint").alias("n")))
        if lost is not None:
            parts.append(lost.select("term", "tf", F.lit(-1).cast("bigint").alias("n")))
        write_levels(_union(parts).groupBy("term", "tf").agg(F.sum("n").alias("n")).where("n > 0"), path, m.n_buckets)

    run_concurrently(postings, documents, levels)
    gone, shared = 0, 0
    if before and replacing:
        # Postings of the segments inside are gone for good, those before them stay listed.
        gone, _ = write_gone(_union(replacing).where(F.col("segment").isin([s.name for s in before])), path, m.n_buckets)
    if before:
        shared = sum(s.shared for s in inside)          # an upper bound: only whether there are any matters
    return Manifest((*before, Segment(path, int(found[0]), gone, shared, forward)), m.n_buckets, m.d, m.n_postings, m.n_tokens)


def compact_index(spark: SparkSession, root: str, out_root: str,
                  n_files: int | None = None) -> Index:
    """Rewrite a stored index as one segment in one global order: it then
    needs no folder but its own."""
    m = read_manifest(spark, root)
    write_manifest(spark, out_root, merged(spark, m, 0, out_root, all(s.forward for s in m.segments), n_files or files_for(spark, m.n_postings)))
    return load_index(spark, out_root)
