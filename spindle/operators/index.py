"""The index: a flat postings table and the views derived from it.

The canonical physical model is one row per (document, term)::

    postings(title STRING, term STRING, tf BIGINT)      unique on (title, term)

The reference keeps two nested structures instead (doc -> {term: tf} and
term -> {doc}). Both are projections of the flat table, so we keep the flat
table (columnar, splittable, pushdown-friendly, mergeable) and derive:

* ``documents``  (title, n_terms, n_tokens): one row per indexed document
* ``lexicon``    (term, df, cf): one row per term, df = documents holding it
* ``stats``      one row (d, n_postings, n_tokens, avgdl, avg_tokens)
* nested forward / inverted lists, cut into blocks of bounded size

Every derived view is a partial+final aggregate, so a hot title or a hot
term (say, a third of all rows) is pre-aggregated map-side and never lands
whole in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.text import explode_terms
from spindle.operators.joins import broadcast_if_small, join_null_safe, materialize

POSTINGS_COLUMNS = ("title", "term", "tf")
# Target number of members per nested block (forward or inverted list).
DEFAULT_BLOCK_SIZE = 4096


def term_frequency(docs: DataFrame, key: str = "title", text: str = "text") -> DataFrame:
    """Postings ``(title, term, tf)`` from a document table.

    Rows that share a title are one document: their counts add up. The
    aggregate is partial+final (map-side combine), and the shuffle key is
    the pair (title, term), so neither a hot title nor a hot term lands
    in one task. Nothing runs here: readers spread inputs of few splits.
    """
    docs = docs.select(F.col(key).cast("string").alias("title"), F.col(text).alias("text"))
    terms = explode_terms(docs, "title", "text")
    return terms.groupBy("title", "term").agg(F.count(F.lit(1)).alias("tf"))


# Text bytes of a range of titles that one task turns into postings.
TEXT_PER_TASK = 24 << 20


def postings_by_title(docs: DataFrame, key: str = "title", text: str = "text", text_per_task: int = TEXT_PER_TASK) -> DataFrame:
    """:func:`term_frequency` for a job that stores its result: the texts, a
    fraction of their postings' size, are range-partitioned by title, and each
    task counts its own documents, so the postings are not shuffled.

    A first pass sums up the text of each title. Titles with more than a task's
    share (at most ``total / text_per_task`` of them) are counted by (title, term)
    instead, so none lands whole in one task. Each of the two parts is sorted by
    (title, term) and cut in that order.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("string").alias("title"), F.col(text).alias("text"))
    of_title = docs.groupBy("title").agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("size"))
    large = F.col("size") > text_per_task
    total, hot = of_title.agg(F.sum("size"), F.collect_list(F.when(large, F.struct("title", "size")))).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-(total or 0) // text_per_task))

    def counted(rows: DataFrame) -> DataFrame:
        return explode_terms(rows).groupBy("title", "term").agg(F.count(F.lit(1)).alias("tf"))

    if not hot:
        return counted(docs.repartitionByRange(tasks, "title")).sortWithinPartitions("title", "term")
    titles = spark.createDataFrame([(h.title,) for h in hot], "title string")
    shares = max(spark.sparkContext.defaultParallelism, -(-sum(h.size for h in hot) // text_per_task))
    few = F.broadcast(titles)
    cold = join_null_safe(docs, few, ["title"], "left_anti").repartitionByRange(tasks, "title")
    spread = counted(join_null_safe(docs, few, ["title"], "left_semi")).repartitionByRange(shares, "title", "term")
    return (counted(cold).sortWithinPartitions("title", "term")
            .unionByName(spread.sortWithinPartitions("title", "term")))


def document_table(postings: DataFrame) -> DataFrame:
    """Forward-index summary: ``(title, n_terms, n_tokens)`` per document."""
    return postings.groupBy("title").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.sum("tf").cast("bigint").alias("n_tokens"))


def lexicon_table(postings: DataFrame) -> DataFrame:
    """Inverted-index summary: ``(term, df, cf, max_tf)`` per term.

    Postings are unique per (title, term), so df is a plain count.
    """
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").cast("bigint").alias("cf"),
        F.max("tf").cast("bigint").alias("max_tf"))


def level_table(postings: DataFrame) -> DataFrame:
    """``(term, tf, n)``: how many postings of a term have one tf."""
    return postings.groupBy("term", "tf").agg(F.count(F.lit(1)).alias("n"))


def lexicon_of_levels(levels: DataFrame) -> DataFrame:
    """The lexicon from the levels of its terms."""
    return levels.groupBy("term").agg(
        F.sum("n").alias("df"),
        F.sum(F.col("tf") * F.col("n")).cast("bigint").alias("cf"),
        F.max("tf").cast("bigint").alias("max_tf"))


def corpus_stats(documents: DataFrame) -> DataFrame:
    """One row: D, number of postings and tokens, avgdl and mean tokens.

    avgdl is the mean number of *distinct* terms per document (the
    reference's definition); it is NULL for an empty index.
    """
    agg = documents.agg(
        F.count(F.lit(1)).alias("d"),
        F.coalesce(F.sum("n_terms"), F.lit(0)).cast("bigint").alias("n_postings"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("bigint").alias("n_tokens"))
    return agg.select(
        "d", "n_postings", "n_tokens",
        F.try_divide(F.col("n_postings").cast("double"), F.col("d")).alias("avgdl"),
        F.try_divide(F.col("n_tokens").cast("double"), F.col("d")).alias("avg_tokens"))


@dataclass(frozen=True)
class CorpusScalars:
    """D, avgdl and mean tokens: as values, or as the one-row table ``stats``
    that a plan reads when it runs."""

    d: int | None = None
    avgdl: float | None = None
    avg_tokens: float | None = None
    stats: DataFrame | None = None

    def lit(self, name: str) -> Column:
        if self.stats is not None:
            return self.stats.select(name).scalar()
        value = getattr(self, name)
        kind = "bigint" if name == "d" else "double"
        return F.lit(value).cast(kind)


def scalars_of(stats: DataFrame) -> CorpusScalars:
    """Read the one-row statistics table into literals."""
    row = stats.select("d", "avgdl", "avg_tokens").first()
    if row is None:
        return CorpusScalars(0, None, None)
    return CorpusScalars(int(row.d), row.avgdl, row.avg_tokens)


@dataclass(frozen=True)
class Index:
    """A postings table plus (optionally stored) derived tables.

    Any derived table left as None is computed lazily from the postings.
    ``n_buckets`` is set for an index loaded from storage: the postings
    then carry a ``term_bucket`` directory column used for pruning.
    """

    postings: DataFrame
    documents_df: DataFrame | None = None
    lexicon_df: DataFrame | None = None
    stats_df: DataFrame | None = None
    n_buckets: int | None = None
    forward_df: DataFrame | None = None
    materialized: bool = False
    known_scalars: "CorpusScalars | None" = None
    lexicon_parts: DataFrame | None = None      # summed up by term they are lexicon_df
    level_parts: DataFrame | None = None        # (term, tf, n) of a stored index, to be summed up
    docs: DataFrame | None = None               # (title, text) of a lazy index

    def flat(self) -> DataFrame:
        return self.postings.select(*POSTINGS_COLUMNS)

    def forward(self) -> DataFrame:
        """Postings in forward (title-clustered) storage order when stored."""
        src = self.forward_df if self.forward_df is not None else self.postings
        return src.select(*POSTINGS_COLUMNS)

    def to_store(self) -> DataFrame:
        """The postings as a plan for a job that writes them: from the documents
        of a lazy index, from the forward order of a stored one."""
        return postings_by_title(self.docs) if self.docs is not None else self.forward()

    def documents(self) -> DataFrame:
        if self.documents_df is not None:
            return self.documents_df.select("title", "n_terms", "n_tokens")
        return document_table(self.flat())

    def lexicon(self) -> DataFrame:
        if self.lexicon_df is not None:
            return self.lexicon_df.select("term", "df", "cf")
        return lexicon_table(self.flat()).select("term", "df", "cf")

    def stats(self) -> DataFrame:
        return self.stats_df if self.stats_df is not None else corpus_stats(self.documents())

    def scalars(self) -> "CorpusScalars":
        """D, avgdl and mean tokens per document.

        An index loaded from storage knows them as literals, which lets
        Catalyst fold the BM25 normaliser into a constant; any other index
        gives scalar subqueries of its statistics, so building a plan runs
        nothing.
        """
        if self.known_scalars is not None:
            return self.known_scalars
        return CorpusScalars(stats=self.stats())

    def postings_for_terms(self, terms: list[str], floors: dict[str, int] | None = None) -> DataFrame:
        """Postings of the given terms, with the predicate on the scan;
        ``floors`` leaves out a term's postings of a smaller tf.

        ``term IN (...)`` is pushed into the Parquet reader (row groups of the
        term-sorted files are skipped by min/max); a stored index also
        prunes whole ``term_bucket`` directories.
        """
        rows = _filter_terms(self.postings, terms, self.n_buckets)
        if floors:
            free = sorted(set(terms) - set(floors))
            heads = [(F.col("term") == t) & (F.col("tf") >= x) for t, x in sorted(floors.items())]
            rows = rows.where(reduce(or_, [F.col("term").isin(free)] * bool(free) + heads))
        return rows.select(*POSTINGS_COLUMNS)

    def levels_for_terms(self, terms: list[str]) -> DataFrame:
        """``(term, tf, n)`` of a stored index for the given terms."""
        parts = _filter_terms(self.level_parts, terms, self.n_buckets)
        return parts.groupBy("term", "tf").agg(F.sum("n").alias("n")).where("n > 0")

    def lexicon_for_terms(self, terms: list[str]) -> DataFrame:
        if self.lexicon_df is not None:
            return _filter_terms(self.lexicon_df, terms, self.n_buckets).select("term", "df", "cf")
        return lexicon_table(self.postings_for_terms(terms)).select("term", "df", "cf")

    def register_views(self, prefix: str = "") -> None:
        """Expose the index to ``spark.sql`` as temp views ``<prefix>postings``,
        ``<prefix>documents``, ``<prefix>lexicon`` and ``<prefix>stats``."""
        self.flat().createOrReplaceTempView(f"{prefix}postings")
        self.documents().createOrReplaceTempView(f"{prefix}documents")
        self.lexicon().createOrReplaceTempView(f"{prefix}lexicon")
        self.stats().createOrReplaceTempView(f"{prefix}stats")

    def solid(self, derived: DataFrame, name: str) -> DataFrame:
        """A derived table without an aggregate beneath it: as it is where it is
        stored, written once otherwise."""
        return derived if self.n_buckets and self.lexicon_parts is self.lexicon_df else materialize(derived, name)

    @property
    def is_lazy(self) -> bool:
        """True when the postings are still a plan over the raw documents."""
        return self.n_buckets is None and not self.materialized


def term_bucket(term: Column, n_buckets: int) -> Column:
    """Directory bucket of a term in a stored index."""
    return F.pmod(F.xxhash64(term), F.lit(n_buckets)).cast("int")


def _filter_terms(df: DataFrame, terms: list[str], n_buckets: int | None) -> DataFrame:
    terms = sorted(set(terms))
    cond = F.col("term").isin(terms) if terms else F.lit(False)
    if n_buckets and terms:
        # Constant-folded to literals by Catalyst, then used for partition pruning.
        buckets = [term_bucket(F.lit(t), n_buckets) for t in terms]
        cond = F.col("term_bucket").isin(buckets) & cond
    return df.where(cond)


def build_index(docs: DataFrame, key: str = "title", text: str = "text") -> Index:
    """Lazy index over a document table (nothing runs until an action)."""
    return Index(term_frequency(docs, key, text), docs=docs.select(F.col(key).cast("string").alias("title"), F.col(text).alias("text")))


def materialize_index(index: Index) -> Index:
    """Write the postings of a lazy index once (Parquet under the shared
    checkpoint folder), so the several passes of a ranking job read them
    instead of re-tokenizing the documents each time."""
    if not index.is_lazy:
        return index
    return Index(materialize(index.to_store(), "postings"), materialized=True)


# ---------------------------------------------------------------------------
# Merge ("add"): new postings replace old ones for the same (title, term);
# terms only in the old version of a document survive; titles are unioned.
# ---------------------------------------------------------------------------

def merge_postings(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` wins on (title, term); everything else of ``old`` is kept.

    Expressed as an anti join plus a union instead of a re-aggregation: the
    old side is streamed, and when the new side is small the planner (or the
    size-checked caller) broadcasts its keys so the old index is not
    shuffled at all. A null title is a title like any other.
    """
    old = old.select(*POSTINGS_COLUMNS)
    new = new.select(*POSTINGS_COLUMNS)
    kept = join_null_safe(old, new.select("title", "term"), ["title", "term"], "left_anti")
    return kept.unionByName(new)


def merge_index(old: Index, new: Index) -> Index:
    """Merged index (lazy); derived tables are recomputed from the result."""
    return Index(merge_postings(old.flat(), new.flat()))


# ---------------------------------------------------------------------------
# Nested views, cut into bounded blocks.
#
# The reference holds a whole posting list (term -> all titles) or a whole
# document vector (title -> all terms) as one value. For a hot term that is
# a third of the corpus in one task, so here a list is cut into
# ceil(size / block_size) blocks by a stable hash of the member; a block is
# then an ordinary bounded group. The hash is the first 60 bits of MD5,
# which any engine can reproduce, so a block is a deterministic function of
# the data.
# ---------------------------------------------------------------------------

def stable_hash(c: Column) -> Column:
    """First 15 hex digits of MD5 as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")


def block_count(size: Column, block_size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / F.lit(float(block_size)))).cast("bigint")


def inverted_blocks(index: Index, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(term, block, df, n, titles)``: each row holds at most about
    ``block_size`` titles of one term's posting list, sorted.

    The term sizes are materialised, so the join's only aggregate is the block
    aggregate behind an exchange of its own: the join of a hot term can be
    split, and its blocks are spread over tasks.
    """
    index = materialize_index(index)
    lex = index.solid(index.lexicon().select("term", "df"), "lexicon")
    sized = index.flat().join(lex, "term")
    keyed = sized.withColumn(
        "block", F.pmod(stable_hash(F.coalesce("title", F.lit(""))), block_count(F.col("df"), block_size)))
    return keyed.repartition("term", "block", "df").groupBy("term", "block", "df").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("title"))).alias("titles")).withColumn(
        "titles", F.transform("titles", lambda t: t["title"]))


def forward_blocks(index: Index, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(title, block, n_terms, n, vec)``: each row holds at most about
    ``block_size`` (term, tf) entries of one document vector, sorted by term.
    Spread like :func:`inverted_blocks`."""
    index = materialize_index(index)
    docs = index.solid(index.documents().select("title", "n_terms"), "documents")
    sized = join_null_safe(index.flat(), docs, ["title"])
    keyed = sized.withColumn(
        "block", F.pmod(stable_hash(F.col("term")), block_count(F.col("n_terms"), block_size)))
    return keyed.repartition("title", "block", "n_terms").groupBy("title", "block", "n_terms").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("term", "tf"))).alias("vec"))


def forward_maps(index: Index, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(title, block, vec MAP<term, tf>)``: the reference's per-document
    map, one bounded block per row."""
    blocks = forward_blocks(index, block_size)
    return blocks.select("title", "block", F.map_from_entries("vec").alias("vec"))


def map_tf(vec: Column, term: Column) -> Column:
    """tf of ``term`` in a forward map, 0 when absent."""
    return F.coalesce(F.try_element_at(vec, term), F.lit(0)).cast("bigint")


def map_lookup(index: Index, pairs: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``forward_lookup`` through the nested maps: each pair goes to the one
    block of its document that its term would stand in.

    Only these blocks are built: the postings are first reduced to the
    documents and blocks asked for, by a semi-join that broadcasts them if their
    measured size allows, so a lookup of few pairs moves nothing of the index.
    """
    index = materialize_index(index)
    titles = broadcast_if_small(pairs.select("title").distinct())
    docs = join_null_safe(index.documents().select("title", "n_terms"), titles, ["title"], "left_semi")
    asked = join_null_safe(pairs.select("title", "term"), docs, ["title"], "left").select(
        "title", "term", block_count(F.coalesce("n_terms", F.lit(0)), block_size).alias("blocks"))
    asked = materialize(asked.withColumn("block", F.pmod(stable_hash(F.col("term")), F.col("blocks"))), "asked")
    wanted = broadcast_if_small(asked.select("title", "blocks", "block").distinct())
    rows = join_null_safe(index.forward(), wanted.withColumnRenamed("block", "wanted"), ["title"])
    rows = rows.where(F.pmod(stable_hash(F.col("term")), F.col("blocks")) == F.col("wanted"))
    maps = rows.groupBy("title", F.col("wanted").alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("vec"))
    found = join_null_safe(asked, maps, ["title", "block"], "left")
    return found.select("title", "term", map_tf(F.col("vec"), F.col("term")).alias("tf"))


def forward_lookup(index: Index, pairs: DataFrame) -> DataFrame:
    """tf of (title, term) pairs, 0 when the document lacks the term
    (the reference's ``getOrElse(term, 0)``).

    The index is first reduced to the pairs asked for (a semi-join that
    broadcasts them if their measured size allows), so a lookup of few pairs
    neither shuffles nor broadcasts the index.
    """
    pairs = pairs.select("title", "term")
    asked = broadcast_if_small(pairs.distinct())
    hits = join_null_safe(index.forward(), asked, ["title", "term"], "left_semi")
    found = join_null_safe(pairs, hits, ["title", "term"], "left")
    return found.select("title", "term", F.coalesce(F.col("tf"), F.lit(0)).cast("bigint").alias("tf"))
