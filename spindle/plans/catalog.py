"""Registered queries: one per operator of the inventory, each with the
DuckDB statement that checks it.

Every query reads the driver tables (``documents`` as the corpus with
``title = CAST(doc_id AS STRING)``, ``benchmark`` as a table of queries,
``labels`` as relevance, ``conversations`` / ``pages`` as further corpora)
and runs over the whole tables. Single-query rankers take fixed query
strings as parameters; scores are rounded to 6 places in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindle.functions.scoring import bm25_param
from spindle.functions.text import explode_terms, is_term, sanitize, split_pieces, tokens
from spindle.operators.evaluate import average_precision
from spindle.operators.index import (Index, build_index, forward_blocks, forward_lookup,
                                     inverted_blocks, map_lookup, materialize_index, merge_index,
                                     term_frequency)
from spindle.operators.rank import (METHODS, batch_query_terms, check_method, lexicon_idf,
                                    query_weights, rank, rank_batch, tfidf_postings)
from spindle.plans import oracle as O
from spindle.session import scratch_path
from spindle.sources.documents import (corpus, load_table, read_documents_json, read_documents_json_checked, table_documents,
                                       write_documents_json)
from spindle.plans.jobs import add_job
from spindle.sources.store import compact_index, load_index, save_index
from spindle.streaming.add import streaming_build

# ---------------------------------------------------------------------------
# Query strings, parameters of the single-query rankers. Q_CABRAL
# and "hello world" must equal the report's published queries.
# ---------------------------------------------------------------------------
Q_MID = "esat estion aiment"
Q_REPEAT = "esat estion estion aiment aiment aiment"
Q_NEGATIVE = "in"
Q_HELLO = "hello world"
Q_CABRAL = ("inhabited by numerous tribal nations prior to the landing in 1500 of "
            "explorer Pedro Álvares Cabral")
BLOCK = 512          # members per nested block in the registered views
DEC = 6              # decimals of every reported double
STORED_BUCKETS = 8   # bucket directories of the stored test index
STREAM_REFRESH_ROWS = 100_000  # pending postings that trigger a streaming flush

Query = Callable[[SparkSession, str], DataFrame]


def docs_index(spark: SparkSession, sf: str) -> Index:
    return build_index(corpus(spark, sf, "documents"))


_STORED: dict[tuple[str, str], str] = {}


def stored_index(spark: SparkSession, sf: str) -> Index:
    """The documents index written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        path = scratch_path(spark, "index")
        # 8 bucket directories (more than the data-sized default at these
        # scales) so the registered queries exercise bucket pruning.
        save_index(docs_index(spark, sf), path, n_buckets=STORED_BUCKETS)
        _STORED[key] = path
    return load_index(spark, _STORED[key])


def _round(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, DEC))
    return df


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def q_tokenize_documents(spark, sf):
    return explode_terms(corpus(spark, sf), "title", "text").select("title", "term")


def q_sanitize_terms(spark, sf):
    pieces = corpus(spark, sf).select(F.explode(split_pieces(F.col("text"))).alias("piece")).distinct()
    term = sanitize(F.col("piece"))
    return pieces.select("piece", term.alias("term"), is_term(term).alias("kept"))


def q_query_tokens(spark, sf):
    bench = load_table(spark, sf, "benchmark")
    return bench.select(F.col("item_id").alias("query_id"),
                        F.explode(tokens(F.col("text"))).alias("term"))


def q_query_term_frequency(spark, sf):
    return batch_query_terms(load_table(spark, sf, "benchmark"), "item_id", "text")


def q_term_frequency(spark, sf):
    return docs_index(spark, sf).flat()


def q_conversations_term_frequency(spark, sf):
    return term_frequency(corpus(spark, sf, "conversations"))


def q_pages_term_frequency(spark, sf):
    return term_frequency(corpus(spark, sf, "pages"))


def q_forward_index(spark, sf):
    blocks = forward_blocks(docs_index(spark, sf), BLOCK)
    vec = F.array_join(F.transform("vec", lambda e: F.concat(e.term, F.lit(":"), e.tf.cast("string"))), "|")
    return blocks.select("title", "block", "n_terms", "n", vec.alias("vec"))


def q_inverted_index(spark, sf):
    blocks = inverted_blocks(docs_index(spark, sf), BLOCK)
    return blocks.select("term", "block", "df", "n", F.array_join("titles", ",").alias("titles"))


def q_document_frequency(spark, sf):
    return docs_index(spark, sf).lexicon().select("term", "df")


def q_corpus_stats(spark, sf):
    return _round(docs_index(spark, sf).stats(), "avgdl", "avg_tokens")


def q_doc_vocab_size(spark, sf):
    return docs_index(spark, sf).documents()


def q_idf_all_terms(spark, sf):
    return _round(lexicon_idf(docs_index(spark, sf)), "idf")


def q_idf_query_terms(spark, sf):
    w = query_weights(materialize_index(docs_index(spark, sf)), spark, Q_CABRAL + " " + Q_MID)
    return _round(w.select("term", "qtf", "df", "idf"), "idf")


def q_bm25_param(spark, sf):
    s = docs_index(spark, sf).stats()
    return _round(s.select("d", "avgdl", bm25_param(F.col("d"), F.col("avgdl")).alias("param")),
                  "avgdl", "param")


def q_query_term_postings(spark, sf):
    idx = docs_index(spark, sf)
    return idx.postings_for_terms(sorted(set(Q_MID.split())))


def _passage_pairs(spark, sf):
    # (title, term) pairs: each benchmark passage's terms looked up in the
    # document with the same id; absent pairs read tf = 0.
    bench = load_table(spark, sf, "benchmark")
    return bench.select(F.col("item_id").cast("string").alias("title"),
                        F.explode(tokens(F.col("text"))).alias("term")).distinct()


def q_forward_index_lookup(spark, sf):
    return forward_lookup(stored_index(spark, sf), _passage_pairs(spark, sf))


def q_forward_map_lookup(spark, sf):
    return map_lookup(stored_index(spark, sf), _passage_pairs(spark, sf), BLOCK)


def null_title_corpus(spark, sf, name="documents", key="doc_id"):
    """Every table row, where ids that end in 7 have no title (together they
    are one document)."""
    docs = load_table(spark, sf, name)
    return table_documents(docs.withColumn(key, F.when(F.col(key) % 10 != 7, F.col(key))), key)


def q_rank_null_title(spark, sf):
    idx = materialize_index(build_index(null_title_corpus(spark, sf)))
    return rank(idx, Q_MID, "bm25", None, decimals=DEC)


def q_rank_okapi_null_title(spark, sf):
    idx = materialize_index(build_index(null_title_corpus(spark, sf)))
    return rank(idx, Q_MID, "bm25", None, length_norm="document", decimals=DEC)


def q_forward_index_null_title(spark, sf):
    blocks = forward_blocks(build_index(null_title_corpus(spark, sf)), BLOCK)
    vec = F.array_join(F.transform("vec", lambda e: F.concat(e.term, F.lit(":"), e.tf.cast("string"))), "|")
    return blocks.select("title", "block", "n_terms", "n", vec.alias("vec"))


_ADDED_NULL: dict[tuple[str, str], str] = {}


def added_null_title(spark: SparkSession, sf: str) -> Index:
    """Documents with a null title stored, passages with a null title added."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ADDED_NULL:
        old, path = scratch_path(spark, "index"), scratch_path(spark, "index-added")
        save_index(build_index(null_title_corpus(spark, sf)), old, n_buckets=STORED_BUCKETS)
        add_job(spark, null_title_corpus(spark, sf, "benchmark", "item_id"), old, path)
        _ADDED_NULL[key] = path
    return load_index(spark, _ADDED_NULL[key])


def q_add_null_title_docs(spark, sf):
    return added_null_title(spark, sf).flat()


def q_add_null_title_stats(spark, sf):
    return _round(added_null_title(spark, sf).stats(), "avgdl", "avg_tokens")


def q_add_null_title_words(spark, sf):
    return added_null_title(spark, sf).lexicon()


def q_compacted_index(spark, sf):
    added_index(spark, sf)
    key = (spark.sparkContext.applicationId, sf)
    return compact_index(spark, _ADDED[key], scratch_path(spark, "index-compacted")).flat()


def q_index_add_resorted(spark, sf):
    stored_index(spark, sf)
    old = _STORED[(spark.sparkContext.applicationId, sf)]
    return add_job(spark, _new_documents(spark, sf), old, scratch_path(spark, "index-resorted"), layout="resort").flat()


def _rank(query, method, k, matched_only=False, length_norm="corpus", stored=False):
    def run(spark, sf):
        idx = stored_index(spark, sf) if stored else materialize_index(docs_index(spark, sf))
        return rank(idx, query, method, k, matched_only, length_norm, decimals=DEC)
    return run


def _rank_corpus(name, query, method, k):
    def run(spark, sf):
        idx = materialize_index(build_index(corpus(spark, sf, name)))
        return rank(idx, query, method, k, decimals=DEC)
    return run


def q_tfidf_postings(spark, sf):
    return _round(tfidf_postings(docs_index(spark, sf)), "idf", "tfidf")


def _merge_parts(spark, sf):
    # benchmark ids equal document ids (overwrite); conversations get new
    # titles "c<id>" (insertion)
    return merge_index(docs_index(spark, sf), build_index(_new_documents(spark, sf)))


def _new_documents(spark, sf):
    bench = corpus(spark, sf, "benchmark")
    conv = corpus(spark, sf, "conversations").withColumn(
        "title", F.concat(F.lit("c"), F.col("title")))
    return bench.unionByName(conv)


_ADDED: dict[tuple[str, str], str] = {}


def added_index(spark: SparkSession, sf: str) -> Index:
    """The stored documents index with benchmark passages (same ids:
    overwrite) and conversations (new ids: insertion) added by the add job."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ADDED:
        stored_index(spark, sf)
        path = scratch_path(spark, "index-added")
        add_job(spark, _new_documents(spark, sf), _STORED[key], path)
        _ADDED[key] = path
    return load_index(spark, _ADDED[key])


def q_index_add_docs(spark, sf):
    return added_index(spark, sf).flat()


def q_index_add_words(spark, sf):
    return added_index(spark, sf).lexicon()


def q_index_add_stats(spark, sf):
    return _round(added_index(spark, sf).stats(), "avgdl", "avg_tokens")


def q_index_merge_docs(spark, sf):
    return _merge_parts(spark, sf).flat()


def q_index_merge_words(spark, sf):
    return _merge_parts(spark, sf).lexicon()


def q_index_merge_stats(spark, sf):
    return _round(_merge_parts(spark, sf).stats(), "avgdl", "avg_tokens")


def q_json_document_scan(spark, sf):
    path = scratch_path(spark, "json-docs")
    write_documents_json(corpus(spark, sf), path)
    return read_documents_json(spark, path)


def q_json_bad_lines(spark, sf):
    """Every document as a JSON line; of ids that end in 3 cut short, in 4 no JSON."""
    path = scratch_path(spark, "json-lines")
    docs = load_table(spark, sf, "documents")
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("title"), "text"))
    end = F.col("doc_id") % 10
    docs.select(F.when(end == 3, F.substring(line, F.lit(1), F.length(line) - 1)).when(end == 4, F.lit("no json, doc_id 4"))
                .otherwise(line).alias("value")).write.text(path)
    good, bad = read_documents_json_checked(spark, path)
    return (good.select(F.lit("document").alias("kind"), "title").unionByName(bad.select(F.lit("bad line").alias("kind"), F.lit(None).cast("string").alias("title")))
            .groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count("title").alias("n_titles")))


def q_json_index_build(spark, sf):
    path = scratch_path(spark, "json-docs")
    write_documents_json(corpus(spark, sf), path)
    return term_frequency(read_documents_json(spark, path))


def q_index_docs_roundtrip(spark, sf):
    return stored_index(spark, sf).forward()


def q_index_words_roundtrip(spark, sf):
    idx = stored_index(spark, sf)
    return idx.postings.select("term", "title", "tf")


def q_stored_lexicon(spark, sf):
    return stored_index(spark, sf).lexicon_df.select("term", "df", "cf")


def q_stored_corpus_stats(spark, sf):
    return _round(stored_index(spark, sf).stats(), "avgdl", "avg_tokens")


def _batch(method):
    def run(spark, sf):
        return rank_batch(docs_index(spark, sf), load_table(spark, sf, "benchmark"), method, 10,
                          "item_id", "text", decimals=DEC)
    return run


def _batch_stored(method):
    def run(spark, sf):
        return rank_batch(stored_index(spark, sf), load_table(spark, sf, "benchmark"), method, 10,
                          "item_id", "text", decimals=DEC)
    return run


def _ap(method):
    def run(spark, sf):
        ranked = rank_batch(docs_index(spark, sf), load_table(spark, sf, "benchmark"), method, 10,
                            "item_id", "text", decimals=DEC)
        labels = load_table(spark, sf, "labels")
        relevant = labels.where(F.col("quality") == 1).select(
            F.col("doc_id").cast("string").alias("title"))
        return _round(average_precision(ranked, relevant), "ap")
    return run


# The report's two published queries, each ranked by both methods (ids are
# the order below: 1-2 Cabral naive/bm25, 3-4 "Hello world" naive/bm25).
REPORT_RUNS = ((1, Q_CABRAL, "naive"), (2, Q_CABRAL, "bm25"),
               (3, "Hello world", "naive"), (4, "Hello world", "bm25"))


def q_average_precision_report_queries(spark, sf):
    idx = stored_index(spark, sf)
    w = Window.orderBy(F.desc("score"), F.asc("title"))
    ranked = None
    for run_id, query, method in REPORT_RUNS:
        top = rank(idx, query, method, 10, decimals=DEC)       # 10 rows: bounded window
        top = top.select(F.lit(run_id).cast("bigint").alias("query_id"),
                         F.row_number().over(w).cast("bigint").alias("rank"), "title", "score")
        ranked = top if ranked is None else ranked.unionByName(top)
    labels = load_table(spark, sf, "labels")
    relevant = labels.where(F.col("quality") == 1).select(
        F.col("doc_id").cast("string").alias("title"))
    return _round(average_precision(ranked, relevant), "ap")


_STREAMED: dict[tuple[str, str], Index] = {}


def streamed_index(spark: SparkSession, sf: str) -> Index:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STREAMED:
        _STREAMED[key] = streaming_build(spark, corpus(spark, sf), batches=4, refresh_rows=STREAM_REFRESH_ROWS)
    return _STREAMED[key]


def q_streaming_index_add(spark, sf):
    return streamed_index(spark, sf).flat()


def q_streaming_index_lexicon(spark, sf):
    return streamed_index(spark, sf).lexicon()


def q_streaming_index_stats(spark, sf):
    return _round(streamed_index(spark, sf).stats(), "avgdl", "avg_tokens")


def q_ranker_choice(spark, sf):
    """The ranker chosen by name, each name once."""
    idx = stored_index(spark, sf)
    ranked = None
    for method in METHODS:
        one = rank(idx, Q_MID, check_method(method), 10, decimals=DEC).select(F.lit(method).alias("method"), "title", "score")
        ranked = one if ranked is None else ranked.unionByName(one)
    return ranked


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


C = O.corpus_ctes()


def _blocks_hash(x: str) -> str:
    return f"CAST(('0x' || substr(md5({x}), 1, 15)) AS BIGINT)"


def _nblocks(size: str) -> str:
    return f"greatest(1, CAST(ceil({size} / {float(BLOCK)!r}) AS BIGINT))"


def _untitled(key: str) -> str:
    return f"CASE WHEN {key} % 10 <> 7 THEN {key} END"


def _merge_sql(select: str, null_titles: bool = False) -> str:
    base = O.corpus_ctes(key=_untitled("doc_id")) if null_titles else C
    new_pieces = [O.pieces_cte("npieces", "benchmark", f"CAST({_untitled('item_id')} AS VARCHAR)", "text")] if null_titles else [
        O.pieces_cte("bpieces", "benchmark", "CAST(item_id AS VARCHAR)", "text"),
        O.pieces_cte("cpieces", "conversations", "'c' || CAST(conv_id AS VARCHAR)", "text"),
        "npieces AS (SELECT * FROM bpieces UNION ALL SELECT * FROM cpieces)"]
    new_ctes = ",\n".join([
        *new_pieces,
        O.terms_cte("nterms", "npieces"),
        O.postings_cte("npostings", "nterms"),
        "merged AS (SELECT o.title, o.term, o.tf FROM postings o WHERE NOT EXISTS "
        "(SELECT 1 FROM npostings n WHERE n.title IS NOT DISTINCT FROM o.title AND n.term = o.term) "
        "UNION ALL SELECT title, term, tf FROM npostings)",
        "mdocs AS (SELECT title, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens "
        "FROM merged GROUP BY title)",
    ])
    return _with(base, new_ctes) + select


MERGED_WORDS = "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM merged GROUP BY term"
MERGED_STATS = ("SELECT count(*) AS d, CAST(sum(n_terms) AS BIGINT) AS n_postings, "
                "CAST(sum(n_tokens) AS BIGINT) AS n_tokens, round(sum(n_terms) / count(*), 6) AS avgdl, "
                "round(sum(n_tokens) / count(*), 6) AS avg_tokens FROM mdocs")
STATS_SQL = ("SELECT d, n_postings, n_tokens, round(avgdl, 6) AS avgdl, "
             "round(avg_tokens, 6) AS avg_tokens FROM stats")


def _forward_sql(key: str = "doc_id") -> str:
    return _with(O.corpus_ctes(key=key)) + (
        "SELECT p.title, " + f"{_blocks_hash('p.term')} % {_nblocks('d.n_terms')}" + " AS block, "
        "d.n_terms, count(*) AS n, string_agg(p.term || ':' || CAST(p.tf AS VARCHAR), '|' "
        "ORDER BY p.term) AS vec FROM postings p JOIN docs d ON p.title IS NOT DISTINCT FROM d.title "
        "GROUP BY 1, 2, 3")


def _lookup_sql() -> str:
    return _with(
        C, O.pieces_cte("qp", "benchmark", "CAST(item_id AS VARCHAR)", "text"), O.terms_cte("qt", "qp"),
        "pairs AS (SELECT DISTINCT title, term FROM qt)") + (
        "SELECT a.title, a.term, CAST(coalesce(p.tf, 0) AS BIGINT) AS tf FROM pairs a "
        "LEFT JOIN postings p ON a.title = p.title AND a.term = p.term")


def _choice_sql() -> str:
    return " UNION ALL ".join(f"(SELECT '{m}' AS method, title, score FROM ({O.rank_sql(Q_MID, m, 10)}))" for m in ("bm25", "naive"))


def _report_ap_sql() -> str:
    parts = []
    for run_id, query, method in REPORT_RUNS:
        parts.append(f"SELECT CAST({run_id} AS BIGINT) AS query_id, "
                     "row_number() OVER (ORDER BY score DESC, title ASC) AS rank, title, score "
                     f"FROM ({O.rank_sql(query, method, 10)})")
    return _ap_from_ranked(" UNION ALL ".join(f"({p})" for p in parts))


def _ap_sql(method: str) -> str:
    return _ap_from_ranked(O.batch_rank_sql(method, 10))


def _ap_from_ranked(ranked: str) -> str:
    return (f"WITH r AS ({ranked}),\n"
            "rel AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS title FROM labels WHERE quality = 1),\n"
            "flag AS (SELECT r.query_id, r.rank, CASE WHEN rel.title IS NULL THEN 0 ELSE 1 END AS hit "
            "FROM r LEFT JOIN rel ON r.title = rel.title),\n"
            "run AS (SELECT query_id, rank, hit, sum(hit) OVER (PARTITION BY query_id ORDER BY rank "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hits FROM flag)\n"
            "SELECT query_id, CAST(count(*) AS BIGINT) AS n_ranked, CAST(sum(hit) AS BIGINT) AS n_relevant, "
            "round(coalesce(sum(CASE WHEN hit = 1 THEN hits / rank END) / nullif(sum(hit), 0), 0e0), 6) "
            "AS ap FROM run GROUP BY query_id")


ENTRIES: dict[str, tuple[Query, str | None]] = {
    "tokenize_documents": (q_tokenize_documents, _with(C) + "SELECT title, term FROM terms"),
    "sanitize_terms": (q_sanitize_terms, _with(O.pieces_cte(
        "pieces", "documents", "CAST(doc_id AS VARCHAR)", "text"))
        + f"SELECT piece, term, {O.keep_sql('term')} AS kept FROM (SELECT piece, "
          f"{O.sanitize_sql('piece')} AS term FROM (SELECT DISTINCT piece FROM pieces))"),
    "query_tokens": (q_query_tokens, _with(
        O.pieces_cte("qp", "benchmark", "CAST(item_id AS BIGINT)", "text"), O.terms_cte("qt", "qp"))
        + "SELECT title AS query_id, term FROM qt"),
    "query_term_frequency": (q_query_term_frequency, _with(
        O.pieces_cte("qp", "benchmark", "CAST(item_id AS BIGINT)", "text"), O.terms_cte("qt", "qp"))
        + "SELECT title AS query_id, term, count(*) AS qtf FROM qt GROUP BY title, term"),
    "term_frequency": (q_term_frequency, _with(C) + "SELECT title, term, tf FROM postings"),
    "conversations_term_frequency": (q_conversations_term_frequency, _with(
        O.corpus_ctes("conversations", "conv_id", "text")) + "SELECT title, term, tf FROM postings"),
    "pages_term_frequency": (q_pages_term_frequency, _with(
        O.corpus_ctes("pages", "page_id", "html")) + "SELECT title, term, tf FROM postings"),
    "forward_index": (q_forward_index, _forward_sql()),
    "forward_index_null_title": (q_forward_index_null_title, _forward_sql(_untitled("doc_id"))),
    "forward_map_lookup": (q_forward_map_lookup, _lookup_sql()),
    "rank_bm25_null_title_all": (q_rank_null_title, O.rank_sql(Q_MID, "bm25", None, key=_untitled("doc_id"))),
    "rank_bm25_okapi_null_title": (q_rank_okapi_null_title, O.rank_sql(
        Q_MID, "bm25", None, length_norm="document", key=_untitled("doc_id"))),
    "index_add_null_title_docs": (q_add_null_title_docs, _merge_sql("SELECT title, term, tf FROM merged", True)),
    "index_add_null_title_words": (q_add_null_title_words, _merge_sql(MERGED_WORDS, True)),
    "index_add_null_title_stats": (q_add_null_title_stats, _merge_sql(MERGED_STATS, True)),
    "index_add_resorted": (q_index_add_resorted, _merge_sql("SELECT title, term, tf FROM merged")),
    "index_compacted": (q_compacted_index, _merge_sql("SELECT title, term, tf FROM merged")),
    "ranker_choice": (q_ranker_choice, _choice_sql()),
    "inverted_index": (q_inverted_index, _with(C) + (
        "SELECT p.term, " + f"{_blocks_hash('p.title')} % {_nblocks('l.df')}" + " AS block, "
        "l.df, count(*) AS n, string_agg(p.title, ',' ORDER BY p.title) AS titles "
        "FROM postings p JOIN lexicon l ON p.term = l.term GROUP BY 1, 2, 3")),
    "document_frequency": (q_document_frequency, _with(C) + "SELECT term, df FROM lexicon"),
    "corpus_stats": (q_corpus_stats, _with(C) + (
        "SELECT d, n_postings, n_tokens, round(avgdl, 6) AS avgdl, "
        "round(avg_tokens, 6) AS avg_tokens FROM stats")),
    "doc_vocab_size": (q_doc_vocab_size, _with(C) + "SELECT title, n_terms, n_tokens FROM docs"),
    "idf_all_terms": (q_idf_all_terms, _with(C) + (
        f"SELECT l.term, l.df, round({O.idf_sql('s.d', 'l.df')}, 6) AS idf "
        "FROM lexicon l CROSS JOIN stats s")),
    "idf_query_terms": (q_idf_query_terms, _with(C, O.query_profile_cte(Q_CABRAL + " " + Q_MID),
                                                 O.weights_cte())
                        + "SELECT term, qtf, df, round(idf, 6) AS idf FROM weights"),
    "bm25_param": (q_bm25_param, _with(C) + (
        f"SELECT d, round(avgdl, 6) AS avgdl, round({O.param_sql('d', 'avgdl')}, 6) AS param "
        "FROM stats")),
    "query_term_postings": (q_query_term_postings, _with(C) + (
        "SELECT title, term, tf FROM postings WHERE term IN ("
        + ", ".join(O._sql_str(t) for t in sorted(set(Q_MID.split()))) + ")")),
    "forward_index_lookup": (q_forward_index_lookup, _lookup_sql()),
    "rank_bm25_top10": (_rank(Q_MID, "bm25", 10), O.rank_sql(Q_MID, "bm25", 10)),
    "rank_bm25_all": (_rank(Q_MID, "bm25", None), O.rank_sql(Q_MID, "bm25", None)),
    "rank_naive_top10": (_rank(Q_REPEAT, "naive", 10), O.rank_sql(Q_REPEAT, "naive", 10)),
    "rank_naive_all": (_rank(Q_REPEAT, "naive", None), O.rank_sql(Q_REPEAT, "naive", None)),
    "rank_bm25_negative_top10": (_rank(Q_NEGATIVE, "bm25", 10), O.rank_sql(Q_NEGATIVE, "bm25", 10)),
    "rank_bm25_negative_all": (_rank(Q_NEGATIVE, "bm25", None), O.rank_sql(Q_NEGATIVE, "bm25", None)),
    "rank_bm25_unknown_top10": (_rank(Q_HELLO, "bm25", 10), O.rank_sql(Q_HELLO, "bm25", 10)),
    "rank_naive_unknown_top10": (_rank(Q_HELLO, "naive", 10), O.rank_sql(Q_HELLO, "naive", 10)),
    "rank_bm25_cabral_top10": (_rank(Q_CABRAL, "bm25", 10), O.rank_sql(Q_CABRAL, "bm25", 10)),
    "rank_naive_cabral_top10": (_rank(Q_CABRAL, "naive", 10), O.rank_sql(Q_CABRAL, "naive", 10)),
    "rank_bm25_stored_top10": (_rank(Q_MID, "bm25", 10, stored=True), O.rank_sql(Q_MID, "bm25", 10)),
    "rank_naive_stored_top10": (_rank(Q_REPEAT, "naive", 10, stored=True),
                                O.rank_sql(Q_REPEAT, "naive", 10)),
    "rank_bm25_conversations_top10": (
        _rank_corpus("conversations", Q_MID, "bm25", 10),
        O.rank_sql(Q_MID, "bm25", 10, source="conversations", key="conv_id")),
    "rank_naive_conversations_all": (
        _rank_corpus("conversations", Q_REPEAT, "naive", None),
        O.rank_sql(Q_REPEAT, "naive", None, source="conversations", key="conv_id")),
    "rank_bm25_pages_top10": (
        _rank_corpus("pages", Q_CABRAL, "bm25", 10),
        O.rank_sql(Q_CABRAL, "bm25", 10, source="pages", key="page_id", text="html")),
    "rank_bm25_matched": (_rank(Q_MID, "bm25", None, matched_only=True),
                          O.rank_sql(Q_MID, "bm25", None, matched_only=True)),
    "rank_bm25_okapi": (_rank(Q_MID, "bm25", None, length_norm="document"),
                        O.rank_sql(Q_MID, "bm25", None, length_norm="document")),
    "tfidf_postings": (q_tfidf_postings, _with(C) + (
        f"SELECT p.title, p.term, p.tf, l.df, round({O.idf_sql('s.d', 'l.df')}, 6) AS idf, "
        f"round(p.tf * {O.idf_sql('s.d', 'l.df')}, 6) AS tfidf "
        "FROM postings p JOIN lexicon l ON p.term = l.term CROSS JOIN stats s")),
    "rank_bm25_batch": (_batch("bm25"), O.batch_rank_sql("bm25", 10)),
    "rank_naive_batch": (_batch("naive"), O.batch_rank_sql("naive", 10)),
    "rank_bm25_batch_stored": (_batch_stored("bm25"), O.batch_rank_sql("bm25", 10)),
    "average_precision_at_10": (_ap("bm25"), _ap_sql("bm25")),
    "average_precision_naive_at_10": (_ap("naive"), _ap_sql("naive")),
    "average_precision_report_queries": (q_average_precision_report_queries, _report_ap_sql()),
    "index_merge_docs": (q_index_merge_docs, _merge_sql("SELECT title, term, tf FROM merged")),
    "index_merge_words": (q_index_merge_words, _merge_sql(
        "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM merged GROUP BY term")),
    "index_merge_stats": (q_index_merge_stats, _merge_sql(
        "SELECT count(*) AS d, CAST(sum(n_terms) AS BIGINT) AS n_postings, "
        "CAST(sum(n_tokens) AS BIGINT) AS n_tokens, round(sum(n_terms) / count(*), 6) AS avgdl, "
        "round(sum(n_tokens) / count(*), 6) AS avg_tokens FROM mdocs")),
    "index_add_docs": (q_index_add_docs, _merge_sql("SELECT title, term, tf FROM merged")),
    "index_add_words": (q_index_add_words, _merge_sql(
        "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM merged GROUP BY term")),
    "index_add_stats": (q_index_add_stats, _merge_sql(
        "SELECT count(*) AS d, CAST(sum(n_terms) AS BIGINT) AS n_postings, "
        "CAST(sum(n_tokens) AS BIGINT) AS n_tokens, round(sum(n_terms) / count(*), 6) AS avgdl, "
        "round(sum(n_tokens) / count(*), 6) AS avg_tokens FROM mdocs")),
    "json_document_scan": (q_json_document_scan,
                           "SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents"),
    "json_bad_lines": (q_json_bad_lines,
                       "SELECT CASE WHEN doc_id % 10 IN (3, 4) THEN 'bad line' ELSE 'document' END AS kind, count(*) AS n, "
                       "count(*) FILTER (doc_id % 10 NOT IN (3, 4)) AS n_titles FROM documents GROUP BY 1"),
    "json_index_build": (q_json_index_build, _with(C) + "SELECT title, term, tf FROM postings"),
    "index_docs_roundtrip": (q_index_docs_roundtrip, _with(C) + "SELECT title, term, tf FROM postings"),
    "index_words_roundtrip": (q_index_words_roundtrip,
                              _with(C) + "SELECT term, title, tf FROM postings"),
    "stored_lexicon": (q_stored_lexicon, _with(C) + "SELECT term, df, cf FROM lexicon"),
    "stored_corpus_stats": (q_stored_corpus_stats, _with(C) + (
        "SELECT d, n_postings, n_tokens, round(avgdl, 6) AS avgdl, "
        "round(avg_tokens, 6) AS avg_tokens FROM stats")),
    "streaming_index_add": (q_streaming_index_add, _with(C) + "SELECT title, term, tf FROM postings"),
    "streaming_index_lexicon": (q_streaming_index_lexicon, _with(C) + "SELECT term, df, cf FROM lexicon"),
    "streaming_index_stats": (q_streaming_index_stats, _with(C) + STATS_SQL),
}


def registered_queries() -> dict[str, Query]:
    return {name: fn for name, (fn, _) in ENTRIES.items()}


def registered_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql is not None}
