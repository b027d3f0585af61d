"""DuckDB SQL for the registered queries (the correctness oracle).

Each statement recomputes its answer from the raw driver tables with plain
SQL, independently of the Spark code: the same tokenizer rules (split on
the six \\s characters, possessive and ASCII punctuation to a space,
control-trim, lowercase, longer than one UTF-16 unit) and the same
formulas. Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

# Written out here, not taken from the engine, so that a wrong constant there
# cannot agree with itself.
K = "2.0"
B = "0.75"
IDF_HALF = 0.5
IDF_NOISE = 1e-10


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TRIM_SET = " || ".join(f"chr({c})" for c in range(0x00, 0x21))
#: Possessive, or ASCII punctuation other than the hyphen.
JUNK_SQL = r"""'''s|[!-,./:-@\[-`{-~]'"""
SPLIT_SQL = r"'[ \t\n\x0B\f\r]'"


def sanitize_sql(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, {JUNK_SQL}, ' ', 'g'), {TRIM_SET}))"


def keep_sql(x: str) -> str:
    return f"(length({x}) > 1 OR strlen({x}) > 3)"


def pieces_cte(name: str, source: str, key_expr: str, text_col: str) -> str:
    """``name(title, piece)``: one row per whitespace piece."""
    return (f"{name} AS (SELECT {key_expr} AS title, "
            f"unnest(string_split_regex({text_col}, {SPLIT_SQL})) AS piece FROM {source})")


def terms_cte(name: str, pieces: str) -> str:
    return (f"{name} AS (SELECT title, term FROM (SELECT title, {sanitize_sql('piece')} AS term "
            f"FROM {pieces}) WHERE {keep_sql('term')})")


def postings_cte(name: str, terms: str) -> str:
    return f"{name} AS (SELECT title, term, count(*) AS tf FROM {terms} GROUP BY title, term)"


def corpus_ctes(source: str = "documents", key: str = "doc_id", text: str = "text",
                prefix: str = "") -> str:
    """pieces / terms / postings / docs / stats CTEs for one table."""
    p = prefix
    return ",\n".join([
        pieces_cte(f"{p}pieces", source, f"CAST({key} AS VARCHAR)", text),
        terms_cte(f"{p}terms", f"{p}pieces"),
        postings_cte(f"{p}postings", f"{p}terms"),
        f"{p}docs AS (SELECT title, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens "
        f"FROM {p}postings GROUP BY title)",
        f"{p}stats AS (SELECT count(*) AS d, CAST(coalesce(sum(n_terms), 0) AS BIGINT) AS n_postings, "
        f"CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS n_tokens, "
        f"sum(n_terms) / count(*) AS avgdl, sum(n_tokens) / count(*) AS avg_tokens FROM {p}docs)",
        f"{p}lexicon AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf "
        f"FROM {p}postings GROUP BY term)",
    ])


def idf_sql(d: str, n: str) -> str:
    return f"(ln(({d} - {n} + {IDF_HALF!r}) / ({n} + {IDF_HALF!r})) + {IDF_NOISE!r})"


def param_sql(d: str, avgdl: str) -> str:
    return f"({K} * (1e0 - {B} + {B} * {d} / {avgdl}))"


def bm25_sql(idf: str, tf: str, param: str) -> str:
    return f"({idf} * ({tf} * ({K} + 1e0)) / ({tf} + {param}))"


def naive_sql(qtf: str, tf: str, idf: str) -> str:
    return f"(CASE WHEN {idf} <> 0e0 THEN ({qtf} * {tf}) / ({idf} * {idf}) ELSE 0e0 END)"


def query_profile_cte(query: str) -> str:
    """``qterms(term, qtf)`` of one literal query string."""
    pieces = f"unnest(string_split_regex({_sql_str(query)}, {SPLIT_SQL}))"
    return (f"qterms AS (SELECT term, count(*) AS qtf FROM (SELECT {sanitize_sql('piece')} AS term "
            f"FROM (SELECT {pieces} AS piece)) WHERE {keep_sql('term')} GROUP BY term)")


def weights_cte() -> str:
    return ("weights AS (SELECT l.term, q.qtf, l.df, " + idf_sql("s.d", "l.df") + " AS idf, "
            + param_sql("s.d", "s.avgdl") + " AS param "
            "FROM lexicon l JOIN qterms q ON l.term = q.term CROSS JOIN stats s)")


def rank_sql(query: str, method: str, k: int | None, matched_only: bool = False,
             length_norm: str = "corpus", source: str = "documents", key: str = "doc_id",
             text: str = "text") -> str:
    if method == "naive":
        contrib = naive_sql("w.qtf", "p.tf", "w.idf")
    elif length_norm == "document":
        contrib = bm25_sql("w.idf", "p.tf",
                           f"({K} * (1e0 - {B} + {B} * dd.n_tokens / s.avg_tokens))")
    else:
        contrib = bm25_sql("w.idf", "p.tf", "w.param")
    extra = ""
    if length_norm == "document" and method == "bm25":
        extra = " JOIN docs dd ON dd.title IS NOT DISTINCT FROM p.title CROSS JOIN stats s"
    matched = (f"matched AS (SELECT p.title, sum({contrib}) AS score FROM postings p "
               f"JOIN weights w ON p.term = w.term{extra} GROUP BY p.title)")
    if matched_only:
        scored = "scored AS (SELECT title, round(score, 6) AS score FROM matched)"
    else:
        scored = ("scored AS (SELECT d.title, round(coalesce(m.score, 0e0), 6) AS score "
                  "FROM docs d LEFT JOIN matched m ON d.title IS NOT DISTINCT FROM m.title)")
    limit = f" LIMIT {k}" if k is not None else ""
    return ("WITH " + ",\n".join([corpus_ctes(source, key, text), query_profile_cte(query),
                                  weights_cte(),
                                  matched, scored])
            + f"\nSELECT title, score FROM scored ORDER BY score DESC, title ASC{limit}")


def batch_rank_sql(method: str, k: int, source: str = "benchmark", key: str = "item_id",
                   text: str = "text") -> str:
    contrib = naive_sql("w.qtf", "p.tf", "w.idf") if method == "naive" else \
        bm25_sql("w.idf", "p.tf", "w.param")
    return ("WITH " + ",\n".join([
        corpus_ctes(),
        pieces_cte("qpieces", source, f"CAST({key} AS BIGINT)", text),
        terms_cte("qtoks", "qpieces"),
        "bq AS (SELECT title AS query_id, term, count(*) AS qtf FROM qtoks GROUP BY title, term)",
        "weights AS (SELECT q.query_id, q.term, q.qtf, l.df, " + idf_sql("s.d", "l.df") + " AS idf, "
        + param_sql("s.d", "s.avgdl") + " AS param FROM bq q JOIN lexicon l ON l.term = q.term "
        "CROSS JOIN stats s)",
        f"scores AS (SELECT w.query_id, p.title, round(sum({contrib}), 6) AS score "
        "FROM postings p JOIN weights w ON p.term = w.term GROUP BY w.query_id, p.title)",
        "ranked AS (SELECT query_id, title, score, row_number() OVER (PARTITION BY query_id "
        "ORDER BY score DESC, title ASC) AS rank FROM scores)",
    ]) + f"\nSELECT query_id, rank, title, score FROM ranked WHERE rank <= {k}")
