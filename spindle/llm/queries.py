"""The registered queries of this subpackage: thin applications of its
operators to the whole given tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import (bloom_cascade, debruijn, jump_shard, langid, lattice,
                         license_scan, license_texts, merkle,
                         mixing, phrases, quality, simhash, template_decon,
                         whitening)
from spindle.llm.common import crc_of_id, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


#: Spellings that count as equal, the SQL's own list: each word and the one it becomes.
SQL_SPELLINGS = """acknowledgement acknowledgment, analogue analog, analyse analyze, artefact artifact, authorisation authorization,
authorised authorized, calibre caliber, cancelled canceled, capitalisations capitalizations, catalogue catalog, categorise categorize,
centre center, emphasised emphasized, favour favor, favourite favorite, fulfil fulfill, fulfilment fulfillment, initialise initialize,
judgement judgment, labelling labeling, labour labor, licence license, licenced licensed, licences licenses, maximise maximize,
modelled modeled, modelling modeling, offence offense, optimise optimize, organisation organization, organise organize,
practise practice, programme program, realise realize, recognise recognize, signalling signaling, utilisation utilization,
whilst while, wilful willful, owner holder"""


def _op1_sql() -> str:
    """Canonical forms by list functions, joined as digests."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def form(lines: str) -> str:
        return rf"""array_to_string(list_transform(list_filter(string_split(regexp_replace(array_to_string(list_filter({lines}, lambda x:
            NOT regexp_matches(x, '^[^\p{{L}}\p{{N}}_]*(copyright\s*(\(c\)|©|[0-9]{{4}}|<|\[)|\(c\)\s|©|all rights reserved[^\p{{L}}\p{{N}}_]*$)')),
            chr(10)), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: {spell}), ' ')"""

    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in license_texts.KNOWN)
    digests = ", ".join(f"({quoted(n)}, {quoted(k)})" for n, k in license_texts.DIGESTS)
    pairs = [x.split() for x in SQL_SPELLINGS.split(",")]
    spell = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs) + " ELSE w END"
    return f"""
WITH k AS (SELECT DISTINCT n AS license, sha256(f) AS key FROM (
             SELECT n, {form("string_split(lower(t), chr(10))")} AS f FROM (VALUES {known}) AS v(n, t)) WHERE f <> ''
      UNION SELECT * FROM (VALUES {digests}) AS p(license, key)),
d AS (SELECT doc_id, row_number() OVER () AS r, string_split(lower(coalesce(text, '')), chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, r, {form("ls")} AS f FROM d),
l AS (SELECT r, {form("[x0]")} AS f FROM (SELECT r, unnest(ls) AS x0 FROM d)),
a AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS license FROM w JOIN k ON sha256(f) = key GROUP BY r),
b AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM l JOIN k ON sha256(f) = key GROUP BY r)
SELECT doc_id, CASE WHEN f = '' THEN 0 ELSE length(f) - length(replace(f, ' ', '')) + 1 END AS n_words, sha256(f) AS digest, license, notices
FROM w LEFT JOIN a USING (r) LEFT JOIN b USING (r)
"""


def op2_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = debruijn.remove_repeats(table(spark, sf_dir, "documents"), width=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


#: Words of every text, windows of 50 as text, the least id of each window.
OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
g AS (
  SELECT r, doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS win
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
f AS (
  SELECT r, i FROM g JOIN (SELECT win, min(doc_id) AS least FROM g GROUP BY win) USING (win) WHERE least < doc_id),
gone AS (SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM f) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_transform(list_filter(
         list_zip(ws, range(1, len(ws) + 1)), lambda z: NOT list_contains(ps, z[2])), lambda z: z[1]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (r)
"""


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template_decon.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return (found.groupBy("doc_id", "item_id", "n_windows")
            .agg(F.max("n_matched").alias("n_matched"), F.max("n_slots").alias("n_slots"))
            .select("doc_id", "item_id", "n_windows", "n_matched", "n_slots"))


#: The words of the SQL are its own: number words, and units after a number.
SQL_NUMBERS = """two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen"""
SQL_UNITS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds lb lbs oz ounce ounces
ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years
dollar dollars cent cents euro euros percent degree degrees kmh mph hz khz mhz ghz kb mb gb tb w kw v volt volts watt watts"""


def _template_sql(source: str, key: str) -> str:
    """Windows of five tokens of ``source``'s texts, as text: the template (form
    1) and the case-free form where it differs (form 2). chr(2) marks names,
    chr(3) words capitalised after other white space."""
    def listed(words: str) -> str:
        return "(" + ", ".join(f"'{w}'" for w in words.split()) + ")"

    number = f"(regexp_matches(%s, '^[0-9]') OR %s IN {listed(SQL_NUMBERS)})"
    return rf"""
  SELECT {key}, r, pos, UNNEST([
           {{form: 1, win: named, slots: named_slots, plain: named, words: words}},
           CASE WHEN free <> named THEN {{form: 2, win: free, slots: free_slots, plain: named, words: words}} END], recursive := true)
  FROM (
    SELECT {key}, r, i - 1 AS pos, array_to_string([p.named for p in ps[i:i + 4]], ' ') AS named,
           array_to_string([p.free for p in ps[i:i + 4]], ' ') AS free,
           array_to_string([p.word for p in ps[i:i + 4] if p.named <> p.word], chr(1)) AS named_slots,
           array_to_string([p.word for p in ps[i:i + 4] if p.free <> p.word], chr(1)) AS free_slots,
           len([p.word for p in ps[i:i + 4] if p.named = p.word]) AS words
    FROM (
      SELECT {key}, r, ps, unnest(range(1, len(ps) - 3)) AS i FROM (
        SELECT {key}, r, list_transform(fs, lambda f: {{word: f.word, free: f.free,
                 named: CASE WHEN f.mark = chr(2) AND f.free = f.word THEN '<name>' ELSE f.free END}}) AS ps
        FROM (
          SELECT {key}, r, list_transform(range(1, len(t) + 1), lambda j: {{word: t[j], mark: m[j][1], free: CASE
              WHEN {number % ("t[j]", "t[j]")} THEN '<num>'
              WHEN t[j] IN ('%', '$', '€', '£', '¥', '°') THEN '<unit>'
              WHEN j > 1 AND {number % ("t[j - 1]", "t[j - 1]")} AND t[j] IN {listed(SQL_UNITS)} THEN '<unit>'
              ELSE t[j] END}}) AS fs
          FROM (
            SELECT {key}, r, m, list_transform(m, lambda x: ltrim(x, chr(2) || chr(3))) AS t
            FROM (
              SELECT {key}, row_number() OVER () AS r, regexp_extract_all(lower(regexp_replace(regexp_replace(
                  text, '([\p{{L}}\p{{N}},;]) (\p{{Lu}})', '\1 ' || chr(2) || '\2', 'g'),
                  '([\p{{L}}\p{{N}},;])[\t\n\x0B\f\r\p{{Z}}]+(\p{{Lu}})', '\1 ' || chr(3) || '\2', 'g')),
                  '[\x02\x03]?[\p{{L}}\p{{M}}]+|[0-9]+(?:[.,:/][0-9]+)*|[%$€£¥°]') AS m
              FROM (SELECT DISTINCT {key}, text FROM {source}))
            WHERE len(m) >= 5)))))"""


OP4_SQL = rf"""
WITH d AS (SELECT * FROM ({_template_sql("documents", "doc_id")}) WHERE form IS NOT NULL),
b AS (SELECT * FROM ({_template_sql("benchmark", "item_id")}) WHERE form IS NOT NULL AND words >= 3),
places AS (SELECT item_id, r AS it, pos AS item_pos, win, slots AS item_slots, plain, form AS item_form,
             row_number() OVER (PARTITION BY item_id, win ORDER BY form, slots, r, pos, plain) = 1 AS first FROM b),
items AS (
  SELECT p.*, n_windows, n_places FROM places AS p
  JOIN (SELECT item_id, count(*) AS n_windows FROM places WHERE first AND item_form = 1 GROUP BY item_id) AS s ON p.item_id IS NOT DISTINCT FROM s.item_id
  JOIN (SELECT item_id, it, count(*) AS n_places FROM places WHERE item_form = 1 GROUP BY item_id, it) AS m
    ON p.item_id IS NOT DISTINCT FROM m.item_id AND p.it = m.it),
met AS (SELECT doc_id, r, item_id, plain, n_windows, min(item_form) AS form
        FROM (SELECT DISTINCT doc_id, r, win FROM d) JOIN (SELECT DISTINCT item_id, win, plain, item_form, n_windows FROM items) USING (win) GROUP BY ALL),
found AS (SELECT doc_id, r, item_id, n_windows, count(*) AS n_matched, count(*) FILTER (form = 1) >= 0.8 * n_windows AS first_form
          FROM met GROUP BY doc_id, r, item_id, n_windows HAVING count(*) >= 0.8 * n_windows),
-- Windows of documents that may contain an item with slots, beside every place of that window in the item.
beside AS (
  SELECT f.r, f.item_id, f.first_form, i.it, i.item_pos, i.item_slots, i.item_form, i.first, i.n_places, d.slots, d.pos - i.item_pos AS off,
         greatest(1, n_places // 4) AS near
  FROM found AS f JOIN items AS i ON f.item_id IS NOT DISTINCT FROM i.item_id JOIN d ON d.r = f.r AND d.win = i.win
  WHERE EXISTS (SELECT 1 FROM items AS x WHERE x.item_slots <> '' AND x.item_id IS NOT DISTINCT FROM f.item_id)),
-- Occurrences: equal offsets, or offsets in one band of either kind; level -1 is the whole document.
grouped AS (
  SELECT r, item_id, it, level, CASE level WHEN 0 THEN off WHEN 1 THEN floor(off / near) ELSE floor((off + near // 2) / near) END AS spot,
         item_pos, n_places, item_slots, slots
  FROM beside, (VALUES (0), (1), (2)) AS l(level)),
pairs AS (
  SELECT r, item_id, it, level, spot, unnest(list_zip(string_split(item_slots, chr(1)), string_split(slots, chr(1)))) AS p
  FROM (SELECT r, item_id, it, level, spot, item_slots, slots FROM grouped
        UNION ALL SELECT r, item_id, 0, -1, 0, item_slots, slots FROM beside WHERE first AND (item_form = 1 OR NOT first_form))
  WHERE item_slots <> ''),
votes AS (
  SELECT r, item_id, it, level, spot, count(*) AS n_slots, sum(best) / sum(n) AS agreement FROM (
    SELECT r, item_id, it, level, spot, a, max(n) AS best, sum(n) AS n FROM (
      SELECT r, item_id, it, level, spot, p[1] AS a, p[2] AS b, count(*) AS n FROM pairs GROUP BY ALL)
    GROUP BY r, item_id, it, level, spot, a)
  GROUP BY r, item_id, it, level, spot),
held AS (SELECT r, item_id, it, level, spot FROM grouped GROUP BY r, item_id, it, level, spot, n_places HAVING count(DISTINCT item_pos) >= 0.8 * n_places),
whole AS (SELECT r, item_id, n_slots, agreement FROM votes WHERE level = -1),
best AS (
  SELECT r, item_id, max(coalesce(agreement, 1.0)) AS agreement
  FROM (SELECT held.r, held.item_id, agreement FROM held LEFT JOIN votes ON votes.r = held.r AND votes.item_id IS NOT DISTINCT FROM held.item_id AND votes.it = held.it
    AND votes.level = held.level AND votes.spot = held.spot)
  GROUP BY ALL)
SELECT f.doc_id, f.item_id, f.n_windows, max(f.n_matched) AS n_matched, CAST(max(coalesce(w.n_slots, 0)) AS BIGINT) AS n_slots
FROM found AS f LEFT JOIN whole AS w ON f.r = w.r AND f.item_id IS NOT DISTINCT FROM w.item_id
LEFT JOIN best ON f.r = best.r AND f.item_id IS NOT DISTINCT FROM best.item_id
WHERE w.agreement IS NULL OR greatest(w.agreement, coalesce(best.agreement, 0)) >= 0.8
GROUP BY f.doc_id, f.item_id, f.n_windows
"""


#: URL rules (host and path), and listed hosts: these names under each domain.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
LISTED_NAMES = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_DOMAINS = ["example.com", "example.net", "example.org"]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = spark.createDataFrame([(f"{n}.{d}",) for n in LISTED_NAMES for d in LISTED_DOMAINS], "host string")
    return bloom_cascade.judge(table(spark, sf_dir, "pages"), RULES, hosts)


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (SELECT * FROM (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
      ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')) AS t(h, pre, rule, verdict)),
l AS (SELECT n || '.example.' || d AS h FROM (VALUES ('adult-x'), ('ads-track'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) AS a(n),
      (VALUES ('com'), ('net'), ('org')) AS b(d))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM (
  SELECT p.*, (SELECT rule FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) ORDER BY length(rule) DESC LIMIT 1) AS rule,
         (SELECT r.verdict FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) ORDER BY length(rule) DESC LIMIT 1) AS verdict,
         EXISTS (SELECT 1 FROM l WHERE host = l.h OR ends_with(host, '.' || l.h)) AS bad
  FROM p)
"""


#: Domains of the labelled table and their wanted shares of the tokens.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END"
SHARES = {"good": 0.80, "poor": 0.15, "toxic": 0.05}


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains, steps, features, targets, totals = mixing.plan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.expr(DOMAIN), SHARES)
    posterior = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(domains.names)]
    absent = [F.lit(0.0).alias(f"p_{name}") for name in sorted(SHARES) if name not in domains.names]
    return features.select("doc_id", F.col("n").alias("n_tokens"), *posterior, *absent,
                           mixing.rate_column(steps, F.col("p")).alias("rate"))


def op7_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jump_shard.assign(table(spark, sf_dir, "documents"), shards=40)
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"), held_out=crc_of_id() % 5 == 1, class_col="lang")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id() % 3 == 1
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, "text", F.col("doc_id"), held_out.alias("held_out"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.fp_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_of_id() % 3 == 1
    model = quality.fit(docs.where(~held_out), table(spark, sf_dir, "labels"), F.col("quality"))
    return quality.score(docs, model, "text", F.col("doc_id"), held_out.alias("held_out"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"), least=100, most_words=5, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: All phrases of 1 to 5 words as text, all cuts, and containment as text.
OP13_SQL = r"""
WITH w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
f AS (
  SELECT lang, k, ws[i:i + k - 1] AS p, count(*) AS f
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) AS s(k) WHERE len(ws) >= k)
  GROUP BY lang, k, p),
t AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k >= 2 AND f >= 100),
closed AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c AS b WHERE b.lang = c.lang AND b.k > c.k AND 100 * b.f >= 100 * c.f
      AND contains(' ' || array_to_string(b.p, ' ') || ' ', ' ' || array_to_string(c.p, ' ') || ' '))),
cuts AS (
  SELECT lang, p, k, f, unnest(range(1, k)) AS cut FROM closed),
scored AS (
  SELECT cuts.lang, cuts.p, cuts.f AS a, cut, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * cuts.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN t ON t.lang = cuts.lang
  JOIN f AS x ON x.lang = cuts.lang AND x.p = cuts.p[1:cut]
  JOIN f AS y ON y.lang = cuts.lang AND y.p = cuts.p[cut + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
named AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       n::BIGINT AS n, score::BIGINT AS score
FROM named QUALIFY rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_merkle_fingerprints": op2_merkle_fingerprints,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_template_decontamination": op4_template_decontamination,
        "op5_url_filter": op5_url_filter,
        "op6_soft_mixing": op6_soft_mixing,
        "op7_jump_sharding": op7_jump_sharding,
        "op8_lattice_scores": op8_lattice_scores,
        "op9_language_id": op9_language_id,
        "op10_simhash": op10_simhash,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_quality_classifier": op12_quality_classifier,
        "op13_phrase_mining": op13_phrase_mining,
    }


def sql() -> dict[str, str]:
    return {
        "op1_license_scan": _op1_sql(),
        "op3_substring_dedup": OP3_SQL,
        "op4_template_decontamination": OP4_SQL,
        "op5_url_filter": OP5_SQL,
        "op13_phrase_mining": OP13_SQL,
    }
