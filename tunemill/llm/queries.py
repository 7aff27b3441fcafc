"""The registered queries of this subpackage and the SQL that checks those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.llm import counts, languages, linededup, merkle, multiset, packing, quality, ranked, rans, simhash, transducer, urls, warc
from tunemill.llm.common import written

GROUPS = ["lang", "source"]
RULES = """SELECT * FROM VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS rules(host, path, verdict)"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_packages(_table(spark, sf_dir, "pages"), warc.package_folder(spark))
    return warc.read_records(manifest).drop("url")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", *GROUPS, "text")
    counted = written(quality.with_counts(docs).drop("text"), "quality-counts")
    kept = quality.judged(counted, quality.thresholds(counted, GROUPS), GROUPS)
    return kept.select("doc_id", *[F.col(f"q.{c}") for c in quality.COUNTS if c != "n_lines"], "base_failed", "kept")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), spark.sql(RULES))


def op5_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.fingerprints(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return transducer.round_trip(_table(spark, sf_dir, "documents"), path)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return rans.read_documents(rans.write_files(_table(spark, sf_dir, "documents"), rans.token_folder(spark), path))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.clustered(_table(spark, sf_dir, "documents"), words_each=4, radius=4)


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.predicted(_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.deduplicated(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    shown = merkle.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.replace("text", F.lit("\n"), F.lit("")))
    return merkle.verified(docs, F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, shown))


QUERIES = {f.__name__: f for f in (op1_zip_archives, op2_quality_rules, op3_token_counts, op4_url_rules, op5_multiset_fingerprints,
                                   op6_byte_bpe, op7_token_files, op8_simhash, op9_best_fit, op10_languages, op11_line_dedup, op12_ranked_search, op13_merkle_proofs)}

_WORD = r"[^\x20\x09-\x0D]"


def _level(name: str, columns: str) -> str:
    """Fences of one level of groups, from merged sketches."""
    by = f"PARTITION BY {columns}measure"
    fence = " ".join(f"WHEN '{m}' THEN greatest({least}, (q3 - q1) * {times})" for m, (_, _, times, least, _) in quality.FENCES.items())
    share = lambda i: "CASE measure " + " ".join(f"WHEN '{m}' THEN {f[i]}" for m, f in quality.FENCES.items()) + " END"
    highs = ", ".join(f"max(q3 + fence) FILTER (measure = '{m}') AS high_{m}" for m in quality.FENCES)
    lows = ", ".join(f"max(q1 - fence) FILTER (measure = '{m}') AS low_{m}" for m, f in quality.FENCES.items() if f[4])
    largest = lambda b: f"((({b} - greatest({b} // 32 - 1, 0) * 32 + 1) << greatest({b} // 32 - 1, 0)) - 1)"
    return f"""
{name} AS (
  SELECT {columns} max(docs) AS docs, {highs}, {lows} FROM (
    SELECT *, CASE measure {fence} END AS fence FROM (
      SELECT {columns} measure, max(docs) AS docs, {largest(f"min(b) FILTER (upto * 100 >= docs * {share(0)})")} AS q1,
             {largest(f"min(b) FILTER (upto * 100 >= docs * {share(1)})")} AS q3
      FROM (SELECT *, sum(n) OVER ({by}) AS docs, sum(n) OVER ({by} ORDER BY b) AS upto
            FROM (SELECT {columns} measure, b, sum(n) AS n FROM sketch GROUP BY ALL))
      GROUP BY ALL)) GROUP BY ALL)"""


def _limit(column: str) -> str:
    own = " ".join(f"WHEN t{d}.docs >= {quality.MIN_DOCS} THEN t{d}.{column}" for d in (0, 1))
    return f"CASE {own} ELSE t2.{column} END"


_QUALITY_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
windows AS (SELECT r, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS s
            FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS p FROM w)),
again AS (SELECT r, p FROM (SELECT *, count(*) OVER (PARTITION BY r, s) AS c FROM windows) WHERE c > 1),
repeats AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY r),
counted AS (
  SELECT w.r, doc_id, lang, source, len(ws) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats USING (r)),
based AS (SELECT *, n_words < {quality.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality.MAX_REPEAT_PERCENT} AS base_failed,
                 n_symbols * 1000 // greatest(n_words, 1) AS m_symbols, n_dup_lines * 1000 // greatest(n_lines, 1) AS m_dup_lines,
                 n_repeat_words * 1000 // greatest(n_words, 1) AS m_repeats, word_chars * 100 // greatest(n_words, 1) AS m_word_length
          FROM counted),
sketch AS (
  SELECT lang, source, measure, sh * 32 + (v >> CAST(sh AS BIGINT)) AS b, count(*) AS n FROM (
    SELECT lang, source, x.m AS measure, x.v AS v, greatest(length(bin(x.v)) - 6, 0) AS sh FROM (
      SELECT lang, source, unnest([{{'m': 'symbols', 'v': m_symbols}}, {{'m': 'dup_lines', 'v': m_dup_lines}},
                                   {{'m': 'repeats', 'v': m_repeats}}, {{'m': 'word_length', 'v': m_word_length}}]) AS x
      FROM based WHERE NOT base_failed)) GROUP BY ALL),
{_level("t0", "lang, source, ")},
{_level("t1", "lang, ")},
{_level("t2", "")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND m_symbols <= {_limit("high_symbols")} AND m_dup_lines <= {_limit("high_dup_lines")}
       AND m_repeats <= {_limit("high_repeats")}
       AND m_word_length BETWEEN {_limit("low_word_length")} AND {_limit("high_word_length")} AS kept
FROM based LEFT JOIN t0 ON based.lang IS NOT DISTINCT FROM t0.lang AND based.source IS NOT DISTINCT FROM t0.source
LEFT JOIN t1 ON based.lang IS NOT DISTINCT FROM t1.lang LEFT JOIN t2 ON true"""

_URLS_SQL = """
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
numbered AS (SELECT row_number() OVER () AS r, * FROM parts),
best AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
         FROM numbered JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM numbered LEFT JOIN best USING (r)"""

_LINES_SQL = f"""
WITH l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p
           FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= {linededup.MIN_CHARS} GROUP BY key
           HAVING count(DISTINCT r) >= {linededup.MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT r, p, doc_id, line, keep IS NOT NULL AND doc_id < keep AS gone FROM k LEFT JOIN shared USING (key)) GROUP BY r, doc_id"""


_TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
_RANKED_SQL = f"""
WITH d AS (SELECT *, len(ts) AS n FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents) WHERE len(ts) > 0),
corpus AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, nd),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
           FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN d USING (r), corpus GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20"""


def _marks(*columns: str) -> str:
    value = "CAST({0} AS VARCHAR)"
    return " || ".join([f"coalesce(strlen({value}) || ':' || {value}, '-')".replace("{0}", c) for c in columns])


_MERKLE_SQL = f"""
WITH RECURSIVE
bits(n, k, c) AS (SELECT n, 0, n FROM range(256) AS x(n)
                  UNION ALL SELECT n, k + 1, xor(c >> 1, 3988292384 * (c & 1)) FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS tab FROM bits WHERE k = 8),
rows AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t, sha256({_marks("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
         sha256({_marks("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")}) AS shown,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0 AS tampered
  FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM rows),
sub(t, l, idx, h) AS (
  SELECT t, 0, idx, leaf FROM leaves UNION ALL
  SELECT t, l + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER (PARTITION BY t) AS c FROM sub)
  WHERE c > 1 GROUP BY t, l, idx // 3),
subroots AS (SELECT t, max(l) AS depth, arg_max(h, l) AS subroot FROM sub GROUP BY t),
top(l, idx, h) AS (
  SELECT 0, t, subroot FROM subroots UNION ALL
  SELECT l + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER () AS c FROM top) WHERE c > 1 GROUP BY l, idx // 3),
nodes AS (SELECT * FROM sub UNION ALL SELECT -1, l, idx, h FROM top),
steps AS (SELECT a.t, a.l, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lft,
                 coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
          FROM nodes a JOIN nodes b ON a.t = b.t AND a.l = b.l AND a.idx // 3 = b.idx // 3 GROUP BY a.t, a.l, a.idx),
climb(r, s, t, l, idx, own, sibs, depth) AS (
  SELECT doc_id, s.t, s.t, 0, idx, CASE WHEN tampered THEN shown ELSE leaf END, '', depth FROM leaves JOIN subroots s USING (t) UNION ALL
  SELECT r, s, CASE WHEN c.t >= 0 AND c.l + 1 = depth THEN -1 ELSE c.t END, CASE WHEN c.t >= 0 AND c.l + 1 = depth THEN 0 ELSE c.l + 1 END,
         CASE WHEN c.t >= 0 AND c.l + 1 = depth THEN s ELSE c.idx // 3 END, sha256(lft || own || rgt), sibs || lft || rgt,
         CASE WHEN c.t >= 0 AND c.l + 1 = depth THEN (SELECT max(l) FROM top) ELSE depth END
  FROM (SELECT r, s, CASE WHEN depth = 0 THEN -1 ELSE t END AS t, l, CASE WHEN depth = 0 THEN s ELSE idx END AS idx, own, sibs,
               CASE WHEN depth = 0 THEN (SELECT max(l) FROM top) ELSE depth END AS depth FROM climb WHERE t >= 0 OR l < depth) c
  JOIN steps p ON c.t = p.t AND c.l = p.l AND c.idx = p.idx),
ends AS (SELECT r, arg_max(own, length(sibs)) AS own, max_by(sibs, length(sibs)) AS sibs FROM climb GROUP BY r)
SELECT doc_id, leaf, subroot, (SELECT arg_max(h, l) FROM top) AS root, sha256(sibs) AS proof_sha256, own AS folded_root,
       own = (SELECT arg_max(h, l) FROM top) AS verified
FROM leaves JOIN subroots USING (t) JOIN ends ON r = doc_id"""

ORACLES: dict[str, str] = {"op12_ranked_search": _RANKED_SQL, "op11_line_dedup": _LINES_SQL, "op13_merkle_proofs": _MERKLE_SQL, "op2_quality_rules": _QUALITY_SQL, "op4_url_rules": _URLS_SQL}
