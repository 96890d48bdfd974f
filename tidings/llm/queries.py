"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidings.llm import decontam, importance, jaccard, lm, mixing, periodic, quality, rules, secrets, simhash, substr, suffix, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": lambda spark, d: toxicity.digest(_documents(spark, d), _labels(spark, d)),
    "op2_quality": lambda spark, d: quality.digest(_documents(spark, d), _labels(spark, d)),
    "op3_lm": lambda spark, d: lm.digest(_documents(spark, d)),
    "op4_jaccard": lambda spark, d: jaccard.digest(_documents(spark, d)),
    "op5_mixing": lambda spark, d: mixing.digest(_documents(spark, d)),
    "op6_rules": lambda spark, d: rules.digest(_documents(spark, d)),
    "op7_decontam": lambda spark, d: decontam.digest(_documents(spark, d), _benchmark(spark, d)),
    "op8_secrets": lambda spark, d: secrets.digest(_documents(spark, d)),
    "op9_substr": lambda spark, d: substr.digest(_documents(spark, d)),
    "op10_suffix": lambda spark, d: suffix.digest(_documents(spark, d)),
    "op11_importance": lambda spark, d: importance.digest(_documents(spark, d), _benchmark(spark, d)),
    "op12_simhash": lambda spark, d: simhash.digest(_documents(spark, d)),
    "op13_periodic": lambda spark, d: periodic.digest(_documents(spark, d)),
}

_WORDS = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"

#: The language model, the classifiers, alignments, lexing, hashed choices and fingerprints can't be said in SQL; tests compare with brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
links AS (SELECT p.a, p.b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE c >= 0.8 * (na.n + nb.n - c) - 1e-9),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS class_id, (SELECT count(*) FROM links WHERE a = doc_id)::BIGINT AS n_links FROM w""",
    "op6_rules": rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
grams AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM grams) WHERE k > 1) GROUP BY 1),
lines AS (SELECT doc_id, source, regexp_replace(regexp_replace(lower(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[ \t\x0b\f\r]+', ' ', 'g'), '[0-9]+', '0', 'g') AS line FROM (SELECT doc_id, source, unnest(lines) AS x FROM w)),
frequent AS (SELECT source, line FROM lines WHERE line <> '' GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 50),
lost AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS n FROM lines JOIN frequent USING (source, line) GROUP BY 1),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (SELECT coalesce(count(*) - count(DISTINCT x), 0) FROM (SELECT unnest(lines) AS x) WHERE regexp_matches(x, '[^\x20\x09-\x0D]'))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN repeated r USING (doc_id) LEFT JOIN lost l USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept FROM m""",
    "op9_substr": rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
s AS (SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM s) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY 1),
kept AS (SELECT doc_id, list(words[p] ORDER BY p) AS ws FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM w) x WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM gone) g WHERE g.doc_id = x.doc_id AND g.p = x.p) GROUP BY 1)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(array_to_string(ws, ' '), '')) AS kept_sha256 FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op10_suffix": """
WITH w AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i - 1, 200)) AS win FROM (SELECT doc_id, h, unnest(range(1, n - 98)) AS i FROM w)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM s) WHERE r > 1),
marked AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS opens FROM later),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 99 AS b FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked) GROUP BY doc_id, k),
pieces AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS a, a - 1 AS b FROM runs UNION ALL SELECT doc_id, max(b) + 1, max(n) FROM runs JOIN w USING (doc_id) GROUP BY 1),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a - 1, 2 * (b - a + 1)), '' ORDER BY a) AS k FROM pieces JOIN w USING (doc_id) GROUP BY 1),
told AS (SELECT doc_id, sum(b - a + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY 1)
SELECT w.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256 FROM w LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_importance": r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
w AS (SELECT doc_id, true AS own, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents UNION ALL SELECT NULL, false, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (SELECT doc_id, own, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS x FROM w),
c AS (SELECT doc_id, own, x, count(*) AS n FROM f GROUP BY ALL),
b AS (SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(regexp_replace(hex(encode(x)), '(..)', '\1 ', 'g'), ' ')[:-2], lambda y: ('0x' || y)::BIGINT)), lambda c, y: xor(t[1 + (xor(c, y) & 255)], c >> 8)), 4294967295) % 10000 AS b FROM (SELECT DISTINCT x FROM c), crc),
s AS (SELECT b, sum(n) FILTER (own) AS s, sum(n) FILTER (NOT own) AS t FROM c JOIN b USING (x) GROUP BY 1),
g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM s)::DOUBLE + 10000))))::BIGINT AS gain FROM s),
m AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM c JOIN b USING (x) JOIN g USING (b) WHERE own GROUP BY 1),
o AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(coalesce(w, [])) AS n, ('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::BIGINT AS h FROM documents d JOIN w USING (doc_id) LEFT JOIN m USING (doc_id)),
r AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score, n >= 20 AS long FROM o),
k AS (SELECT *, row_number() OVER (PARTITION BY long ORDER BY score DESC, doc_id) AS k FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN long AND k <= 5 * (SELECT count(*) FROM r WHERE long) // 100 THEN k END AS rank FROM k""",
    "op13_periodic": r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda x, y: xor(t[1 + (xor(x, y) & 255)], x >> 8)), 4294967295) AS h FROM documents, crc),
a AS (SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM d),
o AS (SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM a),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i, len(w) AS n FROM o),
same AS (SELECT k.doc_id, k.i, l.i - k.i AS q FROM p k JOIN p l ON k.doc_id = l.doc_id AND k.x = l.x AND l.i > k.i AND 4 * (l.i - k.i) <= k.n),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM same) GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, n, min(q) AS q FROM stretches GROUP BY 1, 2, 3),
told AS (SELECT doc_id, count(*) AS n_runs, min({'n': -n, 's': s, 'q': q}) AS b, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS k FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, -b.n AS length, b.q AS period, (-1000 * b.n) // b.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256 FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
