"""SQL for the queries that SQL can express, run by an independent engine on the same tables."""

from __future__ import annotations

# Fixed value: the words of every operator.
_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH RECURSIVE
docs AS (
  SELECT doc_id, coalesce(source, chr(1) || 'none') AS source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) + 1 AS tokens,
         md5(concat_ws('|', 'mix', coalesce(doc_id::VARCHAR, ''))) AS k
  FROM documents),
sums AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY source),
shares AS (SELECT source, tokens, tokens / (SELECT sum(tokens) FROM sums) AS p FROM sums),
facts AS (SELECT count(*) AS n, max(p) AS top, min(p) AS least, -sum(p * ln(p)) AS h FROM shares),
by_entropy(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid,
               (SELECT ln(sum(pow(p, (lo + hi) / 2))) - (lo + hi) / 2 * sum(pow(p, (lo + hi) / 2) * ln(p)) / sum(pow(p, (lo + hi) / 2)) FROM shares)
               >= 0.95 * ln((SELECT n FROM facts)) AS ok
        FROM by_entropy WHERE i < 20)),
by_limit(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, (1 - (lo + hi) / 2) * ln((SELECT top / least FROM facts)) > ln(4.0) AS ok FROM by_limit WHERE i < 20)),
chosen AS (
  SELECT CASE WHEN n < 2 THEN 1.0 ELSE round(greatest(
    CASE WHEN h >= 0.95 * ln(n) THEN 1.0 ELSE (SELECT lo FROM by_entropy WHERE i = 20) END,
    CASE WHEN ln(top / least) <= ln(4.0) THEN 0.0 ELSE (SELECT hi FROM by_limit WHERE i = 20) END), 6) END AS a FROM facts),
weights AS (SELECT source, tokens, round(pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, chosen), 9) AS w FROM shares, chosen),
quotas AS (SELECT source, tokens, greatest(tokens, ceil(round((SELECT max(tokens / w) FROM weights) * w, 3))::BIGINT) AS quota FROM weights),
blocks AS (SELECT greatest(1, ceil(sum(quota) / 1048576.0))::BIGINT AS n FROM quotas),
plan AS (SELECT source, tokens AS total, quota, greatest(1, ceil(quota / n::DOUBLE))::BIGINT AS part FROM quotas, blocks),
placed AS (SELECT doc_id, source, tokens, (sum(tokens) OVER (PARTITION BY source ORDER BY k, doc_id, tokens ROWS UNBOUNDED PRECEDING) - tokens)::BIGINT AS start FROM docs),
copies AS (
  SELECT doc_id, source, tokens, unnest(range(0, (quota - 1) // total + 1)) AS copy, total, start, quota, part
  FROM placed JOIN plan USING (source)),
shown AS (SELECT *, copy * total + start AS pos FROM copies WHERE copy * total + start < quota)
SELECT block, row_number() OVER (PARTITION BY block ORDER BY md5(concat_ws('|', 'mix', block::VARCHAR, copy::VARCHAR, coalesce(doc_id::VARCHAR, ''))), doc_id, source, pos)::INTEGER AS place,
       copy::INTEGER AS copy, doc_id, nullif(source, chr(1) || 'none') AS source, tokens::BIGINT AS tokens
FROM (SELECT *, pos // part AS block FROM shown)
"""

OP6 = rf"""
WITH parts AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM parts WHERE len(w) >= 3),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM grams, range(0, 3) AS r(k) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM parts),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
metrics AS (
  SELECT p.doc_id, p.source, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM parts p LEFT JOIN covered c USING (doc_id) LEFT JOIN dups d USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM metrics),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INTEGER) AS failed FROM judged WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT m, greatest(2.0, least(1000.0, CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1000.0 END)) AS weight
  FROM (SELECT avg(failed / n) AS m, var_pop(failed / n) AS v FROM hosts)),
rates AS (SELECT source, (failed + m * weight) / (n + weight) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(rate, 0) <= 0.5 AS kept
FROM judged LEFT JOIN rates USING (source)
"""

OP7 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.doc_id, k.i, k.line, s.key IS NOT NULL AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


OP4 = rf"""
WITH parts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM parts WHERE len(w) >= 20),
seen AS (SELECT doc_id, i, row_number() OVER (PARTITION BY md5(array_to_string(w[i:i + 19], ' ')) ORDER BY doc_id, i) AS n FROM windows),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM seen, range(0, 20) AS r(k) WHERE n > 1),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM parts),
left_over AS (
  SELECT doc_id, count(*) FILTER (WHERE g.i IS NOT NULL) AS n_removed, string_agg(x, ' ' ORDER BY word.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM word LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM parts LEFT JOIN left_over USING (doc_id)
"""

OP5 = """
WITH payloads AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
last AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS last FROM payloads)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to, url
FROM last
"""

ORACLES = {"op1_mix_sources": OP1, "op4_substring_dedup": OP4, "op5_warc_index": OP5, "op6_quality_rules": OP6, "op7_line_dedup": OP7}
