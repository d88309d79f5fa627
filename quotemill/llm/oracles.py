"""SQL of the results of those queries that SQL can express, for DuckDB."""

from __future__ import annotations

WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

OP1 = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST({WORDS} AS BIGINT) AS size,
         ('0x' || substr(md5('1/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || CAST({WORDS} AS VARCHAR)), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM sources),
filled AS (
  SELECT *, row_number() OVER w AS place,
         sum(cap) OVER w - cap AS caps_before, sum(weight) OVER w - weight AS weights_before
  FROM weighted WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
total AS (SELECT sum(source_size) AS words, sum(weight) AS weights FROM weighted),
level AS (
  SELECT min_by(CAST(words - caps_before AS DOUBLE) / CAST(weights - weights_before AS DOUBLE), place) AS l
  FROM filled, total
  WHERE cap >= weight * (CAST(words - caps_before AS DOUBLE) / CAST(weights - weights_before AS DOUBLE))),
shares AS (
  SELECT source, source_size, CASE WHEN cap < weight * l THEN CAST(cap AS DOUBLE) ELSE weight * l END AS target
  FROM weighted, level),
placed AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, CAST(floor(s.target) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
           - sum(d.size) OVER (PARTITION BY d.source, d.key) AS before,
         sum(d.size) OVER (PARTITION BY d.source, d.key) AS tied
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
    (budget // source_size) * size
    + CASE WHEN tied = 0 THEN 0
           ELSE floor(size * greatest(0, least(tied, budget % source_size - before)) / tied) END END AS BIGINT) AS taken
FROM placed
"""

OP2 = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
products AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
scored AS (
  SELECT query_id, vec_id, CAST(score AS BIGINT) AS score FROM products
  WHERE score BETWEEN -9223372036854775808 AND 9223372036854775807)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
WHERE r <= 5
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
         list_aggregate(list_transform(range(8), lambda i:
           list_aggregate(list_transform([15, 10, 5, 0], lambda s:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(hex, 1 + 5 * CAST(i AS INTEGER), 5))::INTEGER >> s) & 31), 1)), 'string_agg', '')),
           'string_agg', '') AS payload_digest,
         min(page_id) OVER (PARTITION BY payload) AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM d
"""

OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
       JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n
  HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))),
reach(x, y) AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(r.low, d.doc_id)) AS kept
FROM words d LEFT JOIN sizes s USING (doc_id)
     LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) r ON r.x = d.doc_id
"""

ORACLES = {"op1_mix_sources": OP1, "op2_exact_top_k": OP2, "op5_warc": OP5, "op6_near_dedup": OP6}
