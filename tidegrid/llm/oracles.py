"""DuckDB SQL of the training-data queries that SQL can express on whole tables.

The others have none: op2 and op4 are trained or sampled models, op3 and op6
need a tokenizer, op7's draws are a hash that DuckDB lacks and its passes
depend on one another, and op9 is an image codec.  Those are tested against
plain versions of every column, round trips or held-out accuracy in tests/llm.
"""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, {_WORD}) AS ws, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols FROM d),
b AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols FROM w),
l AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT *, regexp_extract_all(line, {_WORD}) AS ws FROM l),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw WHERE len(ws) > 0 GROUP BY 1),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c >= 2),
rp AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM rep GROUP BY 1),
nl AS (SELECT doc_id, source, regexp_replace({_LOWER.format("array_to_string(ws, ' ')")}, '[0-9]', '0', 'g') AS norm, len(ws) AS k FROM lw WHERE len(ws) > 0),
f AS (SELECT source, norm FROM nl GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 20),
gone AS (SELECT doc_id, CAST(sum(k) AS BIGINT) AS removed_words, count(DISTINCT nl.norm) AS removed_lines FROM nl JOIN f ON f.norm = nl.norm AND f.source IS NOT DISTINCT FROM nl.source GROUP BY 1),
j AS (
  SELECT b.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0) AS removed_words, coalesce(removed_lines, 0) AS removed_lines
  FROM b LEFT JOIN dup USING (doc_id) LEFT JOIN rp USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= (1::DOUBLE / 3) * n_words AS kept, removed_words, removed_lines
FROM j
"""

OP5 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
  UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, min(y) AS y FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id, d.doc_id <= coalesce(c.y, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.x = d.doc_id
"""

OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(0, CAST(length(h) // 2 - 199 AS BIGINT))) AS s, h FROM d WHERE length(h) >= 400),
k AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 400)) AS m FROM p),
t AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY m) AS c FROM k) WHERE c > 1),
i AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 200 THEN 0 ELSE 1 END AS nw FROM t),
q AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM i),
r AS (SELECT doc_id, min(s) AS a, max(s) + 200 AS b FROM q GROUP BY doc_id, run),
kp AS (SELECT r.doc_id, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) AS f, a AS u FROM r UNION ALL SELECT r.doc_id, max(b), any_value(length(h) // 2) FROM r JOIN d USING (doc_id) GROUP BY 1),
kt AS (SELECT kp.doc_id, string_agg(substr(h, 2 * f + 1, 2 * (u - f)), '' ORDER BY f) AS kept FROM kp JOIN d USING (doc_id) GROUP BY 1),
rr AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM r GROUP BY 1)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN rr USING (doc_id) LEFT JOIN kt USING (doc_id)
"""

# CRC-32 by its byte table, itself made by the polynomial's rule; shards and sub-buckets by 13 digits of MD5.
OP10 = """
WITH RECURSIVE tb(i, k, v) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tb WHERE k < 8
),
tl AS (SELECT list(v ORDER BY i) AS tab FROM tb WHERE k = 8),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, length(h) // 2 + 1 AS size, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS bs FROM d),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, bs), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM b, tl),
kd AS (
  SELECT doc_id, j, -1.0 / ln((CAST('0x' || substr(md5(j || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS score
  FROM (SELECT DISTINCT doc_id FROM documents), range(17) r(j)
),
sh AS (SELECT doc_id, first(j ORDER BY score DESC, j) FILTER (WHERE j < 16) AS shard, first(j ORDER BY score DESC, j) AS grown FROM kd GROUP BY doc_id),
p AS (
  SELECT c.doc_id, size, crc, shard, grown,
         CAST('0x' || substr(md5(coalesce(CAST(c.doc_id AS VARCHAR), 'null') || ':' || crc), 1, 13) AS BIGINT) % greatest(1, CAST(ceil((SELECT count(*) FROM documents) / 320000) AS BIGINT)) AS sub
  FROM c JOIN sh ON sh.doc_id IS NOT DISTINCT FROM c.doc_id
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY sub, doc_id NULLS FIRST, crc, size) - 1 AS BIGINT) AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_frequency": OP1, "op5_hyperminhash": OP5, "op8_suffix_dedup": OP8, "op10_rendezvous_shards": OP10}
