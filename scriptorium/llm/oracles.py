"""SQL of the registered queries, for DuckDB; constants are written out here on purpose."""

from __future__ import annotations

_SQL: dict[str, str] = {}

_SQL["op4_sharding"] = r"""
WITH d AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
        CAST('0x' || substr(md5(doc_id || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
    FROM documents
), b AS (
    SELECT doc_id, n_bytes, d AS depth, h >> (60 - d) AS prefix, sum(n_bytes) OVER (PARTITION BY d, h >> (60 - d)) AS total
    FROM (SELECT *, unnest(range(0, 31)) AS d FROM d)
)
SELECT doc_id, n_bytes,
    CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard, CAST(0 AS BIGINT) AS copy,
    CAST(total AS BIGINT) AS shard_bytes
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS n FROM b WHERE total <= 1000000) WHERE n = 1
"""

_SQL["op5_warc"] = r"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept
    FROM pages
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
        1 + ((CAST('0x' || hex[5 * i // 4 + 1:5 * i // 4 + 2] AS INTEGER) >> (3 - 5 * i % 4)) & 31)]), '') AS payload_digest,
    CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM p
"""

_SQL["op6_perspectives"] = r"""
WITH t AS (
    SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text, CAST(floor(turn / 32) AS BIGINT) AS part FROM conversations
), s AS (
    SELECT t.*, p.participant, '<|im_start|>' || CASE WHEN role = p.participant THEN 'assistant' WHEN role = 'system' THEN 'system'
        ELSE 'user name=' || coalesce(role, 'unknown') END || chr(10) AS head
    FROM t JOIN (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system') p USING (conv_id)
), r AS (
    SELECT *, sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, participant, part ORDER BY turn, role, text) AS upto FROM s
)
SELECT conv_id, participant, part, CAST(0 AS BIGINT) AS piece, CAST(count(*) AS INTEGER) AS n_turns,
    string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text,
    coalesce(string_agg(CASE WHEN role = participant THEN CAST(upto - 11 - length(text) AS VARCHAR) || ':' || CAST(upto - 11 AS VARCHAR) END,
        ',' ORDER BY turn, role, text), '') AS spans
FROM r GROUP BY conv_id, participant, part
"""

_SQL["op7_jaccard_join"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS k FROM d
), e AS (
    SELECT doc_id, len(k) AS n, unnest(k) AS g FROM s
), linked AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
        AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM s
    UNION
    SELECT r.x, l.y FROM reach r JOIN linked l ON r.y = l.x
)
SELECT s.doc_id, CAST(len(k) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM s JOIN reach r ON s.doc_id = r.x GROUP BY s.doc_id, len(k)
"""

_SQL["op8_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win)
    WHERE n > 1
), gone AS (
    SELECT doc_id, list(DISTINCT p) AS g FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM later) GROUP BY doc_id
), kept AS (
    SELECT d.doc_id, len(w) AS n, coalesce(len(g), 0) AS r,
        list_transform(list_filter(range(1, len(w) + 1), lambda i: g IS NULL OR NOT list_contains(g, i)), lambda i: w[i]) AS k
    FROM d LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed,
    sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""

_SQL["op9_decontaminate"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS k
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), occ AS (
    SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (
    SELECT doc_id, item_id, s, occ.n FROM occ JOIN win USING (n, k)
), places AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id
), ids AS (
    SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

_SQL["op12_lexical"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), a AS (
    SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM d WHERE len(w) > 0
), t AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
), f AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, a GROUP BY term, n_docs
), i AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (
    SELECT item_id, r, doc_id,
        CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * n_docs) // n_all)))) AS BIGINT) AS score
    FROM i JOIN t USING (term) JOIN f USING (term) JOIN d USING (r), a GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS n FROM s WHERE score > 0) WHERE n <= 50
"""


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
