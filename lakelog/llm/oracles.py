"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH line AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), keyed AS (
    SELECT doc_id, pos, line, translate(trim(line, {BLANK}), {LETTERS}) AS key FROM line
), shared AS (
    SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.owner AS gone
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = f"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{WORD}') AS w FROM documents
), item AS (
    SELECT item_id, w, least(10, len(w)) AS k FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{WORD}') AS w FROM benchmark)
    WHERE len(w) > 0
), pattern AS (
    SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS phrase
    FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM item)
), place AS (
    SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
          FROM doc, (SELECT DISTINCT k FROM pattern) WHERE len(w) >= k)
), found AS (
    SELECT DISTINCT place.doc_id, place.k, place.p, pattern.item_id
    FROM place JOIN pattern ON place.k = pattern.k AND place.phrase = pattern.phrase
), word AS (
    SELECT doc_id, count(DISTINCT p + i) AS n_hit
    FROM (SELECT doc_id, p, unnest(range(k)) AS i FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(x.n_hit, 0) AS n_hit,
       coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(x.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word x USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), place AS (
    SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS phrase
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM doc WHERE len(w) >= 13)
), first AS (
    SELECT phrase, min(doc_id) AS owner FROM place GROUP BY phrase HAVING count(DISTINCT doc_id) > 1
), gone AS (
    SELECT DISTINCT doc_id, p + i AS p
    FROM (SELECT place.doc_id, place.p, unnest(range(13)) AS i FROM place JOIN first USING (phrase)
          WHERE place.doc_id > first.owner)
), word AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), lost AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(l.n, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc d LEFT JOIN kept k USING (doc_id) LEFT JOIN lost l USING (doc_id)
"""

BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
WARC = f"""
WITH page AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), part AS (
    SELECT page_id, i, CAST('0x' || hex[5 * i + 1:5 * i + 5] AS BIGINT) AS v
    FROM (SELECT page_id, hex, unnest(range(8)) AS i FROM page)
), named AS (
    SELECT page_id, string_agg(
        substr({BASE32}, 1 + ((v >> 15) & 31), 1) || substr({BASE32}, 1 + ((v >> 10) & 31), 1)
        || substr({BASE32}, 1 + ((v >> 5) & 31), 1) || substr({BASE32}, 1 + (v & 31), 1), '' ORDER BY i) AS digest
    FROM part GROUP BY page_id
), ranked AS (
    SELECT page_id, html, min(page_id) OVER (PARTITION BY hex) AS first FROM page
)
SELECT r.page_id, CAST(strlen(r.html) AS BIGINT) AS payload_bytes, n.digest AS payload_digest,
       CASE WHEN r.page_id = r.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r.page_id <> r.first THEN r.first END AS refers_to
FROM ranked r JOIN named n USING (page_id)
"""

# all numbers are whole and below 2**53, so the double inner product is exact
HARD_NEGATIVES = """
WITH q AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM q a, q r WHERE a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pair WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negative AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
    FROM positive JOIN pair USING (anchor_id)
    WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 3
"""

ORACLES = {
    "op11_hard_negatives": HARD_NEGATIVES,
    "op3_warc": WARC,
    "op5_line_dedup": LINE_DEDUP,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op8_decontaminate": DECONTAMINATE,
}
