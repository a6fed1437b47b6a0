"""The same results in SQL, where SQL can express them.

Language identification, perplexities, sharding (CRC-32), tokens, whitening and the removal of
fuzzy passages are tested against brute force, held-out accuracy or an exact round trip instead.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "[\\x20\\x09-\\x0D]+"

_DECONTAMINATION = f"""
WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all({_LOWER.format("text")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
    FROM benchmark
),
windows AS (
    SELECT DISTINCT item, w[i:i + least(10, len(w)) - 1] AS win
    FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i)
    WHERE len(w) > 0
),
doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all({_LOWER.format("coalesce(text, '')")},
                              '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
    FROM documents
),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
found AS (
    SELECT r, i, n, item
    FROM (SELECT r, i, n, w[i:i + n - 1] AS win
          FROM doc, sizes, unnest(range(1, len(w) - n + 2)) AS t(i))
    JOIN windows USING (win)
),
hit AS (
    SELECT r, count(DISTINCT i + k) AS n_hit
    FROM (SELECT DISTINCT r, i, n FROM found), unnest(range(0, n)) AS t(k)
    GROUP BY r
),
items AS (
    SELECT r, count(DISTINCT item) AS n_items,
           string_agg(DISTINCT item, ',' ORDER BY item) AS ids
    FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_NORM = f"trim(regexp_replace({_LOWER.format('line')}, '{_SPACE}', ' ', 'g'), ' ')"
_HAS_WORD = "regexp_matches(line, '[^\\x20\\x09-\\x0D]')"

_QUALITY = f"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS host,
           coalesce(text, '') AS t, text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
line AS (
    SELECT r, doc_id, host, text, line, {_NORM} AS norm
    FROM (SELECT r, doc_id, host, text, unnest(string_split(t, chr(10))) AS line FROM doc
          WHERE text IS NOT NULL)
    WHERE {_HAS_WORD}
),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM line GROUP BY r),
windows AS (SELECT r, i, w[i:i + 4] AS win FROM doc, unnest(range(1, len(w) - 3)) AS t(i)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
repeats AS (
    SELECT r, count(DISTINCT i + k) AS n FROM again, unnest(range(0, 5)) AS t(k) GROUP BY r
),
totals AS (SELECT host, count(DISTINCT coalesce(text, chr(0))) AS documents FROM doc GROUP BY host),
common AS (
    SELECT host, norm FROM line JOIN totals USING (host)
    GROUP BY host, norm, documents
    HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.05 * documents
),
gone AS (
    SELECT r, count(*) AS n,
           sum(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))) AS words
    FROM line JOIN common USING (host, norm) GROUP BY r
),
judged AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           length(regexp_replace(t, '{_SPACE}', '', 'g')) AS word_chars,
           length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
           coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
           coalesce(gone.n, 0) AS n_common_lines,
           CAST(len(w) - coalesce(gone.words, 0) AS BIGINT) AS n_words_left,
           gone.n IS NOT NULL AS changed
    FROM doc LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN gone USING (r)
)
SELECT * EXCLUDE (changed),
       NOT base_failed AND NOT (changed AND (n_words_left < 10 OR n_words_left < 0.3 * n_words))
           AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM judged)
"""

_NEAR = f"""
WITH RECURSIVE doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
shingle AS (
    SELECT DISTINCT r, w[i:i + 3] AS s
    FROM doc, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sized AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r
),
link AS (
    SELECT a, b FROM common JOIN sized x ON x.r = a JOIN sized y ON y.r = b
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
    SELECT DISTINCT a AS r, a AS other FROM both_ways
    UNION
    SELECT reach.r, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
),
smallest AS (
    SELECT reach.r, min(o.doc_id) AS component_id
    FROM reach JOIN doc o ON o.r = reach.other GROUP BY reach.r
)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
       coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM doc LEFT JOIN sized USING (r) LEFT JOIN smallest USING (r)
"""

# Addresses are spelled in one way by the program; the index key is compared in tests.
_WARC = """
WITH page AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
),
first AS (
    SELECT *, CASE WHEN payload_bytes >= 100
                   THEN min(page_id) OVER (PARTITION BY payload_digest) END AS smallest
    FROM page
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN smallest IS NOT NULL AND page_id IS DISTINCT FROM smallest
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM smallest THEN smallest END AS refers_to
FROM first
"""

_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, row_number() OVER () AS r,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(v AS DOUBLE)) FOR v IN embedding] AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0
),
commonest AS (
    SELECT len(x) AS d FROM usable WHERE len(x) > 0
    GROUP BY d ORDER BY count(*) DESC, d DESC LIMIT 1
),
vec AS (SELECT usable.* FROM usable JOIN commonest ON len(x) = d),
scored AS (
    SELECT a.r AS ar, a.vec_id AS anchor_id, o.r, o.vec_id, a.label = o.label AS same,
           CAST(list_dot_product(a.x, o.x) AS BIGINT) AS score
    FROM vec a JOIN vec o ON a.r <> o.r
    WHERE a.vec_id % 50 = 0
),
positive AS (
    SELECT ar, anchor_id, r AS pr, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, r) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (
           PARTITION BY p.ar, pr ORDER BY n.score DESC, n.vec_id, n.r) AS INTEGER) AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.ar = p.ar AND NOT n.same
    AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY rank <= 3
"""

STATEMENTS: dict[str, str] = {
    "op1_benchmark_decontamination": _DECONTAMINATION,
    "op3_quality_rules": _QUALITY,
    "op4_minhash_near_dedup": _NEAR,
    "op8_warc_archives": _WARC,
    "op13_hard_negatives": _NEGATIVES,
}
