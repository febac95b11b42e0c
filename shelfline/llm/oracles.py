"""SQL that the queries of this subpackage must agree with, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op2_warc_archives"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS largest FROM p),
b AS (SELECT *, list_transform(range(8), lambda g: CAST('0x' || substr(hex, 5 * g + 1, 5) AS INTEGER)) AS v FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((v[i // 4 + 1] >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM b
"""

ORACLES["op4_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (
    SELECT *, sqrt(list_inner_product(x, x)) AS norm FROM v
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND x IS NOT NULL AND len(x) > 0
      AND len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
pairs AS (
    SELECT a.r AS ra, b.r AS rb, a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
      ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r
    WHERE list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.93),
reach(r, other, id) AS (
    SELECT r, r, vec_id FROM v UNION SELECT reach.r, p.rb, p.b FROM reach JOIN pairs p ON reach.other = p.ra),
component AS (SELECT r, min(id) AS component_id FROM reach GROUP BY r),
links AS (SELECT ra AS r, count(*) AS n FROM pairs GROUP BY ra)
SELECT v.vec_id, coalesce(links.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN component USING (r) LEFT JOIN links USING (r)
"""

ORACLES["op9_chat_formatting"] = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, '<\|im_start\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>' AS control FROM c),
f AS (
    SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, control))
            + length(role) + length(role) - length(replace(role, '\', '')) + len(regexp_extract_all(role, control))
            + length(role) - length(replace(role, chr(10), '')) + 24 AS formatted FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLES["op10_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
t AS (
    SELECT r, i, w, lead(w) OVER x AS w2, lead(w, 2) OVER x AS w3 FROM w WINDOW x AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS c FROM t WHERE w3 IS NOT NULL),
again AS (
    SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM g WHERE c >= 2) GROUP BY r),
m AS (
    SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars, count(DISTINCT w) AS n_distinct,
           count(*) FILTER (WHERE regexp_matches(w, '[A-Za-z\x{80}-\x{10FFFF}]')) AS n_alpha FROM w GROUP BY r),
l AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
q AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           coalesce(n_dup, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
           coalesce(n_alpha, 0) AS n_alpha, coalesce(n_distinct, 0) AS n_distinct
    FROM d LEFT JOIN m USING (r) LEFT JOIN l USING (r) LEFT JOIN again USING (r)),
b AS (
    SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (n_words > 1000000)::INT
                 + 8 * (word_chars < 2 * n_words)::INT + 16 * (word_chars > 15 * n_words)::INT
                 + 32 * (10 * n_symbols > n_words)::INT + 64 * (2 * n_dup_lines > n_lines AND n_lines >= 6)::INT
                 + 128 * (10 * n_alpha < 7 * n_words)::INT
                 + 256 * (20 * n_distinct < n_words AND n_words < 2000)::INT AS BIGINT) AS failed FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed & 251 = 0 AS kept, failed
FROM b
"""

ORACLES["op11_chunk_recipes"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(plain) AS text_sha256
FROM d WINDOW w AS (PARTITION BY plain ORDER BY n DESC, doc_id NULLS LAST, r)
"""

ORACLES["op13_lexical_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, text FROM benchmark),
dt AS (
    SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
it AS (
    SELECT DISTINCT q, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
s AS (SELECT count(DISTINCT r) AS big_n, count(*) AS big_l FROM dt),
m AS (SELECT r, 100 - 50 + (50 * count(*) * any_value(big_n)) // any_value(big_l) AS m FROM dt, s GROUP BY r),
tf AS (SELECT r, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM it) GROUP BY r, term),
w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, s GROUP BY term),
scored AS (
    SELECT q, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM it JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, r),
ranked AS (
    SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= 50
"""
