"""DuckDB SQL for the corpus queries that SQL can express, written over the tables without the library."""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LINE_KEY = LOWERED.format(f"trim(line, {SPACES})")

LINES = f"""
docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM docs),
placed AS (SELECT doc_id, source, text, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split),
lines AS (SELECT *, {LINE_KEY} AS key FROM placed)"""

LINE_DEDUP = f"""
WITH {LINES},
repeated AS (
  SELECT key, min(doc_id) AS keeper FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, line, place, coalesce(doc_id <> keeper, false) AS dropped
  FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH {LINES},
words AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS w FROM docs),
windows AS (
  SELECT doc_id, unnest(range(len(w) - 7)) AS place,
         unnest(list_transform(range(len(w) - 7), lambda i: array_to_string(w[i + 1 : i + 8], ' '))) AS words
  FROM words WHERE len(w) >= 8),
twice AS (SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
steps AS (
  SELECT doc_id, least(8, coalesce(place - lag(place) OVER (PARTITION BY doc_id ORDER BY place), 8)) AS n FROM twice),
repeats AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM steps GROUP BY doc_id),
own AS (
  SELECT doc_id, count(*) FILTER (WHERE has) - count(DISTINCT line) FILTER (WHERE has) AS n_dup_lines
  FROM (SELECT doc_id, line, regexp_matches(line, '{WORD}') AS has FROM lines) GROUP BY doc_id),
keyed AS (SELECT * FROM lines WHERE key <> ''),
hosts AS (SELECT source, count(DISTINCT doc_id) AS host_docs FROM keyed GROUP BY source),
held AS (SELECT source, key, count(DISTINCT doc_id) AS n, count(DISTINCT text) AS n_texts FROM keyed GROUP BY source, key),
above AS (
  SELECT source, key FROM held JOIN hosts USING (source) WHERE n_texts > 1 AND n > CAST(0.02 AS DOUBLE) * host_docs),
gone AS (SELECT doc_id, sum(length(key)) AS chars FROM keyed JOIN above USING (source, key) GROUP BY doc_id),
figures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(chars, 0) AS gone_chars, length(text) AS n_text
  FROM words JOIN own USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR gone_chars > CAST(0.5 AS DOUBLE) * n_text) AS kept
FROM judged
"""

JACCARD = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 3), lambda i: array_to_string(w[i + 1 : i + 4], ' ')) END) AS shingle
  FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

DIGIT = "(strpos('0123456789abcdef', substr(h || '0', (5 * i) // 4 + {0}, 1)) - 1)"
BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"1 + (((({DIGIT.format(1)} * 16 + {DIGIT.format(2)}) >> (3 - (5 * i) % 4)) & 31))::INT, 1)), '')"
)

WARC = f"""
WITH hashed AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM hashed)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM first
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{ITEM_WORD}') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{ITEM_WORD}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, unnest(list_transform(range(len(w) - size + 1), lambda i: array_to_string(w[i + 1 : i + size], ' '))) AS words
  FROM (SELECT item, w, least(len(w), 10) AS size FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT r, size, unnest(range(len(w) - size + 1)) AS place,
         unnest(list_transform(range(len(w) - size + 1), lambda i: array_to_string(w[i + 1 : i + size], ' '))) AS words
  FROM docs CROSS JOIN sizes WHERE len(w) >= size),
hits AS (SELECT r, place, size, item FROM places JOIN windows USING (size, words)),
words AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(place, place + size)) AS word FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

SQL = {"op2_jaccard_join": JACCARD, "op4_line_dedup": LINE_DEDUP, "op6_quality_rules": QUALITY, "op10_warc": WARC, "op13_decontamination": DECONTAMINATION}
