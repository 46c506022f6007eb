"""DuckDB twins of the queries that SQL can express over whole tables."""

from __future__ import annotations

WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
#: Lower case for ASCII letters alone.
LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
FOLDED = r"list_filter(string_split_regex(" + LOWER + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
TEXT = "coalesce(text, '')"

QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {TEXT} AS t, {WORDS.format(text=TEXT)} AS w FROM documents
), grams AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5
), keyed AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM grams
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM keyed) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r
), facts AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(c.n, 0) AS n_repeat_words,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper
  FROM d LEFT JOIN covered c USING (r)
), counted AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM facts
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR NOT (word_chars BETWEEN 2 * n_words AND 20 * n_words) OR 10 * n_symbols > n_words
    OR 2 * n_dup_lines > len(lines) OR 2 * n_upper > word_chars) AS kept
FROM counted"""

DECONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {FOLDED.format(text=TEXT)} AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, {FOLDED.format(text=TEXT)} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), grams AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), found AS (
  SELECT r, i, g.size, item_id FROM grams g JOIN windows USING (g, size)
), hit AS (
  SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(size)) AS k FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r
), items AS (
  SELECT r, list_sort(list(DISTINCT item_id)) AS items FROM found WHERE item_id IS NOT NULL GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""

LM_SCORE = f"""
WITH t AS (
  SELECT doc_id, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS u
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, {WORDS.format(text=TEXT)} AS w FROM documents))
), c AS (
  SELECT w, count(*) AS n FROM t GROUP BY w
), p AS (
  SELECT u, w, count(*) AS n FROM t WHERE u IS NOT NULL GROUP BY u, w
), scored AS (
  SELECT doc_id, count(*) AS n_words, sum(CASE
    WHEN p.n IS NOT NULL THEN ln(p.n / cu.n)
    WHEN t.u IS NULL THEN ln(cw.n / (SELECT sum(n) FROM c))
    ELSE ln(0.4::DOUBLE * cw.n / (SELECT sum(n) FROM c)) END) AS s
  FROM t JOIN c cw ON cw.w = t.w LEFT JOIN p ON p.u = t.u AND p.w = t.w LEFT JOIN c cu ON cu.w = t.u GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, round(coalesce(s, 0.0), 4) AS log_prob, round(s / n_words, 6) AS score
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN scored USING (doc_id)"""

#: Ten hexadecimal digits are forty bits, or eight base32 digits.
BASE32 = "array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', " \
    "(((('0x' || substr({hex}, (k // 8 * 10 + 1)::INT, 10))::BIGINT >> ((7 - k % 8) * 5)::INT) & 31) + 1)::INT, 1)), '')"
WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, url FROM pages
), h AS (
  SELECT page_id, url, octet_length(encode(payload)) AS payload_bytes, upper(sha1(payload)) AS hex FROM p
), f AS (
  SELECT hex, min(page_id) AS first FROM h GROUP BY hex
), u AS (
  SELECT *, lower(regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/@]*@)?(www\\.)?', ''), '#.*$', '')) AS rest
  FROM h JOIN f USING (hex)
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {BASE32.format(hex="hex")} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  coalesce(array_to_string(list_reverse(string_split(regexp_extract(rest, '^([^/?:]*)', 1), '.')), ',') || ')' ||
    CASE WHEN regexp_extract(rest, '^[^/?]*(.*)$', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?]*(.*)$', 1) END, '') AS url_key,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y%m%d%H%M%S') AS timestamp
FROM u"""

FILTER_AUDIT = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, {TEXT} AS t, {WORDS.format(text=TEXT)} AS w FROM documents
), m AS (
  SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), c AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)
), orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS prior
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
)
SELECT part, filter_order, step::INT AS step,
  coalesce(sum(n) FILTER (mask & (bit | prior) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & prior = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & prior <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & prior = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & prior = 0), 0)::BIGINT AS toxic_lost,
  sum(CASE WHEN mask & bit <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
FROM c, steps GROUP BY part, filter_order, step, bit"""

ORACLE = {
    "op4_quality_rules": QUALITY_RULES,
    "op7_decontamination": DECONTAMINATION,
    "op8_lm_score": LM_SCORE,
    "op10_warc": WARC,
    "op12_filter_audit": FILTER_AUDIT,
}
