"""The SQL of benchmark decontamination, word by word instead of by passes over the line."""

from __future__ import annotations

from trendloom.llm.decontaminate import COVER, LEAST_PLAIN, NUMBER_WORDS, UNITS

EDGE = r"[^\p{L}\p{M}\p{N}]"

ORACLE = rf"""
WITH texts AS (
  SELECT 'doc' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'item', item_id, text FROM benchmark),
listed AS (
  SELECT side, id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'),
    lambda x: x <> '') AS ws FROM texts),
words AS (
  SELECT side, id, len(ws) AS n, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM listed),
kinds AS (
  SELECT *, lower(w) AS lw,
    CASE WHEN NOT regexp_matches(lag(w) OVER text, '[.!?:;]$')
      AND regexp_full_match(w, '{EDGE}*\p{{Lu}}\p{{Ll}}+(''s)?{EDGE}*') THEN 'name'
    WHEN regexp_full_match(lower(w), '{EDGE}*([0-9][0-9.,:/-]*|{"|".join(NUMBER_WORDS)}){EDGE}*')
    THEN 'number' END AS kind
  FROM words WINDOW text AS (PARTITION BY side, id ORDER BY p)),
slots AS (
  SELECT * REPLACE (CASE WHEN kind IS NULL AND lag(kind) OVER text = 'number'
      AND regexp_full_match(lw, '{EDGE}*({"|".join(UNITS)}){EDGE}*') THEN 'unit'
    ELSE kind END AS kind)
  FROM kinds WINDOW text AS (PARTITION BY side, id ORDER BY p)),
bare AS (SELECT *, regexp_replace(lw, '^{EDGE}+|{EDGE}+$', '', 'g') AS core FROM slots),
templates AS (
  SELECT *, CASE WHEN kind IS NOT NULL THEN '<' || kind || '>' WHEN core = '' THEN lw
    ELSE core END AS t, regexp_replace(core, '''s$', '') AS value FROM bare),
windows AS (
  SELECT side, id, n, p,
    t || ' ' || lead(t, 1) OVER text || ' ' || lead(t, 2) OVER text || ' '
      || lead(t, 3) OVER text || ' ' || lead(t, 4) OVER text AS win,
    count(*) FILTER (kind IS NULL) OVER (PARTITION BY side, id ORDER BY p
      ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS plain
  FROM templates WINDOW text AS (PARTITION BY side, id ORDER BY p)),
met AS (
  SELECT d.id AS doc_id, b.id AS item_id, b.n, d.p - b.p AS diagonal, b.p + j AS pos
  FROM windows d JOIN windows b ON d.win = b.win CROSS JOIN (SELECT unnest(range(5)) AS j)
  WHERE d.side = 'doc' AND b.side = 'item' AND b.plain >= {LEAST_PLAIN}),
pairs AS (
  SELECT DISTINCT m.*, b.kind, b.value AS was, d.value AS became
  FROM met m JOIN templates b ON b.side = 'item' AND b.id = m.item_id AND b.p = m.pos
  JOIN templates d ON d.side = 'doc' AND d.id = m.doc_id AND d.p = m.pos + m.diagonal),
consistent AS (
  SELECT doc_id, item_id, diagonal FROM pairs GROUP BY ALL
  HAVING count(DISTINCT (kind, was, became)) FILTER (kind IS NOT NULL)
    = count(DISTINCT (kind, was)) FILTER (kind IS NOT NULL))
SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS item_words,
  CAST(count(DISTINCT pos) AS INTEGER) AS covered_words,
  coalesce(bool_or(was <> became) FILTER (kind IS NOT NULL), false) AS slots_changed
FROM pairs JOIN consistent USING (doc_id, item_id, diagonal)
GROUP BY doc_id, item_id HAVING count(DISTINCT pos) >= {COVER} * any_value(n)
"""
