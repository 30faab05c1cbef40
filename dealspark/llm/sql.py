"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

# Function words that the stop-word rule counts, in small letters and with a capital.
STOP = sorted({f for w in (
    "the of and to a in is that it for on was with be as this by at are from der die und den von zu das mit sich auf "
    "des für ist im nicht dem ein eine als de la le et les en un du une que est pour qui dans au sur par pas avec el y "
    "los se del las por con no para su es al lo una").split() for f in (w, w.capitalize())})
STOP_LIST = ", ".join(f"'{w}'" for w in STOP)

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
top AS (SELECT hex, max(page_id) AS last FROM d GROUP BY hex),
five AS (SELECT page_id, g, ('0x' || substr(hex, (5 * g + 1)::INTEGER, 5))::BIGINT AS bits
  FROM d, (SELECT range AS g FROM range(8))),
coded AS (SELECT page_id, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((bits >> 15) & 31) + 1)::INTEGER, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((bits >> 10) & 31) + 1)::INTEGER, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((bits >> 5) & 31) + 1)::INTEGER, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((bits & 31) + 1)::INTEGER, 1), '' ORDER BY g) AS payload_digest
  FROM five GROUP BY page_id)
SELECT d.page_id, payload_bytes, payload_digest,
  CASE WHEN last > d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last > d.page_id THEN last END AS refers_to
FROM d JOIN top ON d.hex = top.hex JOIN coded ON d.page_id = coded.page_id
"""

OP5 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS words,
    coalesce(lower(lang) IN ('en', 'de', 'fr', 'es'), true) AS listed FROM documents),
w AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM t),
g AS (SELECT doc_id, i, w, lead(w, 1) OVER s AS w1, lead(w, 2) OVER s AS w2 FROM w WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, CASE WHEN w2 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, w1, w2) > 1 THEN 1 ELSE 0 END AS again FROM g),
c AS (SELECT doc_id, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM r),
n AS (SELECT doc_id, sum(covered)::BIGINT AS n_repeat_words FROM c GROUP BY doc_id),
l AS (SELECT doc_id, [x for x in string_split(text, chr(10)) if regexp_matches(x, '{WORD}')] AS lines FROM t),
m AS (SELECT t.doc_id, listed, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len([x for x in words if x IN ({STOP_LIST})])::BIGINT AS n_stop
  FROM t JOIN l ON t.doc_id = l.doc_id LEFT JOIN n ON t.doc_id = n.doc_id),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words AND n_symbols <= 0.1 * n_words
    AND (n_stop >= 0.02 * n_words OR NOT listed) AND n_dup_lines <= 0.5 * n_lines AS kept
FROM v
"""

OP6 = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS words FROM documents),
i AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS s FROM t WHERE len(words) >= 50),
win AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS key FROM i),
low AS (SELECT key, min(doc_id) AS first FROM win GROUP BY key),
hit AS (SELECT win.doc_id, s FROM win JOIN low ON win.key = low.key WHERE first < win.doc_id),
w AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM t),
mark AS (SELECT w.doc_id, w.i, w.w, max(CASE WHEN hit.s IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM w LEFT JOIN hit ON hit.doc_id = w.doc_id AND hit.s = w.i),
kept AS (SELECT doc_id, count(*) AS n, sum(gone) AS gone,
    coalesce(string_agg(w, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS rest FROM mark GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id
"""

OP9 = """
WITH u AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
    ELSE substr(url, (strpos(url, '://') + 3)::INTEGER) END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host || path, '(?i)(^|[^a-z0-9])(adult|porn|xxx|casino|gambling|warez|phishing|malware)([^a-z0-9]|$)')
      OR regexp_matches(host || path, '(?i)/(login|signin|logout|cart|checkout)(/|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""

SQL: dict[str, str] = {"op2_warc": OP2, "op5_quality_rules": OP5, "op6_substring_dedup": OP6, "op9_url_filters": OP9}
