"""DuckDB SQL for queries of the numbered operators, written from their contracts alone.

Each compares everything with everything that shares a key, which suits the tables of a correctness run, not a corpus: the operators
take other ways to the same rows.
"""

from __future__ import annotations

from candela.llm import linedup

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
starts AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM starts),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
spans AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM places),
hits AS (SELECT r, i, n, item FROM spans JOIN windows USING (n, words)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM hits WHERE item IS NOT NULL GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

NEARDUP = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
starts AS (SELECT r, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0),
shingles AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
lows AS (SELECT a AS r, min(doc_id) AS low FROM reach JOIN d ON d.r = b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, low) AS component_id, doc_id IS NOT DISTINCT FROM least(doc_id, low) AS kept
FROM d LEFT JOIN sizes USING (r) LEFT JOIN lows USING (r)
"""

QUALITY = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
d AS (SELECT r, doc_id, regexp_extract_all(x, {_WORD}) AS w, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, {_WORD})) AS l,
             length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM t),
grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE times > 1) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_lettered
      FROM d LEFT JOIN repeats USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars > 25 * n_words OR 2 * n_symbols > n_words OR 2 * n_lettered < n_words OR 2 * n_dup_lines > greatest(1, n_lines)) AS kept
FROM f
"""

LINES = f"""
WITH t AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, doc_id, text, string_split(text, chr(10)) AS every FROM documents),
l AS (SELECT r, i, regexp_extract_all(every[i], {_WORD}) AS w FROM (SELECT r, every, unnest(range(1, len(every) + 1)) AS i FROM t)),
lines AS (SELECT r, i, array_to_string(w, ' ') AS line, len(w) AS n, w FROM l WHERE len(w) > 0),
firsts AS (SELECT line, any_value(n) AS n, any_value(w) AS w, min((r, i)) AS place FROM lines GROUP BY line),
long AS (SELECT * FROM firsts WHERE n >= {linedup.NEAR_WORDS}),
halves AS (SELECT line, n, w, place, s, unnest([array_to_string(w[1:s // 2], ' ') || ' .', '. ' || array_to_string(w[n - s // 2 + 1:n], ' ')]) AS half
           FROM (SELECT *, unnest([n, n - 1]) AS s FROM long)),
pairs AS (SELECT DISTINCT a.line, a.n, a.w, b.n AS bn, b.w AS bw FROM halves a JOIN halves b ON a.half = b.half AND a.s = b.s AND b.place < a.place
          WHERE abs(a.n - b.n) <= 1 AND a.s = least(a.n, b.n)),
ends AS (SELECT line, CASE WHEN n <= bn THEN w ELSE bw END AS x, CASE WHEN n <= bn THEN bw ELSE w END AS y FROM pairs),
differ AS (SELECT line, x, y, coalesce(list_position(list_transform(range(1, len(x) + 1), lambda k: x[k] <> y[k]), true), len(x) + 1) AS p FROM ends),
near AS (SELECT DISTINCT line FROM differ WHERE CASE WHEN len(x) = len(y) THEN x[p + 1:len(x)] = y[p + 1:len(y)] ELSE x[p:len(x)] = y[p + 1:len(y)] END),
gone AS (SELECT r, list(i) AS gone FROM lines JOIN firsts USING (line) WHERE (r, i) <> place OR line IN (SELECT line FROM near) GROUP BY r)
SELECT doc_id, coalesce(len(every), 0) AS n_lines, coalesce(len(gone), 0) AS n_dropped,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(every) + 1), lambda k: NOT list_contains(gone, k)), lambda k: every[k]), chr(10)) END AS text
FROM t LEFT JOIN gone USING (r)
"""
