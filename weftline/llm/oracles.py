"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

#: Whole lines and lines without one word, as texts of words; equal ones meet.
LINE_DEDUP = r"""WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, CAST(i AS INT) AS no, list_filter(regexp_split_to_array(lower(ls[i]), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM d, unnest(range(1, len(ls) + 1)) q(i)),
w AS (SELECT doc_id, no, ws, len(ws) AS n FROM l WHERE len(ws) > 0),
u AS (SELECT ws, n, min((doc_id, no)) AS first FROM w GROUP BY 1, 2),
v AS (SELECT ws, n, first, 'd' || n || ' ' || array_to_string(ws, ' ') AS key, 0 AS kind FROM u WHERE n >= 5
  UNION ALL SELECT ws, n, first, 's' || n || ' ' || i || ' ' || array_to_string(list_concat(ws[1:i - 1], ['*'], ws[i + 1:n]), ' '), 1 FROM u, unnest(range(1, n + 1)) q(i) WHERE n >= 6
  UNION ALL SELECT ws, n, first, 'd' || (n - 1) || ' ' || array_to_string(list_concat(ws[1:i - 1], ws[i + 1:n]), ' '), 2 FROM u, unnest(range(1, n + 1)) q(i) WHERE n >= 6),
c AS (SELECT key, min(first) FILTER (kind = 0) AS whole, min(first) FILTER (kind <> 0) AS other FROM v GROUP BY 1),
near AS (SELECT DISTINCT ws FROM v JOIN c USING (key) WHERE CASE WHEN kind = 2 THEN whole ELSE other END < first),
gone AS (SELECT doc_id, no FROM w JOIN u USING (ws) WHERE (doc_id, no) <> first OR ws IN (SELECT ws FROM near)),
k AS (SELECT doc_id, list(no) AS nos FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(nos), 0) AS BIGINT) AS n_removed,
md5(CASE WHEN nos IS NULL THEN coalesce(text, '') ELSE array_to_string(list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT list_contains(nos, CAST(i AS INT))), lambda i: ls[i]), chr(10)) END) AS text_md5
FROM d LEFT JOIN k USING (doc_id)"""

DECONTAMINATION = r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
p AS (SELECT DISTINCT item, least(10, len(ws)) AS m, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win FROM b, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) q(i) WHERE len(ws) > 0),
ms AS (SELECT DISTINCT m FROM p),
t AS (SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS win FROM w, ms, unnest(range(1, len(ws) - m + 2)) q(i) WHERE len(ws) >= m),
h AS (SELECT doc_id, i, t.m, item FROM t JOIN p ON p.win = t.win AND p.m = t.m),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM h, unnest(range(i, i + m)) q(pos) GROUP BY 1),
g AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)"""

#: Exact quantiles; the summaries are exact too for groups of up to 10,000 rows.
QUALITY = r"""WITH w AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT id, i, count(*) OVER (PARTITION BY id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM w, unnest(range(1, len(ws) - 1)) q(i)),
r AS (SELECT id, count(DISTINCT p) AS n FROM g, unnest(range(i, i + 3)) q(p) WHERE c > 1 GROUP BY 1),
b AS (SELECT w.id, doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  length(t) - length(regexp_replace(t, '[!?#*$%&|<>{}\[\]\\^~=_+@/]', '', 'g')) AS n_marks, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (id)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_symbols::DOUBLE / greatest(word_chars, 1) AS symbol_share, n_marks::DOUBLE / greatest(word_chars, 1) AS mark_share, n_upper::DOUBLE / greatest(word_chars, 1) AS upper_share,
  word_chars::DOUBLE / greatest(n_words, 1) AS word_length FROM b),
x AS (SELECT lang, source, letters, k, v FROM (SELECT lang, source, greatest(word_chars, 1) AS letters, symbol_share, mark_share, upper_share, word_length FROM m WHERE NOT base_failed) UNPIVOT (v FOR k IN (symbol_share, mark_share, upper_share, word_length))),
f1 AS (SELECT lang, source, k, count(*) AS n, quantile_disc(v, 0.5) + 12.0::DOUBLE * greatest(quantile_disc(v, 0.75) - quantile_disc(v, 0.25), CASE WHEN k = 'word_length' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / quantile_disc(letters, 0.25) END) AS lim FROM x GROUP BY 1, 2, 3),
f2 AS (SELECT lang, k, count(*) AS n, quantile_disc(v, 0.5) + 12.0::DOUBLE * greatest(quantile_disc(v, 0.75) - quantile_disc(v, 0.25), CASE WHEN k = 'word_length' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / quantile_disc(letters, 0.25) END) AS lim FROM x GROUP BY 1, 2),
f3 AS (SELECT k, quantile_disc(v, 0.5) + 12.0::DOUBLE * greatest(quantile_disc(v, 0.75) - quantile_disc(v, 0.25), CASE WHEN k = 'word_length' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / quantile_disc(letters, 0.25) END) AS lim FROM x GROUP BY 1),
lim AS (SELECT f1.lang, f1.source, f1.k, (f1.n * f1.lim + 30 * ((f2.n * f2.lim + 30 * f3.lim) / (f2.n + 30))) / (f1.n + 30) AS lim FROM f1 JOIN f2 ON f1.lang IS NOT DISTINCT FROM f2.lang AND f1.k = f2.k JOIN f3 ON f1.k = f3.k),
o AS (SELECT id, k, v FROM m UNPIVOT (v FOR k IN (symbol_share, mark_share, upper_share, word_length))),
bad AS (SELECT DISTINCT id FROM o JOIN m USING (id) JOIN lim ON lim.k = o.k AND lim.lang IS NOT DISTINCT FROM m.lang AND lim.source IS NOT DISTINCT FROM m.source WHERE o.v > lim.lim)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
NOT base_failed AND id NOT IN (SELECT id FROM bad) AS kept FROM m"""

#: Shares in hugeint arithmetic; every group meets every kept term of its language.
DIVERGENCE = r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term, count(*) AS ln FROM t GROUP BY 1, 2 HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v, sum(ln) AS lt FROM k GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
f AS (SELECT g.lang, g.source, k.term, k.ln, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, v.v, v.lt
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v)::HUGEINT AS p, 1 + (1000000000::HUGEINT * (ln + 5)) // (lt + 5 * v)::HUGEINT AS q FROM f),
a AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
pair AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= 50"""

ORACLES: dict[str, str] = {"op7_decontamination": DECONTAMINATION, "op8_line_dedup": LINE_DEDUP, "op10_quality": QUALITY, "op11_source_divergence": DIVERGENCE}
