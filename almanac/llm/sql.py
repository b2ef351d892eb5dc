"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from almanac.llm import license_scan

_ALNUM = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
_SPACED = "'[^\\x20\\x09-\\x0D]+'"
#: A-Z become a-z; other letters stay.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _op1() -> str:
    templates = ", ".join(f"('{label}', {k}, list_distinct(string_split('{words}', ' ')))" for k, (label, words) in enumerate(license_scan.TEMPLATES))
    phrases = ", ".join(f"('{label}', '{phrase}', {len(phrase.split())})" for phrase, label in license_scan.PHRASES.items())
    half, full = license_scan.BLOCK_WORDS // 2, license_scan.BLOCK_WORDS
    return f"""
WITH t(label, k, words) AS (VALUES {templates}), p(label, phrase, size) AS (VALUES {phrases}),
d AS (SELECT doc_id, {_LOWER} AS low FROM documents),
w AS (SELECT doc_id, regexp_extract_all(low, {_ALNUM}) AS ws FROM d),
e AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT doc_id, i, w AS w1, w || ' ' || lead(w) OVER o AS w2, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS w3 FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
hits AS (SELECT doc_id, i, label FROM g JOIN p ON phrase = CASE size WHEN 2 THEN w2 ELSE w3 END),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hits GROUP BY doc_id),
blocks AS (SELECT doc_id, list_slice(ws, s + 1, s + {full}) AS b FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - {half}, 1), {half})) AS s FROM w)),
found AS (SELECT doc_id, label, len(list_intersect(words, b)) / len(words) AS share FROM blocks, t WHERE 100 * len(list_intersect(words, b)) >= {round(100 * license_scan.THRESHOLD)} * len(words)),
more AS (SELECT doc_id, max(share) AS share FROM found GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM found UNION SELECT doc_id, label FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
FROM w LEFT JOIN base ON w.doc_id = base.doc_id LEFT JOIN more ON w.doc_id = more.doc_id LEFT JOIN every ON w.doc_id = every.doc_id"""


#: Runs of one to eight words from each place, and the items' windows among them.
_RUNS = ", ".join(" || ' ' || ".join(["w", *(f"lead(w, {j}) OVER o" for j in range(1, n))]) + f" AS k{n}" for n in range(1, 9))
_HITS = " UNION ALL ".join(f"SELECT doc_id, i, item_id, {n} AS n FROM g JOIN win ON g.k{n} = win.k AND win.n = {n}" for n in range(1, 9))

_OP3 = f"""
WITH i AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(ws, s + 1, s + least(8, len(ws))), ' ') AS k, least(8, len(ws)) AS n FROM (SELECT item_id, ws, unnest(range(greatest(len(ws) - 7, least(len(ws), 1)))) AS s FROM i)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM documents),
e AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
g AS (SELECT doc_id, i, {_RUNS} FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
hits AS ({_HITS}),
per AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS sha FROM hits GROUP BY doc_id),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits) JOIN (SELECT unnest(range(8)) AS o) ON o < n GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN per ON d.doc_id = per.doc_id LEFT JOIN cov ON d.doc_id = cov.doc_id"""

_OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS ws FROM documents),
e AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
g AS (SELECT doc_id, i, w, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS k, lead(i, 12) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM e),
m AS (SELECT k, min(doc_id) AS low FROM g WHERE last IS NOT NULL GROUP BY k),
f AS (SELECT g.doc_id, g.i, g.w, CASE WHEN g.last IS NOT NULL AND m.low < g.doc_id THEN 1 ELSE 0 END AS bad FROM g LEFT JOIN m ON g.k = m.k),
c AS (SELECT doc_id, i, w, max(bad) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(CASE WHEN gone = 0 THEN w END, ' ' ORDER BY i) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""

_OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS ws FROM documents),
e AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
g AS (SELECT doc_id, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS k, lead(i, 3) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM e),
s AS (SELECT DISTINCT doc_id, k FROM g WHERE last IS NOT NULL UNION SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN low ON d.doc_id = low.a"""



def _op5() -> str:
    """Names of 1, 2, 4, ... bytes from each place, by doubling; what starts twice is covered by a frame."""
    rounds, n = ["n1 AS (SELECT doc_id, i, b, ascii(b) * 256 + ascii(b[2]) AS k FROM e)"], 1
    for step in (1, 2, 4, 8, 16, 32, 64, 128, 144):
        rounds.append(f"n{n + step} AS (SELECT doc_id, i, b{', k AS k256' if step == 144 else ''}, hash(k, lead(k, {step}) OVER (PARTITION BY doc_id ORDER BY i)) AS k, lead(i, {n + step - 1}) OVER (PARTITION BY doc_id ORDER BY i) IS NOT NULL AS fits FROM n{n})".replace(", k AS k256", ", k AS k256, fits AS fits256"))
        n += step
    twice = "{k} IN (SELECT {k} FROM n400 WHERE {f} GROUP BY 1 HAVING count(*) > 1)".format
    covered = "max({c}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)".format
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS h FROM documents),
e AS (SELECT doc_id, unnest(h) AS b, unnest(range(len(h))) AS i FROM d),
{", ".join(rounds)},
m AS (SELECT doc_id, i, b, CASE WHEN fits AND {twice(k="k", f="fits")} THEN 1 ELSE 0 END AS x, CASE WHEN fits256 AND {twice(k="k256", f="fits256")} THEN 1 ELSE 0 END AS y FROM n400),
c AS (SELECT doc_id, i, b, {covered(c="x", n=399)} AS gone, {covered(c="y", n=255)} AS again FROM m),
s AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) AS was FROM c),
k AS (SELECT doc_id, sum(gone) AS n_removed, count(*) FILTER (gone = 1 AND was = 0) AS n_spans, sum(again) AS n_repeated, string_agg(CASE WHEN gone = 0 THEN b END, '' ORDER BY i) AS kept FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256, CAST(coalesce(n_repeated, 0) AS BIGINT) AS n_repeated
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""


_BLANK = "regexp_full_match(line, '[\\x20\\x09-\\x0D]*')"

#: Every two neighbouring lines, and every stretch of blank lines with a neighbour, by plain comparison of texts.
_OP10 = f"""
WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text <> ''),
u AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i, len(ls) AS n FROM t),
l AS (SELECT *, {_BLANK} AS blank, lead(line) OVER o AS line2, lead({_BLANK}) OVER o AS blank2 FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
st AS (SELECT doc_id, min(i) AS p, max(i) AS q, any_value(n) AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM l WHERE blank) GROUP BY doc_id, run HAVING count(*) > 1),
w AS (SELECT doc_id, p - 1 AS a, q AS b FROM st WHERE p > 0 UNION ALL SELECT doc_id, p, q + 1 FROM st WHERE q + 1 < n),
c AS (SELECT doc_id, i AS a, i + 1 AS b, line || chr(10) || line2 AS x FROM l WHERE line2 IS NOT NULL AND NOT (blank AND blank2)
  UNION ALL SELECT w.doc_id, a, b, array_to_string(list_slice(ls, a + 1, b + 1), chr(10)) FROM w JOIN t ON w.doc_id = t.doc_id),
f AS (SELECT doc_id, a, b, min(doc_id) OVER (PARTITION BY x) AS owner, first_value(b) OVER (PARTITION BY x, doc_id ORDER BY a, b) AS first_end FROM c),
g AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM f WHERE owner < doc_id OR a > first_end),
k AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, coalesce(string_agg(CASE WHEN g.i IS NULL THEN line END, chr(10) ORDER BY l.i), '') AS kept FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CAST(length(coalesce(kept, '')) AS BIGINT) AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN k ON documents.doc_id = k.doc_id"""

ORACLE_SQL = {"op1_license_scan": _op1(), "op3_decontaminate": _OP3, "op4_substring_dedup": _OP4, "op5_suffix_dedup": _op5(), "op6_near_dup": _OP6, "op10_line_dedup": _OP10}
