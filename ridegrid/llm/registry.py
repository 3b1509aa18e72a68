"""The queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

from ridegrid.llm.decontamination import op4_benchmark_decontamination
from ridegrid.llm.filter_audit import op13_filter_interaction_audit
from ridegrid.llm.jaccard_join import op5_ngram_jaccard_join
from ridegrid.llm.line_dedup import op8_line_dedup
from ridegrid.llm.lm_scoring import op1_lm_scoring
from ridegrid.llm.pieces import op7_sentencepiece
from ridegrid.llm.quality_rules import op10_quality_rules
from ridegrid.llm.secret_scan import op3_secret_scans
from ridegrid.llm.sharding import op6_sharding
from ridegrid.llm.substring_dedup import op9_substring_dedup
from ridegrid.llm.url_filter import op2_url_filters
from ridegrid.llm.vector_codes import op12_vector_code_compression
from ridegrid.llm.vector_search import op11_exact_top_k_search

QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_url_filters, op3_secret_scans, op4_benchmark_decontamination,
    op5_ngram_jaccard_join, op6_sharding, op7_sentencepiece, op8_line_dedup,
    op9_substring_dedup, op10_quality_rules, op11_exact_top_k_search, op12_vector_code_compression,
    op13_filter_interaction_audit)}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"'[^\x20\x09-\x0D]+'"

#: Targets without character references and dot segments; those are tested on small fixtures.
OP2 = r"""
WITH RECURSIVE p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest FROM pages),
n AS (SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN rest = '' THEN '/' ELSE rest END END AS node FROM p),
t AS (
  SELECT n.*, regexp_extract(x, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS target
  FROM (SELECT *, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS x FROM n) n
  WHERE regexp_matches(x, '(?i)\brel\s*=\s*["'']?canonical\b')
  UNION ALL
  SELECT n.*, regexp_extract(x, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
  FROM (SELECT *, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS x FROM n) n
  WHERE regexp_matches(x, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
a AS (SELECT node, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN target LIKE '#%' THEN url
    WHEN target LIKE '?%' THEN 'http://' || host || path || target
    WHEN target LIKE '//%' THEN 'http:' || target WHEN target LIKE '/%' THEN 'http://' || host || target
    ELSE 'http://' || host || CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '(?s)^(.*/)', 1) ELSE '/' END
      || target END AS target FROM t WHERE target <> ''),
b AS (SELECT node AS u, lower(regexp_extract(target, '(?s)^.*?://([^/?#]*)', 1)) AS h,
    regexp_extract(target, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS r FROM a),
e AS (SELECT u, h || CASE WHEN r = '' THEN '/' ELSE r END AS v FROM b WHERE h <> ''),
g AS (SELECT u, v FROM e WHERE u <> v UNION SELECT v, u FROM e WHERE u <> v),
walk AS (SELECT u AS a, u AS z FROM g UNION SELECT walk.a, g.v FROM walk JOIN g ON walk.z = g.u),
rules(verdict, rule, h, s) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
  ('block', 'net/fr/', 'net', '/fr/')),
seen AS (SELECT DISTINCT z AS node, regexp_extract(z, '^[^/?]*') AS host,
    regexp_extract(z, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM walk),
judged AS (SELECT node, arg_max(verdict, length(rule)) AS verdict FROM seen JOIN rules
  ON (host = h OR host LIKE '%.' || h) AND starts_with(path, s) GROUP BY node),
decided AS (SELECT walk.a AS node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow'
    WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
  FROM walk JOIN judged ON walk.z = judged.node GROUP BY walk.a),
own AS (SELECT row_number() OVER () AS i, * FROM n),
ruled AS (SELECT i, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM own JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, s) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(ruled.verdict, decided.verdict, 'allow') AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN decided.verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS "by"
FROM own LEFT JOIN ruled USING (i) LEFT JOIN decided USING (node)
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, w[i:i + least(len(w), 13) - 1] AS phrase
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT n FROM p),
o AS (SELECT doc_id, i, n, w[i:i + n - 1] AS phrase
  FROM (SELECT d.*, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN s WHERE len(w) >= n)),
h AS (SELECT o.doc_id, o.i, o.n, p.item_id FROM o JOIN p ON o.n = p.n AND o.phrase = p.phrase),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, {WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + least(len(w), 5) - 1] AS x
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL),
e AS (SELECT u, v FROM c JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
  WHERE 100 * shared >= 75 * (a.n + b.n - shared)),
g AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
walk AS (SELECT doc_id AS a, doc_id AS z FROM documents UNION SELECT walk.a, g.v FROM walk JOIN g ON walk.z = g.u)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(z) AS component_id
FROM walk LEFT JOIN n ON n.doc_id = a JOIN d ON d.doc_id = a GROUP BY d.doc_id
""".replace("SELECT doc_id, coalesce(any_value", "SELECT d.doc_id, coalesce(any_value")

KEY = "trim({}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
OP8 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate({KEY.format('line')}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)),
j AS (SELECT k.*, first IS NOT NULL AND first <> doc_id AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
s AS (SELECT doc_id, i, w[i:i + 19] AS x FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS place FROM s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM f WHERE place > 1),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d)
SELECT d.doc_id, CAST(any_value(len(w)) AS BIGINT) AS n_words, count(gone.j) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY t.j) FILTER (gone.j IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN gone ON gone.doc_id = d.doc_id AND gone.j = t.j GROUP BY d.doc_id
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
win AS (SELECT doc_id, n, i, w[i:i + n - 1] AS x FROM (SELECT d.*, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM d CROSS JOIN (VALUES (8), (13), (401)) s(n) WHERE len(w) >= n)),
again AS (SELECT doc_id, n, unnest(places) AS i FROM (SELECT doc_id, n, list(i) AS places FROM win GROUP BY doc_id, n, x
  HAVING count(*) > 1)),
covered AS (SELECT doc_id, n, count(DISTINCT j) AS c FROM (SELECT doc_id, n, unnest(range(i, i + n)) AS j FROM again)
  GROUP BY doc_id, n),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line
  FROM d) WHERE regexp_matches(line, {WORD}) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(dup, 0) AS n_dup_lines, coalesce(a.c, 0) AS n_repeat_words, coalesce(b.c, 0) AS n_covered, e.c AS long_repeat
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered a ON a.doc_id = d.doc_id AND a.n = 8
  LEFT JOIN covered b ON b.doc_id = d.doc_id AND b.n = 13 LEFT JOIN covered e ON e.doc_id = d.doc_id AND e.n = 401)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_covered <= 25 * n_words
    AND long_repeat IS NULL AS kept
FROM m
"""

WHOLE = """embedding IS NOT NULL
  AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)"""

OP11 = f"""
WITH v AS (SELECT row_number() OVER () AS i, vec_id,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings WHERE {WHOLE}),
s AS (SELECT q.i, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.i <> c.i WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _op12(rounds: int = 4, parts: int = 4, width: int = 16, entries: int = 256) -> str:
    """Each round spelled out: distances of every part to every entry, the closest, and the means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT i, p, arg_min(j, (d, j)) AS j, min(d) AS d FROM (SELECT i, x.p, j,
    CAST(list_dot_product(x.x, x.x) - 2 * list_dot_product(x.x, b.x) + list_dot_product(b.x, b.x) AS BIGINT) AS d
  FROM x JOIN b{i} b ON x.p = b.p) GROUP BY i, p)""")
        if i < rounds:
            steps.append(f"""
b{i + 1} AS MATERIALIZED (SELECT p, j, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN (
  SELECT p, j, list(floor(s / n) ORDER BY pos) AS x FROM (SELECT a.p, a.j, pos, sum(x.x[pos]) AS s, count(*) AS n
    FROM a{i} a JOIN x ON a.i = x.i AND a.p = x.p, range(1, {width + 1}) t(pos) GROUP BY a.p, a.j, pos)
  GROUP BY p, j) m USING (p, j))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings WHERE {WHOLE}),
x AS MATERIALIZED (SELECT i, p, x[p * {width} + 1:(p + 1) * {width}] AS x FROM v, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT p, i - 1 AS j, x FROM x WHERE i <= {entries}),{",".join(steps)},
coded AS (SELECT i, string_agg(format('{{:02x}}', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY i),
books AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, j, pos)) AS digest
  FROM (SELECT p, j, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  digest AS codebooks_sha256
FROM v JOIN coded USING (i), books
"""


OP13 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
f AS (SELECT d.part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS failed
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY part, failed),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM s a, s b, s c, s d, s e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
t AS (SELECT filter_order, step, 1 << (instr('ABCDE', filter_order[step]) - 1) AS bit, coalesce(list_sum(list_transform(
    range(1, step), lambda i: 1 << (instr('ABCDE', filter_order[i]) - 1))), 0) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
r AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN failed & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failed & before = 0 AND failed & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failed & before <> 0 AND failed & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failed & before = 0 AND failed & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failed & before = 0 AND failed & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, t GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

#: Scoring by a trained model (1), a token-efficiency test (3), splitters found within a tolerance
#: (6) and piece encoding (7) have no SQL form.  Tests compare 1, 7, the base columns of 3 and the law of 6 with
#: brute force; 3's further spans are tested by their properties.
ORACLE = {"op2_url_filters": OP2, "op4_benchmark_decontamination": OP4, "op5_ngram_jaccard_join": OP5,
          "op8_line_dedup": OP8, "op9_substring_dedup": OP9, "op10_quality_rules": OP10,
          "op11_exact_top_k_search": OP11, "op12_vector_code_compression": _op12(),
          "op13_filter_interaction_audit": OP13}
