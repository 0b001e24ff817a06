"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations


def _level(number: int, parents: list[str], name: str, weight: str, given: str) -> str:
    """One level of the budget tree: children in order of saturation, the full ones first."""
    keys = ", ".join(parents)
    part = f"PARTITION BY {keys}" if parents else ""
    order = f"ORDER BY CASE WHEN w > 0 THEN cap / w END NULLS LAST, {name}"
    both = ", ".join([*parents, name])
    joined = f"JOIN {given} USING ({keys})" if parents else f"CROSS JOIN {given}"
    return f"""
n{number} AS (
  SELECT c.*, {weight} AS w, budget
  FROM (SELECT {both}, sum(avail * 3) AS cap FROM leaves GROUP BY {both}) c {joined}
),
r{number} AS (
  SELECT *, row_number() OVER ({part} {order}) AS k,
    greatest(budget - coalesce(sum(CASE WHEN w > 0 THEN cap ELSE 0 END) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS rest,
    sum(w) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
  FROM n{number}
),
f{number} AS (
  SELECT *, coalesce(k < min(CASE WHEN w > 0 AND rest * w <= cap * onward THEN k END) OVER ({part}), true) AS full_up FROM r{number}
),
o{number} AS (
  SELECT *, CASE WHEN full_up THEN 0 ELSE w END AS open_w,
    greatest(budget - sum(CASE WHEN full_up AND w > 0 THEN cap ELSE 0 END) OVER ({part}), 0) AS left_over
  FROM f{number}
),
g{number} AS (
  SELECT *, sum(open_w) OVER ({part}) AS total_w, sum(open_w) OVER ({part} {order} ROWS UNBOUNDED PRECEDING) AS run_w FROM o{number}
),
b{number} AS (
  SELECT {both}, CAST(CASE WHEN w <= 0 THEN 0 WHEN full_up THEN cap
    ELSE least((left_over * run_w) // total_w - (left_over * (run_w - open_w)) // total_w, cap) END AS BIGINT) AS budget
  FROM g{number}
)"""


SOURCE_MIX = f"""
WITH d AS (
  SELECT doc_id, lang, source,
    'dom' || (coalesce(CAST(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS INTEGER), 0) % 4) AS dom,
    coalesce(lang, '') AS l, coalesce(source, '') AS s, coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
  FROM documents
),
leaves AS (SELECT dom, l, s, CAST(sum(tokens) AS BIGINT) AS avail FROM d GROUP BY dom, l, s),
b0 AS (SELECT CAST(sum(avail) AS BIGINT) // 2 AS budget FROM leaves),
{_level(1, [], "dom", "CASE dom WHEN 'dom0' THEN 4 WHEN 'dom1' THEN 3 WHEN 'dom2' THEN 2 ELSE 1 END", "b0")},
{_level(2, ["dom"], "l", "CASE l WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END", "b1")},
{_level(3, ["dom", "l"], "s", "1", "b2")},
plan AS (
  SELECT dom, l, s, CASE WHEN avail = 0 THEN 0 ELSE budget // avail END AS whole, CASE WHEN avail = 0 THEN 0 ELSE budget % avail END AS rest
  FROM leaves JOIN b3 USING (dom, l, s)
),
placed AS (
  SELECT d.*, whole, rest, sum(tokens) OVER (PARTITION BY dom, l, s ORDER BY md5('17:' || whole || ':' || id), id) AS run
  FROM d JOIN plan USING (dom, l, s)
)
SELECT doc_id, lang, source, CAST(unnest(range(whole + CASE WHEN rest > 0 AND run <= rest THEN 1 ELSE 0 END)) AS INTEGER) AS epoch
FROM placed
"""


def _reached(nodes: str, key: str) -> str:
    """The smallest node reachable over ``both(u, v)``."""
    return f"""reach(node, other) AS (
  SELECT {key}, {key} FROM {nodes} UNION SELECT node, v FROM reach JOIN both_ways ON other = u
),
components AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""


NEAR_VECTORS = f"""
WITH RECURSIVE x AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL
),
n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda c: c * c))) AS size FROM x),
both_ways AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) / (a.size * b.size) >= 0.98
),
{_reached("embeddings", "vec_id")}
SELECT vec_id, (SELECT count(*) FROM both_ways WHERE u = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON node = vec_id
"""

TOP_K = """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS e FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.e, x.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM x q JOIN x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

NEAR_TEXTS = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS parts FROM w
),
e AS (SELECT doc_id, unnest(parts) AS part FROM s),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM e a JOIN e b ON a.part = b.part AND a.doc_id <> b.doc_id GROUP BY ALL),
both_ways AS (
  SELECT u, v FROM common JOIN s a ON a.doc_id = u JOIN s b ON b.doc_id = v WHERE 100 * n >= 85 * (len(a.parts) + len(b.parts) - n)
),
{_reached("documents", "doc_id")}
SELECT doc_id, CAST(len(parts) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN components ON node = doc_id
"""

HARD_NEGATIVES = """
WITH x AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN ((label + 1) % 10 + 10) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
),
s AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, r.id, r.label,
    CAST(list_sum(list_transform(list_zip(a.e, r.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM x a JOIN x r ON a.id <> r.id AND len(a.e) = len(r.e)
  WHERE a.id % 100 = 0
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k
  FROM s WHERE label = anchor_label QUALIFY k <= 5
),
n AS (
  SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL
),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS w
  FROM iw, LATERAL (SELECT unnest(range(1, greatest(len(iw.ws) - 8, 2))) AS i)
  WHERE len(ws) > 0
),
lens AS (SELECT DISTINCT n FROM win),
dpos AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM dw CROSS JOIN lens, LATERAL (SELECT unnest(range(1, len(dw.ws) - lens.n + 2)) AS i)
),
occ AS (SELECT DISTINCT p.doc_id, p.i, p.n, win.item_id FROM dpos p JOIN win ON p.n = win.n AND p.w = win.w),
hit AS (SELECT DISTINCT doc_id, i + k AS pos FROM occ, LATERAL (SELECT unnest(range(0, occ.n)) AS k)),
per AS (SELECT doc_id, count(*) AS n_hit FROM hit GROUP BY doc_id),
its AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',')) AS h
  FROM occ GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN per USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
st AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS nn, coalesce(sum(len(ts)), 0) AS ll FROM d),
it AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
dt AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM it) GROUP BY doc_id, term
),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM dt, st GROUP BY term, nn
),
m AS (SELECT doc_id, 50 + (50 * len(ts) * nn) // ll AS m FROM d, st WHERE len(ts) > 0),
sc AS (
  SELECT it.item_id, dt.doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS score
  FROM it JOIN dt USING (term) JOIN w USING (term) JOIN m ON m.doc_id = dt.doc_id
  GROUP BY it.item_id, dt.doc_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 50
"""
