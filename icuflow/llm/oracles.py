"""DuckDB SQL for the queries that SQL can express, written against the raw tables."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.m, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(l.m, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""

OP3 = """
WITH h AS (SELECT doc_id, hex(coalesce(text, '')) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(1, length(h) // 2 + 1)) AS i FROM h),
w AS (SELECT doc_id, i, length(h) // 2 - i + 1 >= 100 AS whole, md5_number(substr(h, 2 * i - 1, 200)) AS x, substr(h, 2 * i - 1, 2) AS byte FROM p),
r AS (SELECT doc_id, i, byte, whole AND row_number() OVER (PARTITION BY x, whole ORDER BY doc_id, i) > 1 AS again FROM w),
g AS (SELECT doc_id, i, byte, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r),
e AS (SELECT doc_id, i, byte, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM g)
SELECT h.doc_id, count(e.i) AS n_bytes, count(*) FILTER (WHERE e.gone) AS n_removed, count(*) FILTER (WHERE e.opens) AS n_spans,
       sha256(unhex(coalesce(string_agg(e.byte, '' ORDER BY e.i) FILTER (WHERE NOT e.gone), ''))) AS kept_sha256
FROM h LEFT JOIN e ON e.doc_id = h.doc_id GROUP BY h.doc_id
"""

_WORDS4 = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP4 = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS4}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS4} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.i, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.k = iw.k),
hw AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN hi ON hi.doc_id = d.doc_id
"""

OP8 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
x AS (SELECT doc_id, i, w[i] AS word, len(w) - i + 1 >= 20 AS whole, md5_number(array_to_string(w[i:i + 19], ' ')) AS k FROM p),
r AS (SELECT doc_id, i, word, whole AND row_number() OVER (PARTITION BY k, whole ORDER BY doc_id, i) > 1 AS again FROM x),
g AS (SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r)
SELECT d.doc_id, len(d.w) AS n_words, count(*) FILTER (WHERE g.gone) AS n_removed,
       sha256(coalesce(string_agg(g.word, ' ' ORDER BY g.i) FILTER (WHERE NOT g.gone), '')) AS kept_sha256
FROM d LEFT JOIN g ON g.doc_id = d.doc_id GROUP BY d.doc_id, d.w
"""

_INTEGERS = """SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP11 = f"""
WITH v AS ({_INTEGERS}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

OP12 = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
m AS (SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS mask FROM t),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
      FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY 1, 2),
f AS (SELECT k, substr('ABCDE', k + 1, 1) AS c FROM range(5) r(k)),
o AS (SELECT p.c || q.c || r.c || s.c || u.c AS filter_order, [p.k, q.k, r.k, s.k, u.k] AS ks FROM f p, f q, f r, f s, f u
      WHERE len(list_distinct([p.k, q.k, r.k, s.k, u.k])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, ks[step] AS k, CAST(1 << ks[step] AS INTEGER) AS bit,
             CAST(coalesce(list_sum(list_transform(ks[1:step - 1], lambda x: 1 << x)), 0) AS INTEGER) AS before FROM o, range(1, 6) g(step)),
r AS (SELECT part, filter_order, step, any_value(k) AS k,
             coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0), 0) AS redundant,
             coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
             coalesce(sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS good_lost,
             coalesce(sum(bad) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM r
"""


def _round(k: int) -> str:
    """Assignment to the entries of round k, and the entries of round k + 1."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT p.vec_id, p.part, min(CAST(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, e.v) + list_inner_product(e.v, e.v) AS BIGINT) * 256 + e.i) AS best
  FROM p JOIN e{k} e ON e.part = p.part GROUP BY 1, 2)""" + (f""",
u{k} AS (SELECT part, best % 256 AS i, j, sum(x) AS s, count(*) AS n
  FROM (SELECT a.part, a.best, unnest(p.v) AS x, unnest(range(len(p.v))) AS j FROM a{k} a JOIN p ON p.vec_id = a.vec_id AND p.part = a.part) GROUP BY 1, 2, 3),
e{k + 1} AS MATERIALIZED (
  SELECT e.part, e.i, coalesce(n.v, e.v) AS v FROM e{k} e
  LEFT JOIN (SELECT part, i, list(floor(s / n) ORDER BY j) AS v FROM u{k} GROUP BY 1, 2) n ON n.part = e.part AND n.i = e.i),""" if k < 4 else "")


OP13 = f"""
WITH v AS MATERIALIZED ({_INTEGERS}),
p AS MATERIALIZED (SELECT vec_id, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS v FROM v, range(4) r(part)),
e0 AS MATERIALIZED (SELECT part, i, v FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM v QUALIFY i < 256) f ON f.vec_id = p.vec_id),
{"".join(map(_round, range(5)))},
d AS (SELECT vec_id, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM a4 GROUP BY 1),
b AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, i)) AS codebooks_sha256 FROM e4)
SELECT d.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM d JOIN v ON v.vec_id = d.vec_id, b
"""
