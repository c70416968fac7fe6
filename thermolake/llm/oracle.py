"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = rf"[x FOR x IN string_split_regex({_LOW}, '[\x20\x09-\x0D]+') IF x <> '']"
_LETTER = rf"[x FOR x IN string_split_regex({_LOW}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']"

OP2 = f"""WITH RECURSIVE d AS (SELECT doc_id, {_BLANK} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 80 * (x.n + y.n - both_)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept FROM (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)"""

OP13 = f"""WITH RECURSIVE d AS (SELECT doc_id, {_BLANK} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 90 * (x.n + y.n - both_)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id FROM (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)"""

OP3 = f"""WITH d AS (SELECT doc_id, {_BLANK} AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) = 1 AS first_, count(*) OVER (PARTITION BY g) AS n FROM g),
c AS (SELECT doc_id, p, bool_or(first_) AS first_ FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p, first_ FROM k WHERE n > 1) GROUP BY 1, 2),
v AS (SELECT doc_id, p, first_, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island FROM c),
s AS (SELECT doc_id, min(p) AS a, max(p) + 1 AS b, count(*) FILTER (WHERE NOT first_) AS later FROM v GROUP BY doc_id, island)
SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS repeated_words, CAST(sum(later) AS BIGINT) AS later_words, string_agg(a || '-' || b, ',' ORDER BY a) AS spans FROM s GROUP BY 1"""

OP5 = f"""WITH d AS (SELECT doc_id, {_LETTER} AS w FROM documents), i AS (SELECT item_id, {_LETTER} AS w FROM benchmark),
x AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + 9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
z AS (SELECT DISTINCT n FROM x),
y AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, z WHERE len(w) >= n)),
h AS (SELECT doc_id, y.n, k, item_id FROM y JOIN x ON y.n = x.n AND y.g = x.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS v FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(v, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""

SQL = {"op2_superminhash": OP2, "op3_sparse_suffixes": OP3, "op5_decontamination": OP5, "op13_divide_skip": OP13}
