"""DuckDB SQL for the duplicate operators' queries, said plainly: every pair, window and string of the whole table.

Meant for tables of a few megabytes; the queries themselves have no such limit.
"""

from __future__ import annotations


def jaccard_sql(words: int, percent: int) -> str:
    return rf"""
    WITH RECURSIVE w AS MATERIALIZED (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS MATERIALIZED (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s
      FROM w WHERE len(w) > 0),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
    r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.m, w.doc_id)) AS component_id
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) m ON m.a = w.doc_id"""


def suffix_sql(length: int) -> str:
    return f"""
    WITH h AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    s AS MATERIALIZED (SELECT doc_id, p, md5(h[2 * p + 1:2 * p + {2 * length}]) AS m FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - {length - 1})) AS p FROM h)),
    c AS (SELECT doc_id, p FROM s QUALIFY count(*) OVER (PARTITION BY m) > 1),
    i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM (
      SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {length} THEN 0 ELSE 1 END AS new FROM c)),
    r AS MATERIALIZED (SELECT doc_id, span, min(p) AS a, max(p) + {length} AS b FROM i GROUP BY ALL),
    k AS (
      SELECT r.doc_id, string_agg(h[2 * prev + 1:2 * a], '' ORDER BY a) || any_value(h[2 * last + 1:]) AS kept, sum(b - a) AS removed, count(*) AS spans
      FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev, max(b) OVER (PARTITION BY doc_id) AS last FROM r) r JOIN h ON h.doc_id = r.doc_id GROUP BY r.doc_id)
    SELECT h.doc_id, CAST(len(h.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed, coalesce(k.spans, 0) AS n_spans,
      sha256(unhex(coalesce(k.kept, h.h))) AS kept_sha256
    FROM h LEFT JOIN k ON k.doc_id = h.doc_id"""


def substring_sql(length: int) -> str:
    return rf"""
    WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + {length - 1}], ' ')) AS m FROM (SELECT doc_id, w, unnest(range(1, len(w) - {length - 2})) AS i FROM w)),
    c AS (SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, i) > 1),
    g AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + {length})) AS j FROM c),
    k AS (SELECT doc_id, count(*) AS removed, list(j) AS gone FROM g GROUP BY doc_id),
    u AS (SELECT doc_id, j, w[j] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM w)),
    t AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS kept FROM u ANTI JOIN g USING (doc_id, j) GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.removed, 0) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
    FROM w LEFT JOIN k ON k.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id"""
