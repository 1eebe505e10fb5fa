"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op5_exact_dups"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""

ORACLE["op10_decontaminate"] = r"""
WITH low AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT doc_id, regexp_extract_all(coalesce(t, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), sized AS (
  SELECT item, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0
), grams AS (
  SELECT DISTINCT item, n, array_to_string(ws[i : i + n - 1], ' ') AS gram
  FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM sized)
), sizes AS (
  SELECT DISTINCT n FROM grams
), places AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)
), hits AS (
  SELECT p.doc_id, p.i, p.n, g.item FROM places p JOIN grams g ON p.n = g.n AND p.gram = g.gram
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY 1
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY 1
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op2_near_dups"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

ORACLE["op13_hard_negatives"] = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id NULLS LAST) <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM (
  SELECT p.*, s.other_id, s.score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id NULLS LAST) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
WHERE rank <= 10
"""
