"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from crossfoot.llm.url_filter import BLOCK_ABOVE, BUCKETS, GRAM_SIZES, RULES, train

OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

OP5 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i+4])) WHEN len(w) > 0 THEN [w] ELSE [] END AS shingles
  FROM d),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON both_ways.a = reached.other)
SELECT s.doc_id, len(shingles) AS n_shingles, min(other) AS component_id
FROM s JOIN reached ON reached.doc_id = s.doc_id GROUP BY s.doc_id, len(shingles)
"""

OP7 = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, lines[i] AS content,
         list_distinct(list_filter(regexp_split_to_array(
           translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)),
t AS (SELECT doc_id, line, len(w) AS n, unnest(w) AS word FROM l WHERE len(w) >= 1),
f AS (SELECT word, count(*) AS often FROM t GROUP BY word),
p AS (
  SELECT doc_id, line, n, word, row_number() OVER (PARTITION BY doc_id, line ORDER BY often, word) AS place
  FROM t JOIN f USING (word)),
c AS (
  SELECT DISTINCT a.doc_id AS da, a.line AS la, b.doc_id AS db, b.line AS lb
  FROM p a JOIN p b ON a.word = b.word AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.line < b.line)
       AND a.place <= a.n - ceil(0.8 * a.n) + 1 AND b.place <= b.n - ceil(0.8 * b.n) + 1 AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
gone AS (
  SELECT DISTINCT db AS doc_id, lb AS line
  FROM c JOIN l a ON a.doc_id = da AND a.line = la JOIN l b ON b.doc_id = db AND b.line = lb
  WHERE 5 * len(list_intersect(a.w, b.w)) >= 4 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))))
SELECT l.doc_id, count(gone.doc_id) AS n_removed,
       sha256(coalesce(string_agg(content, chr(10) ORDER BY l.line) FILTER (WHERE gone.doc_id IS NULL), '')) AS text_sha256
FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.line = l.line GROUP BY l.doc_id
"""


def op10() -> str:
    """Rules as a table, longest match by rank; the model's non-zero weights as a table."""
    model = train()
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    weights = ", ".join(f"({b}, {w})" for b, w in enumerate(model.weights) if w)
    sizes = ", ".join(f"({n})" for n in GRAM_SIZES)
    return rf"""
WITH rules(rule_host, rule_path, said) AS (VALUES {rules}),
weights(bucket, weight) AS (VALUES {weights}),
sizes(n) AS (VALUES {sizes}),
a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM b),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, said,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
parts AS (SELECT page_id, 'h' AS mark, host AS part FROM p UNION ALL SELECT page_id, 'p', path FROM p),
grams AS (SELECT page_id, mark || substr(part, i, n) AS gram FROM parts, sizes, LATERAL (SELECT unnest(range(1, length(part) - n + 2)) AS i)),
scores AS (
  SELECT page_id, sum(weight) AS score
  FROM grams JOIN weights ON bucket = CAST('0x' || substr(md5(gram), 1, 3) AS INTEGER) % {BUCKETS}
  GROUP BY page_id)
SELECT p.page_id, host, path, rule, CAST({model.bias} + coalesce(score, 0) AS BIGINT) AS model_score,
       coalesce(said, CASE WHEN {model.bias} + coalesce(score, 0) > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits ON fits.page_id = p.page_id AND fits.place = 1 LEFT JOIN scores ON scores.page_id = p.page_id
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
f AS (
  SELECT p.anchor_id, positive_id, positive_score, s.other_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM f WHERE rank <= 3
"""


def oracle() -> dict[str, str]:
    return {"op1_exact_dedup": OP1, "op5_ngram_join": OP5, "op7_line_dedup": OP7, "op10_url_filter": op10(), "op13_hard_negatives": OP13}
