"""SQL forms of the clustering and the coding of vectors, and of the removal of repeated passages."""

from __future__ import annotations

#: Vectors without null or non-finite components, as whole numbers.
_KEPT = """
kept AS (
  SELECT *, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND {fits}
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)"""
_SQUARES = "CAST(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
#: Rounded down for either sign.
_FLOOR = "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)"


def _clustering(rounds: int = 3, clusters: int = 16) -> str:
    text = "WITH " + _KEPT.format(scale=64, fits="len(embedding) = 64") + f""",
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, v
  FROM (SELECT sha256('1:' || vec_id::VARCHAR) AS h, v FROM kept ORDER BY h LIMIT {clusters}))"""
    for i in range(rounds + 1):
        text += f""",
a{i} AS (
  SELECT k.vec_id, k.v, c.c, {_SQUARES.format(a="k.v", b="c.v")} AS d FROM kept k, c{i} c
  QUALIFY row_number() OVER (PARTITION BY k.vec_id ORDER BY d, c.c) = 1)"""
        if i < rounds:
            text += f""",
m{i} AS (
  SELECT c, slot, CAST({_FLOOR} AS BIGINT) AS x
  FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS slot FROM a{i}) GROUP BY c, slot),
c{i + 1} AS (
  SELECT o.c, coalesce(n.v, o.v) AS v
  FROM c{i} o LEFT JOIN (SELECT c, list(x ORDER BY slot) AS v FROM m{i} GROUP BY c) n ON o.c = n.c)"""
    return text + f"""
SELECT a.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c"""


def _coding(rounds: int = 2, entries: int = 64, parts: int = 16) -> str:
    text = "WITH " + _KEPT.format(scale=256, fits=f"len(embedding) % {parts} = 0") + f""",
pieces AS (
  SELECT vec_id, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS v
  FROM kept, range({parts}) t(part)),
b0 AS (
  SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS INTEGER) AS e, v
  FROM pieces WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""
    for i in range(rounds + 1):
        text += f""",
a{i} AS (
  SELECT p.vec_id, p.part, p.v, b.e, {_SQUARES.format(a="p.v", b="b.v")} AS d
  FROM pieces p JOIN b{i} b ON p.part = b.part
  QUALIFY row_number() OVER (PARTITION BY p.vec_id, p.part ORDER BY d, b.e) = 1)"""
        if i < rounds:
            text += f""",
m{i} AS (
  SELECT part, e, slot, CAST({_FLOOR} AS BIGINT) AS x
  FROM (SELECT part, e, unnest(v) AS x, generate_subscripts(v, 1) AS slot FROM a{i}) GROUP BY part, e, slot),
b{i + 1} AS (
  SELECT o.part, o.e, coalesce(n.v, o.v) AS v
  FROM b{i} o LEFT JOIN (SELECT part, e, list(x ORDER BY slot) AS v FROM m{i} GROUP BY part, e) n
    ON o.part = n.part AND o.e = n.e)"""
    return text + f""",
book AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS digest FROM b{rounds}),
coded AS (
  SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  book.digest AS codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id, book"""


def _repeats(length: int = 50, block: int = 200) -> str:
    """Bytes are taken as pairs of hex digits; blocks keep the strings short from which places are cut."""
    return f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (
  SELECT doc_id, b, substr(h, {2 * block} * b + 1, {2 * (block + length - 1)}) AS h
  FROM (SELECT doc_id, h, unnest(range((length(h) // 2 - {length}) // {block} + 1)) AS b FROM texts WHERE length(h) >= {2 * length})),
strings AS (
  SELECT doc_id, b * {block} + i AS p, md5_number(substr(h, 2 * i + 1, {2 * length})) AS s
  FROM (SELECT doc_id, b, h, unnest(range(length(h) // 2 - {length - 1})) AS i FROM blocks)),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
found AS (SELECT doc_id, p FROM strings JOIN firsts USING (s) WHERE first < doc_id),
runs AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (
    SELECT doc_id, p,
      CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= {length} THEN 0 ELSE 1 END AS fresh
    FROM found)),
spans AS (
  SELECT doc_id, run, min(p) AS first, max(p) + {length} AS last FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS before FROM spans),
cut AS (
  SELECT g.doc_id, sum(last - first) AS n_removed, count(*) AS n_spans, max(last) AS upto,
    string_agg(substr(h, 2 * before + 1, 2 * (first - before)), '' ORDER BY first) AS head
  FROM gaps g JOIN texts t ON g.doc_id = t.doc_id GROUP BY g.doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM texts t LEFT JOIN cut c ON t.doc_id = c.doc_id"""


CLUSTERING, CODING, REPEATS = _clustering(), _coding(), _repeats()
