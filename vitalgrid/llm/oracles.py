"""SQL forms of the operators that SQL can express."""

from __future__ import annotations

from vitalgrid.llm import mixing, urls
from vitalgrid.llm.vector_oracles import CLUSTERING, CODING, REPEATS

_WORDS = "[^\\x20\\x09-\\x0D]+"

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size,
    md5('mix {mixing.SEED} ' || coalesce(doc_id::VARCHAR, '')) AS hash
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
caps AS (
  SELECT source, source_size, source_size * {mixing.EPOCHS} AS cap,
    1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(mixing.WEIGHTS)} AS weight
  FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, source
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, source
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM caps),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM levels),
plan AS (
  SELECT *, target - whole * source_size AS part FROM (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets)),
steps AS (
  SELECT s.source, s.hash, sum(s.size)::BIGINT AS size FROM sized s GROUP BY s.source, s.hash),
taken AS (
  SELECT t.source, t.hash, sum(t.size) OVER (PARTITION BY t.source ORDER BY t.hash) - t.size / 2.0 <= p.part AS once_more
  FROM steps t JOIN plan p ON t.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size, p.source_size, p.target,
  (d.size * (p.whole + CASE WHEN t.once_more AND p.source_size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d
JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
JOIN taken t ON d.source IS NOT DISTINCT FROM t.source AND d.hash = t.hash
"""

URLS = f"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(map(str, urls.RULES))}),
parsed AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(coalesce(regexp_extract(url, '{urls.PATTERN}', 1), ''), '{urls.UPPER}', '{urls.LOWER}') AS host,
    coalesce(regexp_extract(url, '{urls.PATTERN}', 2), '') AS path
  FROM pages),
fitting AS (
  SELECT p.*, r.host || r.path AS rule, r.verdict, row_number() OVER (
    PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.host || r.path DESC) AS place
  FROM parsed p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, '{urls.OTHERWISE}') AS verdict FROM fitting WHERE place = 1
"""

_CONTROL = r"<\\*\|(?:turn|text|end)\|>"

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(23 + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL}'))
    + len(regexp_extract_all(text, '{_CONTROL}')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

# Over whole tables these two are all-pairs work, which SQL can still do at the size of the check.
TOP_K = """
WITH usable AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_dot_product(q.v, c.v))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 5
"""

ORACLES = {
    "op4_chat": CHAT, "op5_urls": URLS, "op7_mixing": MIXING, "op8_topk": TOP_K, "op11_suffixes": REPEATS,
    "op12_centroids": CLUSTERING, "op13_codes": CODING,
}
