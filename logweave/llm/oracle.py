"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

EXACT = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

# The mix of a relation named docs.
MIX = r"""
sized AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM docs),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source),
listed AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM per_source),
below AS (
  SELECT *, sum(source_size) OVER () AS total,
    sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS remaining,
    sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weights_left
  FROM listed
  WINDOW b AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, cap::DOUBLE * weights_left::DOUBLE <= weight::DOUBLE * remaining::DOUBLE AS capped FROM below),
aims AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE weight::DOUBLE * (
      (total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE
      / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0)::DOUBLE) END AS target
  FROM marked),
placed AS (
  SELECT s.*, a.source_size, a.target,
    coalesce(a.target / nullif(a.source_size, 0)::DOUBLE, 0) AS expected,
    (row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) - 1)::DOUBLE AS place,
    ('0x' || md5('mix-1:' || coalesce('s' || s.source, 'n'))[1:8])::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS start
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
mixed AS (
  SELECT *, least(floor(expected * (place + 1) + start) - floor(expected * place + start), 3)::BIGINT AS copies
  FROM placed)"""


LINES = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM rows),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
many AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key
  HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 3),
judged AS (
  SELECT k.*, m.key IS NOT NULL AND k.doc_id IS DISTINCT FROM m.last AS gone
  FROM keyed k LEFT JOIN many m ON k.key = m.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""


def clusters_sql(clusters: int = 8, rounds: int = 10, seed: str = "3") -> str:
    """The rounds written out one after the other, a row per vector and component."""
    steps = [
        f"""
kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64),
parts AS MATERIALIZED (
  SELECT r, vec_id, generate_subscripts(embedding, 1) AS j,
    floor(1024 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept),
named AS (
  SELECT r, sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS turn, list(x ORDER BY j) AS x
  FROM parts GROUP BY r, vec_id),
firsts AS (SELECT r, row_number() OVER (ORDER BY turn, x) - 1 AS k FROM named ORDER BY turn, x LIMIT {clusters}),
c0 AS MATERIALIZED (SELECT k, j, x AS c FROM firsts JOIN parts USING (r))"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""
d{n} AS (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM parts JOIN c{n} USING (j) GROUP BY r, k),
a{n} AS MATERIALIZED (SELECT r, min(d) AS d, arg_min(k, (d, k)) AS k FROM d{n} GROUP BY r)"""
        )
        if n < rounds:
            steps.append(
                f"""
s{n} AS (SELECT k, j, sum(x) AS s, count(*) AS n FROM parts JOIN a{n} USING (r) GROUP BY k, j),
c{n + 1} AS MATERIALIZED (
  SELECT c.k, c.j, CASE WHEN n IS NULL THEN c ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS c
  FROM c{n} c LEFT JOIN s{n} s ON c.k = s.k AND c.j = s.j)"""
            )
    return f"""WITH {",".join(steps)},
digests AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN digests USING (k) JOIN kept USING (r)"""


def all_sql() -> dict[str, str]:
    return {
        "op9_exact_dedup": EXACT,
        "op10_mixing": f"WITH docs AS (SELECT * FROM documents), {MIX}\n"
        "SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed",
        "op12_line_dedup": LINES,
        "op13_centroids": clusters_sql(),
    }
