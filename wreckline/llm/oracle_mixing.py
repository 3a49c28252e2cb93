"""DuckDB SQL for ``mixing``, with the level found by trying every set of full sources."""

from __future__ import annotations

from .mixing import MAX_EPOCHS, SEED, SYMBOLS


def mixing_sql() -> str:
    return rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), k AS (
  SELECT doc_id, source, size,
         1.0::DOUBLE - 0.9::DOUBLE * least(1.0::DOUBLE,
           20.0::DOUBLE * len(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) / greatest(len(t), 1)) AS w,
         md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR), '{SEED}')) AS h
  FROM d
), keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST(CAST('0x' || h[1:12] AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0::DOUBLE) / w AS key
  FROM k
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM keyed GROUP BY source
), levels AS (
  SELECT a.source, {MAX_EPOCHS} * a.source_size / a.weight AS top,
         ((SELECT sum(source_size) FROM s) - coalesce(sum({MAX_EPOCHS} * b.source_size)
             FILTER (WHERE {MAX_EPOCHS} * b.source_size / b.weight < {MAX_EPOCHS} * a.source_size / a.weight), 0))
         / sum(b.weight) FILTER (WHERE {MAX_EPOCHS} * b.source_size / b.weight >= {MAX_EPOCHS} * a.source_size / a.weight) AS lvl
  FROM s a, s b GROUP BY a.source, a.source_size, a.weight
), t AS (
  SELECT source, source_size,
         least(CAST({MAX_EPOCHS} * source_size AS DOUBLE),
               (SELECT arg_min(lvl, top) FROM levels WHERE top >= lvl) * weight) AS target
  FROM s
), e AS (
  SELECT *, CAST(floor(target / greatest(source_size, 1)) AS BIGINT) AS epochs FROM t
), p AS (
  SELECT keyed.doc_id, size, source_size, target, epochs,
         sum(size) OVER (PARTITION BY keyed.source ORDER BY key) AS upto,
         sum(size) OVER (PARTITION BY keyed.source, key) AS same
  FROM keyed JOIN e ON keyed.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN upto - same / 2 < target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""
