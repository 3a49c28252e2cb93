"""DuckDB SQL for ``filter_audit``: every order joined with every mask, step by step."""

from __future__ import annotations


def filter_audit_sql() -> str:
    steps = ", ".join(f"substr(o, {k}, 1)" for k in range(1, 6))
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (SELECT t, min(doc_id) AS first FROM docs GROUP BY t),
marks AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM docs JOIN firsts USING (t)
), weights AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM marks LEFT JOIN weights USING (doc_id) GROUP BY part, fails
), letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f) AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)
), ranked AS (
  SELECT part, o, fails, n, good, toxic,
         list_min(list_filter(list_transform([{steps}], lambda f, i: CASE WHEN contains(fails, f) THEN i ELSE 6 END), lambda i: i < 7)) AS gone
  FROM counts, orders
), steps AS (
  SELECT part, o, s, substr(o, s, 1) AS f, fails, n, good, toxic, gone FROM ranked, (SELECT unnest(range(1, 6)) AS s)
), cells AS (
  SELECT part, o AS filter_order, s AS step, f,
    sum(CASE WHEN gone > s THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = s THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND gone < s THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = s THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM cells
"""
