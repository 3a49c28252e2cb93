"""DuckDB SQL for ``ngram_join``: shared shingles counted pair by pair, then reachability."""

from __future__ import annotations

import string

from .ngram_join import PERCENT, WIDTH


def ngram_join_sql() -> str:
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {WIDTH - 1}], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {WIDTH - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
  WHERE 100 * i >= {PERCENT} * (nx.n + ny.n - i)
), reach AS (
  SELECT doc_id, doc_id AS root FROM n
  UNION
  SELECT e.there, r.root FROM reach r
  JOIN (SELECT x AS here, y AS there FROM links UNION ALL SELECT y, x FROM links) e ON r.doc_id = e.here
)
SELECT documents.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, documents.doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id) c USING (doc_id)
"""
