"""DuckDB SQL for ``quality_rules``, written from the contract and the same rule table."""

from __future__ import annotations

from .quality_rules import MAX_REPEAT_PCT, MIN_WORDS, PUNCTUATION, RULES, STOP_WORDS, SYMBOLS, WINDOW


def _bounds() -> str:
    tests = []
    for r in RULES:
        tests += [f"{r.metric} >= {r.low}"] * (r.low is not None)
        tests += [f"{r.metric} <= {r.high}"] * (r.high is not None)
    return " AND ".join(tests)


def quality_rules_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(" ".join(STOP_WORDS).split())))
    marks = PUNCTUATION.replace("'", "''")
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), l AS (
  SELECT doc_id, t, w, len(w) AS n_words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT doc_id, i, w[i:i + {WINDOW - 1}] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)
), rep AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT doc_id, CAST(sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS BIGINT) AS n FROM rep GROUP BY doc_id
), c AS (
  SELECT l.doc_id, CAST(n_words AS BIGINT) AS n_words,
         CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(cov.n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: trim(lower(x), '{marks}') IN ({stop}))) AS stop,
         len(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS upper,
         len(lines) AS n_lines
  FROM l LEFT JOIN cov USING (doc_id)
), m AS (
  SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars,
         n_symbols / greatest(n_words, 1) AS symbols_per_word,
         stop / greatest(n_words, 1) AS stop_word_ratio,
         n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio,
         upper / greatest(word_chars, 1) AS upper_letter_ratio,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed
  FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_bounds()} AS kept
FROM m
"""
