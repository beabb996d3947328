"""Query of the quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query, table
from .rules import apply_rules

# The thresholds and the stop words are typed again here, apart from the rule table.
_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text,
        list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g) WHERE c > 1),
c AS (SELECT rid, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) AS t(o) GROUP BY rid),
s AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(list_filter(ws, lambda x: lower(x) IN (
          'the','of','and','to','in','that','it','is','was','for','on','are','as','with','they','be','at','this','have',
          'from','or','by','der','die','und','das','von','den','mit','ist','im','sich','nicht','ein','eine','als','zu',
          'auf','für','le','la','les','de','des','et','un','une','du','en','est','que','pour','dans','qui','par','sur',
          'au','avec','el','los','las','y','del','por','con','su','para','se','una','al','lo','como','no'
        ))) AS BIGINT) AS n_stop_words
      FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.1
  AND n_stop_words / n_words >= 0.03 AND n_dup_lines / n_lines <= 0.5 AS kept
FROM b
"""


@query(_SQL)
def op10_quality_rules(spark, folder):
    """Counts and verdict of every document."""
    judged = apply_rules(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("kept"))
