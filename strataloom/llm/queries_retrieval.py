"""Query of the ranked search."""

from __future__ import annotations

from .registry import query, table
from .retrieval import search

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
_SQL = f"""
WITH words AS (
  SELECT doc_id, r, unnest({_TERMS}) AS term FROM (SELECT doc_id, text, row_number() OVER () AS r FROM documents)),
items AS (
  SELECT DISTINCT item_id, i, unnest({_TERMS}) AS term
  FROM (SELECT item_id, text, row_number() OVER () AS i FROM benchmark)),
lengths AS (SELECT r, doc_id, count(*) AS n FROM words GROUP BY 1, 2),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
counts AS (SELECT r, term, count(*) AS tf FROM words GROUP BY 1, 2),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY 1), whole),
scores AS (
  SELECT i, item_id, r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (r), whole GROUP BY 1, 2, 3, 4),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query(_SQL)
def op12_ranked_search(spark, folder):
    """The fifty best documents of each benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
