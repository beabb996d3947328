"""Query of the removal of repeated byte strings."""

from __future__ import annotations

from .registry import query, table
from .repeats import without_repeats

_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
      FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 49)) AS i FROM d WHERE length(h) >= 100)),
m AS (SELECT w, min(doc_id) AS least FROM s GROUP BY w),
g AS (SELECT doc_id, i FROM s JOIN m USING (w) WHERE doc_id > least),
e AS (SELECT doc_id, i, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) > 50 AS new FROM g),
r AS (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e),
p AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM r GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
t AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head, max(b) AS last
      FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


@query(_SQL)
def op6_repeated_strings(spark, folder):
    """What stays of every document without the 50-byte strings of earlier ones."""
    return without_repeats(table(spark, folder, "documents"))
