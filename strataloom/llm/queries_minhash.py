"""Query of the near-duplicate documents."""

from __future__ import annotations

from .minhash import near_documents
from .registry import query, table

_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT documents.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, documents.doc_id) AS component_id,
  coalesce(component_id, documents.doc_id) = documents.doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = documents.doc_id
"""


@query(_SQL)
def op5_near_documents(spark, folder):
    """Components of all documents."""
    return near_documents(table(spark, folder, "documents"))
