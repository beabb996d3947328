"""Query of the prefix trie: conversations share first turns with the first conversation of their group of five."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .prefixes import digest_turns, number_turns, prefix_nodes
from .registry import query, table

_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS g, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
c AS (
  SELECT i.conv_id, t.k, t.role, t.text FROM ids i JOIN t ON t.conv_id = i.g AND t.k <= i.h
  UNION ALL SELECT i.conv_id, t.k + 10, t.role, t.text FROM ids i JOIN t ON t.conv_id = i.conv_id AND t.k > i.h),
n AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k) AS d,
        length(role) || ':' || length(text) || ':' || role || text AS piece, strlen(text) AS b FROM c),
p AS (
  SELECT conv_id, 0 AS d, '' AS path, 0 AS b FROM ids
  UNION ALL SELECT conv_id, d, string_agg(piece, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, b FROM n),
own AS (SELECT conv_id, max(d) AS n FROM p GROUP BY conv_id),
nodes AS (
  SELECT p.d, path, min(p.conv_id) AS least, count(*) AS n_convs, max(b) AS b,
    sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (p.d = own.n), '')) AS ends_sha256,
    count(*) FILTER (p.d = own.n) = count(*) AS leaf
  FROM p JOIN own USING (conv_id) GROUP BY 1, 2),
own_values AS (
  SELECT p.conv_id, p.d, p.path, CASE WHEN p.conv_id = least THEN (n_convs - 1) * nodes.b ELSE 0 END AS v,
    CASE WHEN p.conv_id = least AND leaf THEN 1 ELSE 0 END AS l
  FROM p JOIN nodes ON nodes.d = p.d AND nodes.path = p.path),
sums AS (
  SELECT d, path, sum(v) AS v, sum(l) AS l FROM (
    SELECT d, path, sum(v) OVER w AS v, sum(l) OVER w AS l FROM own_values
    WINDOW w AS (PARTITION BY conv_id ORDER BY d DESC)) GROUP BY 1, 2),
links AS (
  SELECT DISTINCT a.d, a.path, b.path AS above FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.d = b.d + 1),
children AS (SELECT d - 1 AS d, above AS path, count(*) AS n FROM links GROUP BY 1, 2)
SELECT nodes.least AS conv_id, CAST(nodes.d AS BIGINT) AS depth, up.least AS parent_conv_id, nodes.n_convs,
  coalesce(children.n, 0) AS n_children, CAST(sums.l AS BIGINT) AS n_leaves, CAST(sums.v AS BIGINT) AS saved_tokens,
  nodes.ends_sha256
FROM nodes JOIN sums ON sums.d = nodes.d AND sums.path = nodes.path
LEFT JOIN children ON children.d = nodes.d AND children.path = nodes.path
LEFT JOIN links ON links.d = nodes.d AND links.path = nodes.path
LEFT JOIN nodes up ON up.d = links.d - 1 AND up.path = links.above
"""


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns and members: the first h turns of each conversation come from the first of its group of five."""
    ids = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "group": F.col("conv_id") - F.col("conv_id") % 5, "h": F.crc32(F.col("conv_id").cast("string")) % 9})
    first = F.col("conv_id") % 5 == 0
    heads = turns.where(first & (F.col("position") <= 8)).withColumnRenamed("conv_id", "group")
    shared = ids.join(heads, "group").where("position <= h").select("conv_id", "position", "digest", "n_bytes")
    held = ids.select("conv_id", "h", "group").join(
        ids.where(first).select("group", F.col("n").alias("n_head")), "group", "left")
    start = held.select("conv_id", "h", F.least(F.coalesce("n_head", F.lit(0)), "h").alias("given"))
    rest = turns.join(start, "conv_id").where("position > h").select(
        "conv_id", (F.col("given") + F.col("position") - F.col("h")).alias("position"), "digest", "n_bytes")
    return shared.unionByName(rest), ids.select("conv_id")


@query(_SQL)
def op11_prefix_trie(spark, folder):
    """All nodes of the trie of the rebuilt conversations."""
    turns = materialize(number_turns(digest_turns(table(spark, folder, "conversations"))))
    rebuilt, members = with_shared_heads(turns)
    return prefix_nodes(materialize(rebuilt), members)
