"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables by attribute: `t.orders` reads `<dir>/orders.parquet`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of `Tables`; `sql` is the same query for an ordinary SQL engine."""

    def register(build):
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def draw_sql(seed: int | str, *columns: str) -> str:
    """The keyed draw in SQL."""
    keys = ", ".join(f"coalesce(cast({c} AS VARCHAR), '\\N')" for c in columns)
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {keys})), 1, 8) AS BIGINT)"


def nearest_sql(rows: str, group: str, treated: str, unit: str, score: str, draw: str, ratio: int) -> str:
    """Common tables that end in `near` (control, treated, score of both): rounds of mutually nearest free scores, a turn per control.

    A node is a score of a group with its free rows. In each round a node looks for its nearest node
    of the other side; two nodes that choose each other are matched, the smaller count wholly.
    """
    def nearest(low, high):
        return f"CASE WHEN {high} IS NULL OR s - {low} <= {high} - s THEN {low} ELSE {high} END"

    def beyond(value, order):
        return f"last_value(CASE WHEN {value[0]} > 0 THEN {value[1]} END IGNORE NULLS) OVER (PARTITION BY g ORDER BY s {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    out = f"""
    nr AS (SELECT {group} AS g, CAST({score} AS DOUBLE) AS s, {treated} AS tr, {unit} AS unit, row_number() OVER (
             PARTITION BY {group}, {score}, {treated} ORDER BY {draw}, {unit}) - 1 AS rk FROM {rows}),
    n1 AS (SELECT g, s, sum(tr) AS ta, sum(tr) AS t, sum(1 - tr) AS c, CAST(0 AS HUGEINT) AS cu FROM nr GROUP BY 1, 2)"""
    flows = []
    for k in range(1, ratio + 1):
        seen = ", ".join(f"{beyond((side, 's'), order)} AS {side}{name}" for side in "tc" for name, order in (("l", ""), ("r", "DESC")))
        told = ", ".join(f"{beyond((side, f'struct_pack(b := best, n := {side}, u := cu)'), order)} AS {side}{name}x"
                         for side in "tc" for name, order in (("l", ""), ("r", "DESC")))
        out += f""",
    r{k} AS (
      SELECT 0 AS i, g, s, ta, t, c, cu, CAST(NULL AS DOUBLE) AS cs, CAST(0 AS HUGEINT) AS tf, CAST(0 AS HUGEINT) AS cf, CAST(0 AS HUGEINT) AS m FROM n{k}
      UNION ALL
      SELECT i + 1, g, s, ta, t - mt, c - mc, cu + mc, best, ta - t, CASE WHEN t > 0 AND c > 0 THEN cu ELSE p.u END, mt FROM (
        SELECT *, CASE WHEN t > 0 AND c > 0 THEN least(t, c) WHEN t > 0 AND p.b = s THEN least(t, p.n) ELSE 0 END AS mt,
               CASE WHEN t > 0 AND c > 0 THEN least(t, c) WHEN c > 0 AND p.b = s THEN least(c, p.n) ELSE 0 END AS mc FROM (
          SELECT *, CASE WHEN t > 0 THEN (CASE WHEN best < s THEN clx ELSE crx END) ELSE (CASE WHEN best < s THEN tlx ELSE trx END) END AS p FROM (
            SELECT *, {told} FROM (
              SELECT *, CASE WHEN t > 0 AND c > 0 THEN s WHEN t > 0 THEN (CASE WHEN cl IS NULL THEN cr ELSE {nearest('cl', 'cr')} END)
                             ELSE (CASE WHEN tl IS NULL THEN tr ELSE {nearest('tl', 'tr')} END) END AS best FROM (
                SELECT *, {seen}, sum(t) OVER (PARTITION BY g) AS gt, sum(c) OVER (PARTITION BY g) AS gc
                FROM r{k} WHERE t + c > 0) WHERE gt > 0 AND gc > 0))))),
    n{k + 1} AS (SELECT a.g, a.s, a.ta, a.ta AS t, a.c - coalesce(b.m, 0) AS c, a.cu + coalesce(b.m, 0) AS cu FROM n{k} a
             LEFT JOIN (SELECT g, cs, sum(m) AS m FROM r{k} WHERE m > 0 GROUP BY 1, 2) b ON b.g = a.g AND b.cs = a.s)"""
        flows.append(f"SELECT g, s, cs, tf, cf, CAST(unnest(range(CAST(m AS BIGINT))) AS HUGEINT) AS j FROM r{k} WHERE m > 0")
    return out + f""",
    near AS (SELECT f.g, x.unit AS treated, y.unit AS control, f.s AS treated_score, f.cs AS control_score
             FROM ({' UNION ALL '.join(flows)}) f
             JOIN nr x ON x.tr = 1 AND x.g = f.g AND x.s = f.s AND x.rk = f.tf + f.j
             JOIN nr y ON y.tr = 0 AND y.g = f.g AND y.s = f.cs AND y.rk = f.cf + f.j)"""
