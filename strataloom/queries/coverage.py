"""One query per operator, on the tables as they are."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import dates, draws, nulls, quantiles, recode, text
from ..operators import (aggregates, balance, choice, codes, columns, intervals, joins, matching, nearest, ranks, reshape,
                         running, sampling, survey)
from ..session import shared_folder
from ..sources import readers, writers
from .derived import select, select_sql
from .registry import draw_sql, nearest_sql, query

PART_TYPE = {"click": "ECONOMY", "view": "LARGE", "purchase": "SMALL", "signup": "PROMO", "error": "STANDARD"}
PART_TYPE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PART_TYPE.items()) + " END"


# ---- choice ------------------------------------------------------------------------------------

def event_rows(t):
    brand = F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string"))
    return t.events.select(
        "event_id", recode.recode("event_type", PART_TYPE).alias("p_type"),
        F.nullif(brand, F.lit("Brand#7")).alias("brand"),
    )


def part_codes(t):
    return t.part.select("p_type", F.nullif("p_brand", F.lit("Brand#7")).alias("brand"), "p_partkey", "p_size")


EVENT_ROWS_SQL = f"""
    SELECT event_id, {PART_TYPE_SQL} AS p_type,
           nullif('Brand#' || (user_id % 25 + 1), 'Brand#7') AS brand, {draw_sql(42, 'event_id')} AS u
    FROM events"""
PART_CODES_SQL = f"""
    SELECT p_type, brand, p_partkey, p_size,
           sum(p_size) OVER (PARTITION BY p_type, brand) AS tot,
           sum(p_size) OVER (PARTITION BY p_type, brand ORDER BY place, p_partkey) AS hi
    FROM (SELECT p_type, nullif(p_brand, 'Brand#7') AS brand, p_partkey, p_size,
                 {draw_sql('order', 'p_partkey')} AS place FROM part)"""


@query(f"""
WITH r AS ({EVENT_ROWS_SQL}), c AS ({PART_CODES_SQL})
SELECT r.event_id, r.p_type, r.brand, c.p_partkey
FROM r JOIN c ON r.p_type = c.p_type AND r.brand IS NOT DISTINCT FROM c.brand
WHERE u * tot >= (hi - p_size) * 4294967296 AND u * tot < hi * 4294967296
""")
def weighted_choice(t):
    return choice.weighted_choice(
        event_rows(t), part_codes(t), ["p_type", "brand"], "p_partkey", "p_size", ["event_id"], 42
    ).select("event_id", "p_type", "brand", "p_partkey")


@query(f"""
WITH r AS ({EVENT_ROWS_SQL}), c AS ({PART_CODES_SQL})
SELECT r.event_id, r.p_type, r.brand, c.p_partkey
FROM r JOIN c ON r.p_type = c.p_type AND r.brand IS NOT DISTINCT FROM c.brand
WHERE u * tot >= (hi - p_size) * 4294967296 AND u * tot < hi * 4294967296
""")
def weighted_choice_large(t):
    """The same choice with categories cut into many parts, as for categories of very many rows."""
    return choice.weighted_choice(
        event_rows(t), part_codes(t), ["p_type", "brand"], "p_partkey", "p_size", ["event_id"], 42,
        target_rows=40,
    ).select("event_id", "p_type", "brand", "p_partkey")


@query(f"""
SELECT p_type, p_partkey, CAST(sum(p_size) OVER (PARTITION BY p_type) AS BIGINT) AS total,
       CAST(sum(p_size) OVER w - p_size AS BIGINT) AS low, CAST(sum(p_size) OVER w AS BIGINT) AS high
FROM (SELECT *, {draw_sql('order', 'p_partkey')} AS place FROM part)
WINDOW w AS (PARTITION BY p_type ORDER BY place, p_partkey)
""")
def cumulative_intervals(t):
    """Running totals, previous values and group totals inside each category."""
    placed = t.part.withColumn("place", draws.draw32("order", "p_partkey"))
    totals = running.running_totals(placed, ["p_type"], "place", ["p_partkey"], {"w": F.col("p_size").cast("long")}, 100)
    return totals.select(
        "p_type", "p_partkey", F.col("w_total").alias("total"), F.col("w_before").alias("low"),
        (F.col("w_before") + F.col("w")).alias("high"),
    )


@query(f"""
WITH r AS (SELECT event_id, event_type, {draw_sql(7, 'event_type')} AS group_draw, {draw_sql(7, 'event_id')} AS row_draw
           FROM events)
SELECT event_id, event_type, group_draw, row_draw, row_draw / 4294967296.0::DOUBLE AS u FROM r
""")
def keyed_draws(t):
    """One draw per group and one per row."""
    return t.events.select(
        "event_id", "event_type", draws.draw32(7, "event_type").alias("group_draw"),
        draws.draw32(7, "event_id").alias("row_draw"), draws.uniform(7, "event_id").alias("u"),
    )


# ---- columns and rows --------------------------------------------------------------------------

def years_of(t):
    """All years of the orders."""
    first, last = t.orders.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    return range(first, last + 1)


def yearly_orders(t, year):
    """The orders of one year as a file of that year: its columns carry two digits of the year."""
    yy = f"{year % 100:02d}"
    day = F.col("o_orderdate")
    rows = t.orders.where((day >= dt.datetime(year, 1, 1)) & (day < dt.datetime(year + 1, 1, 1)))
    return rows.select(
        F.col("o_orderkey").alias("DUPERSID"), F.col("o_custkey").alias("DOBYY"),
        F.col("o_totalprice").alias(f"TOTEXP{yy}"), F.col("o_orderpriority").alias(f"MARRY{yy}X"),
        F.col("o_totalprice").alias(f"PERWT{yy}F"),
    )


@query("""
SELECT o_orderkey || CAST(year(o_orderdate) AS VARCHAR) AS "ID", o_custkey AS "DOBYY", o_totalprice AS "TOTEXPYY",
       o_orderpriority AS "MARRYYYX", CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
       round(o_totalprice / (SELECT max(year(o_orderdate)) - min(year(o_orderdate)) + 1.0::DOUBLE FROM orders), 6) AS "POOLWT"
FROM orders WHERE o_totalprice >= 5000 AND o_totalprice > 0
""")
def harmonize_pool(t):
    names = ["DUPERSID", "DOBYY", "TOTEXPYY", "MARRYYYX", "PERWTYYF"]
    files = [
        columns.tag_year(columns.harmonize_year(yearly_orders(t, y), y, names), y, "DUPERSID", "ID", "YEAR")
        for y in years_of(t)
    ]
    pooled = columns.pool(*files).where("TOTEXPYY >= 5000").where("PERWTYYF > 0")
    weight = columns.pooled_weight(F.col("PERWTYYF"), len(files))
    return pooled.select("ID", "DOBYY", "TOTEXPYY", "MARRYYYX", "YEAR", F.round(weight, 6).alias("POOLWT"))


@query("""
SELECT p_partkey, nullif(trim(replace(q, '''', '')), '') AS clean, nullif(p_brand, 'Brand#3') AS brand, p_size
FROM (SELECT *, CASE WHEN p_size > 45 THEN ''' ''' ELSE '''' || p_name || '''' END AS q FROM part)
WHERE CAST(p_size AS VARCHAR) <> '15'
""")
def sentinel_clean(t):
    quoted = F.when(F.col("p_size") > 45, "' '").otherwise(F.concat(F.lit("'"), F.col("p_name"), F.lit("'")))
    kept = columns_clean(t.part)
    return kept.select("p_partkey", text.strip_quotes(quoted).alias("clean"), F.col("p_brand").alias("brand"), "p_size")


def columns_clean(part):
    return nulls.sentinel_to_null(nulls.drop_sentinel(part, ["p_size"], "15"), ["p_brand"], "Brand#3")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE (l_discount > 0.05 OR l_tax > 0.05)
  AND NOT (l_returnflag = 'A' AND l_quantity < 10) AND NOT (l_returnflag = 'R' AND l_extendedprice < 20000)
""")
def any_column_filter(t):
    """Any measure above a bound, and a threshold per label."""
    measures = t.lineitem.withColumnsRenamed({"l_discount": "m_discount", "l_tax": "m_tax"})
    sure = columns.confident(
        columns.any_column(measures, "m_", lambda c: c > 0.05), "l_returnflag",
        {"A": ("l_quantity", 10), "R": ("l_extendedprice", 20000)},
    )
    return sure.select("l_orderkey", "l_linenumber", "l_quantity", F.col("m_discount").alias("l_discount"),
                       F.col("m_tax").alias("l_tax"))


@query("""
SELECT c_nationkey, c_name, c_custkey, c_mktsegment, c_acctbal, c_custkey + c_nationkey AS numeric_sum FROM customer
""")
def column_moves(t):
    """Relocate by name and pick columns by type."""
    moved = columns.relocate(columns.relocate(t.customer, "c_nationkey"), "c_custkey", after="c_name")
    moved = columns.relocate(moved, "c_mktsegment", before="c_acctbal")
    whole = [c for c in columns.numeric_columns(moved) if c != "c_acctbal"]
    return moved.withColumn("numeric_sum", sum((F.col(c) for c in whole), F.lit(0)))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS label, o_totalprice, CAST(NULL AS VARCHAR) AS note FROM orders
UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer
""")
def union_by_name(t):
    """Duplicates are kept, and missing columns are filled with NULL."""
    people = t.customer.select(F.col("c_acctbal").alias("o_totalprice"), F.col("c_name").alias("label"),
                               F.col("c_mktsegment").alias("note"))
    sales = t.orders.select(F.col("o_orderkey").cast("string").alias("label"), "o_totalprice")
    return columns.pool(sales, people, people, fill=True)


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_columns(t):
    return t.customer.select("c_mktsegment", "c_nationkey").distinct()


# ---- joins -------------------------------------------------------------------------------------

@query("""
WITH p AS (SELECT p_partkey, p_type, nullif(p_brand, 'Brand#7') AS brand, p_size FROM part),
     s AS (SELECT p_type, brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS total_size FROM p GROUP BY 1, 2)
SELECT p.p_partkey, p.p_type, p.brand, p.p_size, s.parts, s.total_size
FROM p JOIN s ON p.p_type = s.p_type AND p.brand IS NOT DISTINCT FROM s.brand
""")
def natural_nullsafe_join(t):
    parts = part_codes(t)
    sizes = parts.groupBy("p_type", "brand").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("p_size").alias("total_size")
    )
    return joins.natural_join(parts, sizes)


@query("""
WITH c AS (SELECT c_custkey, nullif(c_custkey // 20, 3) AS grp FROM customer),
     s AS (SELECT s_suppkey, nullif(s_suppkey // 3, 3) AS grp, s_name FROM supplier)
SELECT c.c_custkey, c.grp, s.s_suppkey, s.s_name FROM c LEFT JOIN s ON c.grp IS NOT DISTINCT FROM s.grp
""")
def natural_left_join(t):
    """Left join many to many, where a missing key matches a missing key."""
    people = t.customer.select("c_custkey", F.expr("nullif(c_custkey div 20, 3L)").alias("grp"))
    sellers = t.supplier.select("s_suppkey", F.expr("nullif(s_suppkey div 3, 3L)").alias("grp"), "s_name")
    return joins.natural_join(people, sellers, "left")


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_partkey END AS code FROM lineitem),
d AS (SELECT p_partkey AS code, p_brand AS brand FROM part WHERE p_partkey % 10 > 0 UNION ALL SELECT NULL, 'missing')
SELECT l_orderkey, l_linenumber, v.code, brand FROM v LEFT JOIN d ON v.code IS NOT DISTINCT FROM d.code
""")
def heavy_key_join(t):
    """A dimension row for every line, where a third of the lines share one key."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber",
                              F.when(F.col("l_orderkey") % 3 != 0, F.col("l_partkey")).alias("code"))
    known = t.part.where("p_partkey % 10 > 0").select(F.col("p_partkey").alias("code"), F.col("p_brand").alias("brand"))
    missing = t.spark.createDataFrame([(None, "missing")], known.schema)
    return joins.join_heavy(lines, known.unionByName(missing), ["code"], "left")


@query("""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def anti_residual(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey")
    return joins.not_in(t.customer.select("c_custkey", "c_name", "c_mktsegment"), urgent, ["c_custkey"])


@query("""
WITH span AS (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1)
SELECT o_orderkey, n1.n_name AS buyer_name, n1.n_regionkey AS buyer_region,
       n2.n_name AS second_name, n2.n_regionkey AS second_region
FROM orders JOIN span ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation n1 ON n1.n_nationkey = c_nationkey
LEFT JOIN nation n2 ON n2.n_nationkey = nullif(CAST(o_orderkey % 30 AS INTEGER), 5)
WHERE CAST(o_orderdate AS DATE) <= DATE '1998-12-31' AND CAST(last_ship AS DATE) >= DATE '1998-12-31'
""")
def payer_as_of(t):
    """Intervals that hold a day, and one dimension in two roles."""
    span = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    sold = t.orders.where(F.to_date("o_orderdate") <= dt.date(1998, 12, 31)).join(
        span, F.col("o_orderkey") == F.col("l_orderkey")
    )
    held = sold.where(dates.covers(F.to_date("o_orderdate"), F.to_date("last_ship"), dt.date(1998, 12, 31)))
    keyed = held.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "second", F.nullif((F.col("o_orderkey") % 30).cast("int"), F.lit(5))
    )
    both = joins.dimension_roles(keyed, t.nation, "n_nationkey",
                                 [("c_nationkey", "b_", "inner"), ("second", "s_", "left")])
    return both.select("o_orderkey", F.col("b_n_name").alias("buyer_name"), F.col("b_n_regionkey").alias("buyer_region"),
                       F.col("s_n_name").alias("second_name"), F.col("s_n_regionkey").alias("second_region"))


# Spells of a customer start with an order; the customers of one segment share a key and have short spells.
_SPELL = {
    "holder": "CASE WHEN c_mktsegment = 'BUILDING' THEN -1 ELSE c_custkey END",
    "spell": "o_orderkey", "payer": "'R' || CAST(o_orderkey % 5 AS STRING)",
    "starts": "CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END",
    "ends": "CAST(o_orderdate AS DATE) + CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN o_orderkey % 3 - 1 "
            "ELSE o_orderkey % 1100 END AS INT)",
}
_VISIT = {
    "holder": _SPELL["holder"], "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "visit": "CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) END",
}
_SPELLS_SQL = select_sql("orders JOIN customer ON o_custkey = c_custkey", _SPELL)
_VISITS_SQL = select_sql("lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey", _VISIT)


def spells_and_visits(t):
    held = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return select(held, _SPELL), select(held.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")), _VISIT)


@query(f"""
SELECT v.holder, l_orderkey, l_linenumber, visit, spell, payer, starts, ends
FROM ({_VISITS_SQL}) v JOIN ({_SPELLS_SQL}) s ON v.holder = s.holder AND visit BETWEEN starts AND ends
""")
def payer_each_visit(t):
    """The payer spells in force on the own day of each visit; one holder has a fifth of both sides."""
    spells, visits = spells_and_visits(t)
    return intervals.interval_join(visits, spells, ["holder"], "visit", "starts", "ends")


@query(f"""
SELECT l_orderkey, l_linenumber, count(spell) AS spells, min(spell) AS first_spell
FROM ({_VISITS_SQL}) v LEFT JOIN ({_SPELLS_SQL}) s ON v.holder = s.holder AND visit BETWEEN starts AND ends GROUP BY 1, 2
""")
def payers_counted(t):
    """Every visit with the number of its spells, none for a visit without a day."""
    spells, visits = spells_and_visits(t)
    both = intervals.interval_join(visits, spells, ["holder"], "visit", "starts", "ends", "left",
                                   {"spells": F.count("spell"), "first_spell": F.min("spell")})
    return both.groupBy("l_orderkey", "l_linenumber").agg(
        F.coalesce(F.sum("spells"), F.lit(0)).alias("spells"), F.min("first_spell").alias("first_spell"))


@query("""
SELECT c.n AS nation, c.name AS name_x, c.bal AS bal_x, s.name AS name_y, s.bal AS bal_y
FROM (SELECT c_nationkey AS n, c_name AS name, c_acctbal AS bal FROM customer) c
LEFT JOIN (SELECT s_nationkey AS n, min(s_name) AS name, max(s_acctbal) AS bal FROM supplier GROUP BY 1) s USING (n)
""")
def suffix_join(t):
    buyers = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"),
                               F.col("c_acctbal").alias("bal"))
    sellers = t.supplier.groupBy("s_nationkey").agg(F.min("s_name").alias("name"), F.max("s_acctbal").alias("bal"))
    return joins.join_keyed(buyers, sellers, {"nation": "s_nationkey"}, "left")


@query("""
WITH seg AS (SELECT c_mktsegment, avg(c_acctbal) AS m FROM customer GROUP BY 1),
     nat AS (SELECT c_nationkey, avg(c_acctbal) AS m FROM customer GROUP BY 1)
SELECT c_custkey, 1 AS position, 'same segment (' || c_mktsegment || ')' AS breakout,
       round(seg.m, 6) AS peer_mean, c_acctbal AS own
FROM customer JOIN seg USING (c_mktsegment)
UNION ALL
SELECT c_custkey, 2, 'same nation', round(nat.m, 6), c_acctbal FROM customer JOIN nat USING (c_nationkey)
""")
def peer_lookup(t):
    def mean(by):
        return t.customer.groupBy(by).agg(F.round(F.avg("c_acctbal"), 6).alias("peer_mean"))

    label = F.concat(F.lit("same segment ("), F.col("c_mktsegment"), F.lit(")"))
    cuts = [joins.peers(t.customer, mean("c_mktsegment"), ["c_mktsegment"], label, 1),
            joins.peers(t.customer, mean("c_nationkey"), ["c_nationkey"], F.lit("same nation"), 2)]
    return columns.pool(*[c.select("c_custkey", "position", "breakout", "peer_mean", F.col("c_acctbal").alias("own"))
                          for c in cuts])


# ---- codes -------------------------------------------------------------------------------------

CLASSES = {"econ": ["ECO"], "big": ["LARG", "MED"], "small": ["SMA"], "promo": ["PROM"], "std": ["STAN", "STA"],
           "l_or_s": ["LAR", "SMAL"]}
WEIGHTS = {"econ": 3, "big": -1, "small": 0, "promo": 7, "std": 2, "l_or_s": 4}
FLAGS_SQL = ", ".join(
    f"max(CASE WHEN {' OR '.join(f'p_type LIKE {chr(39)}{p}%{chr(39)}' for p in ps)} THEN 1 ELSE 0 END) AS {c}"
    for c, ps in CLASSES.items()
)
SCORE_SQL = " + ".join(f"{c} * ({w})" for c, w in WEIGHTS.items())


def bought_types(t):
    """Every customer with the part types of their line items; customers without any have NULL."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    return t.customer.join(lines, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.when(F.col("l_quantity") > 45, F.col("p_type")).alias("code")
    )


@query(f"""
WITH f AS (
  SELECT c_custkey, {FLAGS_SQL.replace('p_type LIKE', 'code LIKE')} FROM (
    SELECT c_custkey, CASE WHEN l_quantity > 45 THEN p_type END AS code FROM customer
    LEFT JOIN (SELECT o_custkey, l_quantity, p_type FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               JOIN part ON l_partkey = p_partkey) ON c_custkey = o_custkey)
  GROUP BY 1),
s AS (SELECT *, {SCORE_SQL} AS score FROM f)
SELECT c_custkey, "Field_Name", CAST("Field_Value" AS INTEGER) AS "Field_Value"
FROM (UNPIVOT s ON {', '.join(CLASSES)}, score INTO NAME "Field_Name" VALUE "Field_Value")
""")
def prefix_code_flags(t):
    flags = codes.prefix_flags(bought_types(t), "c_custkey", "code", CLASSES, WEIGHTS)
    return codes.long_flags(flags, "c_custkey")


# ---- aggregates --------------------------------------------------------------------------------

@query("""
WITH l AS (SELECT o_custkey, p_brand, l_orderkey, nullif(l_linenumber, 7) AS line, CAST(l_quantity AS BIGINT) AS qty,
                  CASE WHEN l_discount < 0.10 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS cents,
                  CAST(year(o_orderdate) AS INTEGER) AS yr
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
SELECT o_custkey, p_brand, count(DISTINCT l_orderkey) AS n_orders,
       count(DISTINCT line) + max(CASE WHEN line IS NULL THEN 1 ELSE 0 END) AS n_lines,
       CAST(sum(qty) AS BIGINT) AS qty,
       CAST(CASE WHEN count(cents) = count(*) THEN sum(cents) END AS BIGINT) AS cents,
       CAST(CASE WHEN count(cents) = count(*) THEN sum(cents) END - sum(qty) AS BIGINT) AS cents_less_qty,
       CASE WHEN 2001 - min(yr) = 0 THEN 'Less than a year'
            ELSE (2001 - min(yr)) || ' to ' || (2002 - min(yr)) || ' years' END AS span
FROM l GROUP BY 1, 2
""")
def strict_sum_distinct(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    ).select(
        "o_custkey", "p_brand", "l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("line"),
        F.col("l_quantity").cast("long").alias("qty"), F.year("o_orderdate").alias("yr"),
        F.when(F.col("l_discount") < 0.10, F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"),
    )
    sums = lines.groupBy("o_custkey", "p_brand").agg(
        F.count_distinct("l_orderkey").alias("n_orders"), nulls.distinct_count("line").alias("n_lines"),
        F.sum("qty").alias("qty"), nulls.strict_sum("cents").alias("cents"), F.min("yr").alias("first_year"),
    )
    return sums.select(
        "o_custkey", "p_brand", "n_orders", "n_lines", "qty", "cents",
        (F.col("cents") - F.col("qty")).alias("cents_less_qty"),
        dates.span_words(F.lit(2001), "first_year").alias("span"),
    )


@query("""
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS source, nullif(o_orderpriority, '5-LOW') AS cat FROM orders)
SELECT source, cat, count(*) AS n, round(count(*) / (SELECT count(*) FROM o b WHERE b.source = o.source), 9) AS share
FROM o WHERE cat IS NOT NULL GROUP BY 1, 2
""")
def relative_freq(t):
    rows = t.orders.select(F.year("o_orderdate").alias("source"),
                           F.nullif("o_orderpriority", F.lit("5-LOW")).alias("cat"))
    return aggregates.shares(rows, "cat", "source").withColumn("share", F.round("share", 9))


@query("""
WITH p AS (SELECT o_custkey AS "ID", o_orderpriority AS label, count(*) AS n,
                  CASE WHEN min(o_totalprice) > 20000 THEN CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) END AS cents,
                  CAST(year(min(o_orderdate)) AS VARCHAR) AS since
           FROM orders GROUP BY 1, 2)
SELECT * FROM p
UNION ALL SELECT "ID", 'Total', CAST(sum(n) AS BIGINT),
  CASE WHEN count(cents) = count(*) THEN CAST(sum(cents) AS BIGINT) END, NULL FROM p GROUP BY 1
""")
def total_row(t):
    """A total with a missing part is missing."""
    rows = t.orders.groupBy(F.col("o_custkey").alias("ID"), F.col("o_orderpriority").alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(F.min("o_totalprice") > 20000, F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))).alias("cents"),
        F.year(F.min("o_orderdate")).cast("string").alias("since"),
    )
    return columns.total_row(rows, "label", by=["ID"])


@query("""
SELECT c_mktsegment, c_nationkey, count(*) AS count, count(*) >= 60 AS large_enough
FROM customer WHERE c_acctbal > 0 GROUP BY 1, 2
""")
def cell_size(t):
    return survey.cell_sizes(t.customer.where("c_acctbal > 0"), ["c_mktsegment", "c_nationkey"])


@query("SELECT round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 6) AS sd FROM customer")
def mean_and_sd(t):
    return aggregates.moments(t.customer, "c_acctbal").select(F.round("mean", 6).alias("mean"),
                                                             F.round("sd", 6).alias("sd"))


@query("""
SELECT event_id, round((value - a.m) / a.s * b.s + a.m, 6) AS stretched
FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) a,
     (SELECT stddev_samp(c_acctbal) AS s FROM customer) b
""")
def moment_rescale(t):
    out = aggregates.stretch(t.events, "value", "stretched", t.customer, "c_acctbal")
    return out.select("event_id", F.round("stretched", 6).alias("stretched"))


@query("""
SELECT n_name AS state, count(*) AS pop,
       CAST(trunc(80000.0::DOUBLE * count(*) / (SELECT count(*) FROM customer WHERE c_nationkey <> 24)) AS INTEGER)
         AS simulate
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> 'NATION_24' GROUP BY 1
""")
def state_allocation(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).where("n_name <> 'NATION_24'")
    sizes = people.groupBy(F.col("n_name").alias("state")).agg(F.count(F.lit(1)).alias("pop"))
    return aggregates.proportional(sizes, "pop", 80_000, "simulate")


@query("SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1")
def first_per_group(t):
    return aggregates.first_by(t.orders, ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("""
SELECT c_custkey, c_name, count(o_orderkey) AS n,
  CASE count(o_orderkey) WHEN 0 THEN c_name || ' placed no orders.'
    WHEN 1 THEN c_name || ' placed 1 order.' ELSE c_name || ' placed ' || count(o_orderkey) || ' orders.' END AS said
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey GROUP BY 1, 2
""")
def counted_sentence(t):
    """Rows per person, zero included, and the sentence that tells them."""
    open_orders = t.orders.where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "c_custkey")
    counts = aggregates.count_or_zero(t.customer, open_orders, "c_custkey", "n")
    name, n = F.col("c_name"), F.col("n").cast("string")
    said = text.counted("n", F.concat(name, F.lit(" placed no orders.")),
                        F.concat(name, F.lit(" placed "), n, F.lit(" order.")),
                        F.concat(name, F.lit(" placed "), n, F.lit(" orders.")))
    return counts.select("c_custkey", "c_name", "n", said.alias("said"))


# ---- survey ------------------------------------------------------------------------------------

SURVEY_ROWS_SQL = """
    SELECT n_regionkey AS h, n_nationkey AS i, CAST(o_custkey % 7 + 1 AS DOUBLE) AS w, o_totalprice AS y,
           c_mktsegment AS seg, o_orderstatus <> 'P' AND c_acctbal > 0 AS d
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
DESIGN = survey.SurveyDesign("n_regionkey", "n_nationkey", "w")


def survey_rows(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).withColumn("w", (F.col("o_custkey") % 7 + 1).cast("double"))


def _survey_sql(by: str, multiplier: str) -> str:
    """Textbook form: linearised values per row, cluster totals on the full grid, centred squares."""
    by_list, using, group = (f"{by}, ", f"USING ({by})", f"GROUP BY {by}") if by else ("", "ON true", "")
    return f"""
WITH r AS ({SURVEY_ROWS_SQL}),
m AS (SELECT {by_list}sum(w * y) / sum(w) AS mean, sum(w) AS tot FROM r WHERE d {group}),
grid AS (SELECT {by_list}mean, tot, h, i FROM m CROSS JOIN (SELECT DISTINCT h, i FROM r)),
z AS (SELECT {by_list}h, i, sum(w * (y - mean) / tot) AS z FROM r JOIN m {using} WHERE d GROUP BY {by_list}h, i),
g AS (SELECT grid.*, coalesce(z, 0) AS z FROM grid LEFT JOIN z USING ({by_list}h, i)),
s AS (SELECT {by_list}mean, h, count(*) / (count(*) - 1) * sum((z - zbar) ** 2) AS v
      FROM (SELECT *, avg(z) OVER (PARTITION BY {by_list}h) AS zbar FROM g) GROUP BY {by_list}mean, h),
f AS (SELECT {by_list}mean, sqrt(sum(v)) AS se FROM s GROUP BY {by_list}mean)
SELECT {by_list}round(mean, 4) AS price, round(se, 4) AS price_se, round(mean - {multiplier} * se, 4) AS price_low,
       round(mean + {multiplier} * se, 4) AS price_upp, round(se / mean, 9) AS price_rse
FROM f"""


def _rounded(means, *by):
    return means.select(*by, *[F.round(c, 9 if c.endswith("_rse") else 4).alias(c)
                               for c in ("price", "price_se", "price_low", "price_upp", "price_rse")])


DOMAIN = "o_orderstatus <> 'P' AND c_acctbal > 0"


@query(_survey_sql("", "1.959963984540054"))
def survey_mean_all(t):
    return _rounded(survey.survey_mean(survey_rows(t), {"price": "o_totalprice"}, DESIGN, domain=F.expr(DOMAIN),
                                       df_t="inf", rse=True))


@query(_survey_sql("seg", "2.0859634472658364"))
def survey_mean_domain(t):
    """Means per segment with the t interval of the design: 25 clusters in 5 strata."""
    means = survey.survey_mean(survey_rows(t), {"price": "o_totalprice"}, DESIGN, ["c_mktsegment"],
                               F.expr(DOMAIN), rse=True)
    return _rounded(means.withColumnRenamed("c_mktsegment", "seg"), "seg")


# ---- ranks -------------------------------------------------------------------------------------

@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN floor(c_acctbal / 50) END AS v FROM customer)
SELECT c_custkey, percent_rank() OVER (ORDER BY v) AS pr FROM c WHERE v IS NOT NULL
UNION ALL SELECT c_custkey, NULL FROM c WHERE v IS NULL
""")
def percent_rank_exact(t):
    """Over the whole table, with ties and with missing values that take no part."""
    rows = t.customer.withColumn(
        "v", F.when(F.col("c_mktsegment") != "BUILDING", F.floor(F.col("c_acctbal") / 50).cast("double"))
    )
    return ranks.percent_rank(rows, "v", "pr").select("c_custkey", "pr")


def _horner_sql(coefficients, x):
    out = repr(float(coefficients[0])) + "::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {float(c)!r}::DOUBLE)"
    return out


def quantile_sql():
    def ratio(pair, x):
        return f"{_horner_sql(pair[0], x)} / {_horner_sql(pair[1], x)}"

    return f"""CASE WHEN abs(q) <= 0.425 THEN q * {ratio(quantiles.AS241_CENTRE, '(0.180625 - q * q)')}
        ELSE sign(q) * CASE WHEN r <= 5 THEN {ratio(quantiles.AS241_SHOULDER, '(r - 1.6)')}
                            ELSE {ratio(quantiles.AS241_TAIL, '(r - 5.0)')} END END"""


@query(f"""
WITH o AS (SELECT c_acctbal AS sample, row_number() OVER (ORDER BY c_acctbal) AS position, count(*) OVER () AS n
           FROM customer),
p AS (SELECT *, (position - 0.5::DOUBLE) / n AS p FROM o),
q AS (SELECT *, p - 0.5 AS q, sqrt(-ln(least(p, 1 - p))) AS r FROM p)
SELECT sample, position, round({quantile_sql()}, 9) AS theoretical FROM q
""")
def qq_points(t):
    points = ranks.normal_points(t.customer, "c_acctbal")
    return points.withColumn("theoretical", F.round("theoretical", 9))


# ---- matching ----------------------------------------------------------------------------------

SEGMENT = "BUILDING"
MATCH_SQL = f"""
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY c_nationkey, treated ORDER BY u, c_custkey) - 1 AS rk,
             sum(treated) OVER (PARTITION BY c_nationkey) AS nt, sum(1 - treated) OVER (PARTITION BY c_nationkey) AS nc
      FROM (SELECT *, CASE WHEN c_mktsegment = '{SEGMENT}' THEN 1 ELSE 0 END AS treated,
                   {draw_sql(7, 'c_custkey')} AS u FROM customer)),
    paired AS (
      SELECT *, length(CAST(c_nationkey AS VARCHAR)) || ':' || c_nationkey || '|' || CAST(CASE WHEN treated = 1 THEN rk ELSE rk % nt END AS BIGINT) AS subclass
      FROM ranked WHERE nt > 0 AND ((treated = 1 AND rk < nc) OR (treated = 0 AND rk < 3 * nt))),
    sized AS (SELECT *, sum(1 - treated) OVER (PARTITION BY subclass) AS k FROM paired),
    matched AS (
      SELECT *, CASE WHEN treated = 1 THEN 1.0::DOUBLE
                     ELSE sum(1 - treated) OVER () / sum(treated) OVER () / k END AS weights FROM sized)"""


def treated_customers(t):
    return t.customer.withColumn("treated", (F.col("c_mktsegment") == SEGMENT).cast("int"))


def matched_customers(t, **options):
    return matching.stratum_match(treated_customers(t), ["c_nationkey"], "treated", "c_custkey", 3, 7, **options)


@query(f"WITH {MATCH_SQL} SELECT c_custkey, c_nationkey, treated, subclass, round(weights, 9) AS weights FROM matched")
def stratum_match(t):
    return matched_customers(t).select("c_custkey", "c_nationkey", "treated", "subclass",
                                       F.round("weights", 9).alias("weights"))


@query(f"WITH {MATCH_SQL} SELECT c_custkey, c_nationkey, treated, subclass, round(weights, 9) AS weights FROM matched")
def stratum_match_large(t):
    """The same match with strata cut into slices, as for strata of very many rows."""
    return matched_customers(t, target_rows=16).select("c_custkey", "c_nationkey", "treated", "subclass",
                                                       F.round("weights", 9).alias("weights"))


@query(f"""
WITH {MATCH_SQL}
SELECT x.c_custkey AS control, y.c_custkey AS treated, x.c_nationkey AS nation, x.c_mktsegment AS segment, x.subclass
FROM matched x JOIN matched y ON x.subclass = y.subclass AND x.treated = 0 AND y.treated = 1
""")
def matched_pairs(t):
    pairs = matching.matched_pairs(matched_customers(t), "treated")
    return pairs.select(F.col("c_custkey_x").alias("control"), F.col("c_custkey_y").alias("treated"),
                        F.col("c_nationkey_x").alias("nation"), F.col("c_mktsegment_x").alias("segment"), "subclass")


@query(f"""
WITH RECURSIVE {nearest_sql(f"(SELECT *, CAST(c_mktsegment = '{SEGMENT}' AS INTEGER) AS treated FROM customer)",
                            'c_nationkey', 'treated', 'c_custkey', 'c_acctbal', draw_sql(7, 'c_custkey'), 2)}
SELECT control, treated, g AS nation, control_score AS control_distance, treated_score AS treated_distance,
       abs(control_score - treated_score) AS gap FROM near
""")
def nearest_pairs(t):
    """Two controls of the nearest balance for each treated customer of a nation."""
    matched = nearest.nearest_match(treated_customers(t), ["c_nationkey"], "treated", "c_custkey", "c_acctbal", 2, 7)
    pairs = matching.matched_pairs(matched, "treated")
    return pairs.select(F.col("c_custkey_x").alias("control"), F.col("c_custkey_y").alias("treated"),
                        F.col("c_nationkey_x").alias("nation"), F.col("distance_x").alias("control_distance"),
                        F.col("distance_y").alias("treated_distance"), F.col("gap_x").alias("gap"))


BALANCE_SQL = f"""
WITH {MATCH_SQL},
u AS (SELECT 'all' AS stage, treated, c_nationkey, c_mktsegment < 'F' AS early, 1.0::DOUBLE AS w FROM ranked
      UNION ALL SELECT 'matched', treated, c_nationkey, c_mktsegment < 'F', weights FROM matched),
lv AS (SELECT stage, treated, 'c_nationkey' AS covariate, CAST(c_nationkey AS VARCHAR) AS level, w FROM u
       UNION ALL SELECT stage, treated, 'early', CAST(early AS VARCHAR), w FROM u),
tt AS (SELECT stage, covariate, sum(CASE WHEN treated = 1 THEN w END) AS nt, sum(CASE WHEN treated = 0 THEN w END) AS nc
       FROM lv GROUP BY 1, 2),
sh AS (SELECT stage, covariate, level, coalesce(sum(CASE WHEN treated = 1 THEN w END), 0) / any_value(nt) AS t,
              coalesce(sum(CASE WHEN treated = 0 THEN w END), 0) / any_value(nc) AS c
       FROM lv JOIN tt USING (stage, covariate) GROUP BY 1, 2, 3),
w AS (SELECT a.covariate, a.level, a.t AS ta, a.c AS ca, coalesce(m.t, 0) AS tm, coalesce(m.c, 0) AS cm,
             nullif(sqrt(a.t * (1 - a.t)), 0) AS sd
      FROM sh a LEFT JOIN sh m ON m.stage = 'matched' AND m.covariate = a.covariate AND m.level = a.level
      WHERE a.stage = 'all')
SELECT covariate, level, round(ta, 9) AS treated_all, round(ca, 9) AS control_all,
       round((ta - ca) / sd, 6) AS std_diff_all, round(tm, 9) AS treated_matched, round(cm, 9) AS control_matched,
       round((tm - cm) / sd, 6) + 0.0::DOUBLE AS std_diff_matched
FROM w"""


@query(BALANCE_SQL)
def balance_table(t):
    def early(df):
        return df.withColumn("early", F.col("c_mktsegment") < "F")

    table = balance.balance(early(treated_customers(t)), early(matched_customers(t)), ["c_nationkey", "early"],
                            "treated")
    places = {"std_diff_all": 6, "std_diff_matched": 6}
    return table.select("covariate", "level", *[
        (F.round(c, places.get(c, 9)) + F.lit(0.0)).alias(c) for c in table.columns[2:]
    ])


@query(f"""
WITH {MATCH_SQL},
s AS (SELECT sum(w) FILTER (treated = 1) AS wt, sum(w) FILTER (treated = 0) AS wc,
             sum(w * w) FILTER (treated = 0) AS wc2, avg(x) FILTER (treated = 1) AS mt,
             var_samp(x) FILTER (treated = 1) AS vt, sum(w * x) FILTER (treated = 0) / sum(w) FILTER (treated = 0) AS mc
      FROM (SELECT treated, weights AS w, c_acctbal AS x FROM matched)),
v AS (SELECT sum(weights * (c_acctbal - mc) ** 2) * any_value(wc) / (any_value(wc) ** 2 - any_value(wc2)) AS vc
      FROM matched, s WHERE treated = 0)
SELECT 'c_acctbal' AS covariate, round(mt, 4) AS treated_mean, round(mc, 4) AS control_mean,
       round((mt - mc) / sqrt(vt), 6) AS std_diff, round(vt / vc, 6) AS variance_ratio FROM s, v
""")
def balance_numeric(t):
    out = balance.numeric_balance(matched_customers(t), "c_acctbal", "treated", "weights")
    return out.select("covariate", *[F.round(c, p).alias(c) for c, p in
                                     (("treated_mean", 4), ("control_mean", 4), ("std_diff", 6), ("variance_ratio", 6))])


@query("""
SELECT c_custkey, round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END)
                          OVER (PARTITION BY c_nationkey), 6) AS distance FROM customer
""")
def propensity_one_factor(t):
    """With one factor the fitted score is the treated share of each level."""
    scored = balance.propensity(treated_customers(t), ["c_nationkey"], "treated")
    return scored.select("c_custkey", F.round("distance", 6).alias("distance"))


@query("""
WITH p AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS treated, n_regionkey, c_acctbal < 0 AS debtor
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT 'n_regionkey' AS covariate, CAST(n_regionkey AS VARCHAR) AS level, CAST(sum(treated) AS DOUBLE) AS scores FROM p GROUP BY 2
UNION ALL SELECT 'debtor', CAST(debtor AS VARCHAR), CAST(sum(treated) AS DOUBLE) FROM p GROUP BY 2
""")
def propensity(t):
    """The score equations of the fit: per level of each covariate, the scores add up to the treated rows."""
    people = treated_customers(t).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "debtor", F.col("c_acctbal") < 0
    )
    return score_sums(balance.propensity(people, ["n_regionkey", "debtor"], "treated"), ["n_regionkey", "debtor"])


def score_sums(scored, covariates):
    return balance.levels(scored, covariates, "distance").withColumn("scores", F.round("scores", 3))


# ---- sampling, reshape -------------------------------------------------------------------------

@query(f"""
WITH s AS (SELECT o_custkey FROM orders ORDER BY {draw_sql(11, 'o_orderkey')}, o_orderkey LIMIT 200),
d AS (SELECT o_custkey, CAST(row_number() OVER (ORDER BY o_custkey) AS INTEGER) AS n
      FROM (SELECT DISTINCT o_custkey FROM s))
SELECT d.n, c_custkey, c_name, o_orderkey, o_totalprice
FROM d JOIN customer ON c_custkey = d.o_custkey LEFT JOIN orders o ON o.o_custkey = c_custkey
""")
def sample_profiles(t):
    """Sampled rows, their distinct people numbered, and every person's orders in one go."""
    chosen = sampling.sample_ids(t.orders, 200, "o_orderkey", "o_custkey", 11).withColumnRenamed("o_custkey", "who")
    people = chosen.join(t.customer, F.col("who") == F.col("c_custkey"))
    return people.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "n", "c_custkey", "c_name", "o_orderkey", "o_totalprice"
    )


@query("""
SELECT p_partkey, 'p_size' AS name, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part
""")
def long_pivot(t):
    parts = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return reshape.to_long(parts, ["p_partkey"], ["p_size", "p_retailprice"])


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM orders")
def nest_round_trip(t):
    nested = reshape.nest(t.orders, ["o_custkey"], ["o_orderkey", "o_orderpriority"], target_rows=5)
    return reshape.unnest(nested, ["o_custkey"])


@query("""
SELECT o_custkey, list_aggregate(list_sort(list(o_orderkey)), 'string_agg', ',') AS keys, count(*) AS n
FROM orders GROUP BY 1
""")
def nest_groups(t):
    nested = reshape.nest(t.orders, ["o_custkey"], ["o_orderkey", "o_orderpriority"])
    keys = F.transform("data", lambda s: s["o_orderkey"].cast("string"))
    return nested.select("o_custkey", F.array_join(keys, ",").alias("keys"), F.size("data").cast("long").alias("n"))


# ---- scalar functions --------------------------------------------------------------------------

BANDS_SQL = ("CASE WHEN {x} < 5 THEN 'Under 5' WHEN {x} < 18 THEN '5 - 17' WHEN {x} < 30 THEN '18 - 29' "
             "WHEN {x} < 40 THEN '30 - 39' WHEN {x} < 50 THEN '40 - 49' WHEN {x} < 60 THEN '50 - 59' "
             "WHEN {x} < 70 THEN '60 - 69' WHEN {x} < 80 THEN '70 - 79' WHEN {x} >= 80 THEN '80 and over' END")


@query(f"""
WITH a AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN DATE '2021-12-31' END AS ref, CAST(o_orderdate AS DATE) AS d,
         o_orderpriority, o_orderstatus, o_totalprice FROM orders),
b AS (SELECT *, datediff('day', d, ref) / 365.25::DOUBLE * 4 - 20 AS age FROM a)
SELECT o_orderkey, round(age, 9) AS age, {BANDS_SQL.format(x='age')} AS grp,
       CASE WHEN age > 85 THEN 85.0::DOUBLE ELSE age END AS top,
       CASE WHEN o_totalprice < 20000 THEN 'low'
            WHEN o_orderpriority = '1-URGENT' THEN 'urgent' WHEN o_orderpriority = '2-HIGH' THEN 'high'
            ELSE 'other' END AS grade,
       CASE WHEN age IS NULL THEN NULL WHEN age <= 65 THEN 'young' ELSE 'old' END AS side,
       CAST(floor(age) AS BIGINT) AS age_floor, CAST(ceil(age) AS BIGINT) AS age_ceil,
       CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, strftime(d, '%b') AS mon,
       make_date(year(d), month(d), 1 + CAST(floor({draw_sql(5, 'o_orderkey')} * 28 / 4294967296.0::DOUBLE) AS BIGINT))
         AS drawn,
       coalesce(nullif(o_orderstatus, 'F'), 'none') AS status
FROM b
""")
def age_band_recode(t):
    day = F.to_date("o_orderdate")
    ref = F.when(F.col("o_orderstatus") != "P", F.lit(dt.date(2021, 12, 31)))
    aged = t.orders.withColumn("age", dates.years_between(day, ref) * 4 - 20)
    age = F.col("age")
    grade = recode.first_rule(
        (F.col("o_totalprice") < 20000, "low"),
        default=recode.recode("o_orderpriority", {"1-URGENT": "urgent", "2-HIGH": "high"}, "other"),
    )
    return aged.select(
        "o_orderkey", F.round(age, 9).alias("age"), recode.band("age").alias("grp"),
        recode.top_code("age", 85.0).alias("top"), grade.alias("grade"),
        nulls.if_known(age <= 65, "young", "old").alias("side"),
        F.floor(age).alias("age_floor"), F.ceil(age).alias("age_ceil"),
        F.year(day).alias("y"), F.month(day).alias("m"), F.date_format(day, "MMM").alias("mon"),
        dates.drawn_day(F.year(day), F.month(day), 5, "o_orderkey").alias("drawn"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("F")), F.lit("none")).alias("status"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_size / 2.0 BETWEEN 5 AND 17 THEN '5 - 17' WHEN p_size / 2.0 < 5 THEN 'Under 5'
  WHEN p_size / 2.0 BETWEEN 18 AND 29 THEN '18 - 29'
  ELSE regexp_replace(CAST(p_size / 2.0::DOUBLE AS VARCHAR), '\\.0$', '') END AS grp
FROM part
""")
def whole_age_band(t):
    """Closed bands on whole ages: 17.5 falls between two bands and stays a number."""
    return t.part.select("p_partkey", recode.whole_band(F.col("p_size") / 2).alias("grp"))


TITLE_SQL = ("array_to_string(list_transform(string_split(lower({c}), ' '), lambda w: array_to_string("
             "list_transform(string_split(w, '-'), lambda s: upper(s[1]) || s[2:]), '-')), ' ')")


@query(f"""
SELECT p_partkey, {TITLE_SQL.format(c="p_type || ' non-' || p_name")} AS title,
       trim(regexp_replace('  ' || p_name || chr(10) || chr(9) || p_type || ' ', '\\s+', ' ', 'g')) AS squished,
       regexp_replace(p_brand || '.x.#', '[[:punct:]]', '') AS no_punct, substr(p_name, 1, 3) AS pre,
       upper(p_name) AS up, replace(p_name, 'ring', 'loop') AS replaced,
       concat_ws('-', p_name, nullif(p_type, 'PROMO')) AS joined,
       CASE WHEN p_name LIKE '%s' THEN p_name || '''' ELSE p_name || '''s' END AS owner,
       CASE p_size % 2 WHEN 0 THEN 'him' ELSE 'her' END AS obj, CASE p_size % 2 WHEN 0 THEN 'his' ELSE 'her' END AS pos,
       '$' || format('{{:,.2f}}', p_retailprice) AS price, CAST(p_size AS VARCHAR) AS whole,
       TRY_CAST(split_part(p_name, ' ', 1) AS INTEGER) AS bad, CAST(trunc(p_retailprice) AS INTEGER) AS whole_price
FROM part
""")
def title_squish_text(t):
    gender = F.when(F.col("p_size") % 2 == 0, "Male").otherwise("Female")
    objective, owning = text.pronouns(gender)
    messy = F.concat(F.lit("  "), F.col("p_name"), F.lit("\n\t"), F.col("p_type"), F.lit(" "))
    return t.part.select(
        "p_partkey", text.title_case(F.concat("p_type", F.lit(" non-"), "p_name")).alias("title"),
        text.squish(messy).alias("squished"),
        text.drop_first_punctuation(F.concat("p_brand", F.lit(".x.#"))).alias("no_punct"),
        text.code_prefix("p_name").alias("pre"), F.upper("p_name").alias("up"),
        F.regexp_replace("p_name", "ring", "loop").alias("replaced"),
        F.concat_ws("-", "p_name", F.nullif("p_type", F.lit("PROMO"))).alias("joined"),
        text.possessive("p_name").alias("owner"), objective.alias("obj"), owning.alias("pos"),
        text.dollars("p_retailprice").alias("price"), text.whole_text(F.col("p_size").cast("double")).alias("whole"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).try_cast("int").alias("bad"),
        F.col("p_retailprice").cast("int").alias("whole_price"),
    )


@query("""
SELECT doc_id, regexp_replace(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')),
                                             '(.{1,50})(?:\\s+|$)', '\\1' || chr(10), 'g'), '\\n$', '') AS wrapped
FROM documents
""")
def wrapped_text(t):
    """Line breaks in whole texts."""
    return t.documents.select("doc_id", text.wrap(text.squish("text"), 50).alias("wrapped"))


@query("""
SELECT l_partkey, p_type, CAST(sum(l_quantity) AS BIGINT) AS qty
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#12' GROUP BY 1, 2
""")
def parameter_pick(t):
    """Rows picked by a parameter, pushed to the scan of the dimension."""
    parts = t.part.where(F.col("p_brand") == F.lit("Brand#12"))
    return t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_partkey", "p_type").agg(
        F.sum("l_quantity").cast("long").alias("qty")
    )


# ---- sources and sinks -------------------------------------------------------------------------

@query("SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment, c_name, c_acctbal FROM customer")
def csv_round_trip(t):
    """Written with a header and "NA" for missing, read with a schema in another column order."""
    path = new_path(t)
    rows = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    writers.write_table(rows, path, csv=True)
    return readers.read_csv(t.spark, path, "c_custkey long, c_mktsegment string, c_name string, c_acctbal double")


def new_path(t) -> str:
    return f"{shared_folder(t.spark)}/strataloom-{uuid.uuid4().hex}"


@query("""
SELECT 'P' || p_partkey AS code, nullif(trim(CASE WHEN p_size > 40 THEN ' ' ELSE p_type END), '') AS kind FROM part
""")
def quoted_scan(t):
    """Values in single quotes below two title lines, with spaces in the column names."""
    names = ["THE CODE", "THE NAME", "THE KIND"]
    head = t.spark.createDataFrame([("Code table,,",), ("Version 1,,",), ("'THE CODE','THE NAME','THE KIND'",)],
                                   "value string")
    kind = F.when(F.col("p_size") > 40, F.lit(" ")).otherwise(F.col("p_type"))
    lines = t.part.select(F.concat(F.lit("'P"), F.col("p_partkey").cast("string"), F.lit("','"), F.col("p_name"),
                                   F.lit("','"), kind, F.lit("'")).alias("value"))
    path = new_path(t)
    head.coalesce(1).unionByName(lines).write.text(path)
    return readers.read_quoted_csv(t.spark, path, {"THE CODE": "code", "THE KIND": "kind"}, names, ["Code table", "Version 1"])


@query("""
SELECT 'P' || p_partkey AS code, nullif(trim(CASE WHEN p_size > 40 THEN ' ' ELSE p_type END), '') AS kind FROM part
""")
def quoted_skip(t):
    """The same table in three files, each below two lines of any text."""
    names = ["THE CODE", "THE NAME", "THE KIND"]
    kind = F.when(F.col("p_size") > 40, F.lit(" ")).otherwise(F.col("p_type"))
    lines = t.part.select("p_partkey", F.concat(F.lit("'P"), F.col("p_partkey").cast("string"), F.lit("','"), F.col("p_name"),
                                                F.lit("','"), kind, F.lit("'")).alias("value"))
    path = new_path(t)
    for k in range(3):
        head = t.spark.createDataFrame([(f"'P{k}','a title','like data'",), (f"Version {k}",), ("'THE CODE','THE NAME','THE KIND'",)],
                                       "value string")
        own = lines.where(F.col("p_partkey") % 3 == k).select("value")
        head.coalesce(1).unionByName(own).coalesce(1).write.mode("append").text(path)
    return readers.read_quoted_csv(t.spark, path, {"THE CODE": "code", "THE KIND": "kind"}, names, skip=2)


@query("SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT n_nationkey, n_name FROM nation")
def export_subset(t):
    """Two tables of three are written, each below the base folder, and read back."""
    path = new_path(t)
    tables = {"customer": t.customer, "nation": t.nation, "region": t.region}
    writers.export_subset(tables, ["customer", "nation"], path)
    return t.spark.read.parquet(f"{path}/customer").selectExpr("c_custkey AS key", "c_name AS name").unionByName(
        t.spark.read.parquet(f"{path}/nation").selectExpr("CAST(n_nationkey AS BIGINT) AS key", "n_name AS name"))


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderstatus = 'O'
""")
def partitioned_source(t):
    """A table by kind and year; each year is read by itself, from its own folder, and pooled."""
    path = new_path(t)
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("kind"), F.year("o_orderdate").alias("year"))
    writers.write_table(rows, path, partition_by=["kind", "year"])
    return columns.pool(*[
        readers.read_partition(t.spark, path, "o_orderkey long", kind="O", year=y).withColumn("year", F.lit(y))
        for y in years_of(t)
    ])


@query("SELECT n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT c_custkey, c_name FROM customer")
def append_batches(t):
    """The first batch replaces the table, the next one is appended."""
    path = new_path(t)
    writers.write_batches([
        t.nation.select(F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("name")),
        t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
    ], path)
    return t.spark.read.schema("key long, name string").parquet(path)
