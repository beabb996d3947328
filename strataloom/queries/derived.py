"""Population and claims-like tables that Spark derives from the star-schema tables.

Every table is one row per source row, so work grows with the sources. The column expressions are
plain SQL that Spark and an ordinary SQL engine read alike; they are the only thing both sides of
a comparison share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import lookups as L
from ..sources.schemas import FILL_COLUMNS, PERSON_COLUMNS, PERSON_DRUG_COLUMNS
from .registry import Tables

STATE_NAMES = sorted(s.strip() for names in L.STATES_BY_REGION.values() for s in names.split(","))[:24]
STATE_OF_NATION = "CASE c_nationkey " + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATE_NAMES)) + " ELSE 'Puerto Rico' END"


def select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def select_sql(source: str, columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {source}"


# ---- synthetic people --------------------------------------------------------------------------

PATIENT = {
    "Id": "'P' || CAST(c_custkey AS STRING)",
    "BIRTHDATE": "DATE '1931-06-30' + CAST((c_custkey * 37) % 32000 AS INT)",
    "RACE": "CASE c_custkey % 6 WHEN 2 THEN 'black' WHEN 3 THEN 'asian' WHEN 4 THEN 'native' ELSE 'white' END",
    "ETHNICITY": "CASE WHEN c_nationkey % 5 = 0 THEN 'hispanic' ELSE 'nonhispanic' END",
    "GENDER": "CASE c_custkey % 2 WHEN 0 THEN 'm' ELSE 'F' END",
    "MARITAL": "CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'MACHINERY' THEN 'S' WHEN 'FURNITURE' THEN 'W' "
               "WHEN 'HOUSEHOLD' THEN 'D' END",
    "STATE": STATE_OF_NATION,
    "INCOME": "CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 10) AS INT) END",
    "PREFIX": "CASE c_custkey % 2 WHEN 0 THEN 'Mr.' ELSE 'Ms.' END",
    "FIRST": "CASE c_custkey % 3 WHEN 0 THEN 'Chris' WHEN 1 THEN 'Ada' ELSE 'Noor' END",
    "LAST": "c_name",
    "SUFFIX": "CASE c_custkey % 50 WHEN 0 THEN 'MD' END",
    "MAIDEN": "CASE c_custkey % 4 WHEN 1 THEN 'Doe' END",
    "ADDRESS": "CAST(c_custkey AS STRING) || ' Main St'",
    "CITY": "'City ' || CAST(c_nationkey AS STRING)",
    "COUNTY": "'County ' || CAST(c_nationkey AS STRING)",
    "ZIP": "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0')",
    "LAT": "CAST(c_nationkey AS DOUBLE)",
    "LON": "c_acctbal",
}
PATIENTS_SQL = select_sql("customer", PATIENT)

PAYER = {
    "Id": "'R' || CAST(r_regionkey AS STRING)",
    "NAME": "CASE r_regionkey WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Medicaid' WHEN 2 THEN 'Blue-cross plan' "
            "WHEN 3 THEN 'Acme Health' ELSE 'NO_INSURANCE' END",
    "OWNERSHIP": "CASE WHEN r_regionkey < 2 THEN 'GOVERNMENT' WHEN r_regionkey < 4 THEN 'PRIVATE' "
                 "ELSE 'NO_INSURANCE' END",
}
PAYERS_SQL = select_sql("region", PAYER)

# The primary payer of the oldest is mostly payer 0; the secondary payer is often missing.
TRANSITION = {
    "PATIENT": "'P' || CAST(c_custkey AS STRING)",
    "START_DATE": "CAST(DATE '2021-01-01' + CAST(c_custkey % 400 AS INT) AS TIMESTAMP)",
    "END_DATE": "CAST(DATE '2021-12-01' + CAST(c_custkey % 700 AS INT) AS TIMESTAMP)",
    "PAYER": "'R' || CAST(CASE WHEN (c_custkey * 37) % 32000 < 10000 AND c_custkey % 3 < 2 THEN 0 "
             "ELSE c_custkey % 5 END AS STRING)",
    "SECONDARY_PAYER": "CASE WHEN c_nationkey % 3 = 1 THEN 'R' || CAST(1 + c_custkey % 3 AS STRING) END",
}
TRANSITIONS_SQL = select_sql("customer", TRANSITION)


def patients(t: Tables) -> DataFrame:
    return select(t.customer, PATIENT)


def payers(t: Tables) -> DataFrame:
    return select(t.region, PAYER)


def transitions(t: Tables) -> DataFrame:
    return select(t.customer, TRANSITION)


# ---- survey files, one per year of orders ------------------------------------------------------


def order_years(t: Tables) -> range:
    """Data years, the year of an order or shipment plus twenty: all from the first to the last."""
    orders = t.orders.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    ships = t.lineitem.agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    return range(min(orders[0], ships[0]) + 20, max(orders[1], ships[1]) + 21)


ORDER_YEAR = "CAST(year(o_orderdate) AS INT) + 20"
AGE = "CAST(floor(o_totalprice / 5500) AS INT)"
RESPONDENT = {
    "DUPERSID": "CAST(o_orderkey AS STRING)",
    "DUID": "CAST(o_custkey AS STRING)",
    "MARRYYYX": "CAST(o_custkey % 7 AS INT)",
    "DOBMM": "CASE WHEN o_orderstatus = 'P' AND o_totalprice < 100000 THEN -1 ELSE CAST(month(o_orderdate) AS INT) END",
    "DOBYY": f"{ORDER_YEAR} - {AGE}",
    "AGELAST": AGE,
    "REGIONYY": "CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 "
                "WHEN '4-NOT SPECIFIED' THEN 4 ELSE -1 END",
    "SEX": "CAST(1 + o_orderkey % 2 AS INT)",
    "RACETHX": "CAST(1 + o_custkey % 6 AS INT)",
    "INSURCYY": "CAST(1 + o_orderkey % 9 AS INT)",
    "PERWTYYF": "o_totalprice / 1000 - 3",
    "TTLPYYX": "CASE WHEN o_orderstatus <> 'O' THEN CAST(floor(o_totalprice / 300) * 300 AS DOUBLE) END",
    "RXTOTYY": "CAST(o_orderkey % 40 AS INT)",
    "RXEXPYY": "round(o_totalprice) / 4",
    "RXSLFYY": "round(o_totalprice) / 64",
    "AGEYYX": AGE,
    "PANEL": "CAST(20 + o_custkey % 3 AS INT)",
}


def _files(years: range, source: DataFrame, day: str, wanted: list[str], exprs: dict[str, str]) -> dict[int, DataFrame]:
    """One frame per year with the digits of the year in its column names."""
    files = {}
    for year in years:
        digits = f"{year % 100:02d}"
        names = {c: c if c == "DOBYY" else "MARRY" + digits + "X" if c == "MARRYYYX" else c.replace("YY", digits, 1)
                 for c in wanted}
        start, end = f"TIMESTAMP '{year - 20}-01-01'", f"TIMESTAMP '{year - 19}-01-01'"
        rows = source.where(f"{day} >= {start} AND {day} < {end}")
        files[year] = select(rows, {names[c]: exprs.get(c, "CAST(NULL AS INT)") for c in wanted})
    return files


YEAR_COUNT_SQL = """(SELECT 1.0::DOUBLE + max(y) - min(y) FROM (
    SELECT year(o_orderdate) AS y FROM orders UNION ALL SELECT year(l_shipdate) FROM lineitem))"""


def person_files(t: Tables) -> dict[int, DataFrame]:
    return _files(order_years(t), t.orders, "o_orderdate", PERSON_COLUMNS, RESPONDENT)


def drug_person_files(t: Tables) -> dict[int, DataFrame]:
    return _files(order_years(t), t.orders, "o_orderdate", PERSON_DRUG_COLUMNS, RESPONDENT)


RESPONDENTS_SQL = select_sql("orders", {**RESPONDENT, "YEAR": ORDER_YEAR})


def linkage(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return select(rows, LINKAGE)


LINKAGE = {"DUPERSID": RESPONDENT["DUPERSID"], "PANEL": RESPONDENT["PANEL"], "STRA9621": "n_regionkey",
           "PSU9621": "n_nationkey"}
LINKAGE_SQL = select_sql("orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
                         LINKAGE)

FILL = {
    "DUPERSID": "CAST(l_orderkey AS STRING)",
    "RXNAME": "CASE WHEN l_quantity = 50 THEN '-15' ELSE 'DRUG ' || CAST(l_partkey % 40 AS STRING) END",
    "RXBEGYRX": "CASE WHEN l_returnflag = 'R' THEN -8 ELSE CAST(year(l_shipdate) AS INT) + 20 - l_linenumber % 4 END",
    "RXRECIDX": "CASE WHEN l_tax > 0 THEN CAST(l_suppkey AS STRING) END",
    "RXNDC": "CASE WHEN l_discount = 0.1 THEN '-15' ELSE CAST(l_partkey AS STRING) END",
    "RXSFYYX": "CASE WHEN l_linestatus = 'O' OR l_quantity > 2 THEN round(l_extendedprice / 10) END",
    "RXXPYYX": "round(l_extendedprice)",
}


def fill_files(t: Tables) -> dict[int, DataFrame]:
    return _files(order_years(t), t.lineitem, "l_shipdate", FILL_COLUMNS, FILL)


FILLS_SQL = select_sql("lineitem", {**FILL, "YEAR": "CAST(year(l_shipdate) AS INT) + 20"})

# ---- images ------------------------------------------------------------------------------------

IMAGE = {
    "filename": "'img' || CAST(o_orderkey AS STRING) || '.png'",
    "age": "CAST(floor(o_totalprice / 7000) + 10 AS DOUBLE)",
    "gender_man": "CAST((o_orderkey * 7) % 101 AS DOUBLE)",
    "gender_woman": "100.0 - CAST((o_orderkey * 7) % 101 AS DOUBLE)",
    "dominant_gender": "CASE WHEN (o_orderkey * 7) % 101 >= 50 THEN 'Man' ELSE 'Woman' END",
    "dominant_race": "CASE o_orderpriority WHEN '1-URGENT' THEN 'white' WHEN '2-HIGH' THEN 'black' "
                     "WHEN '3-MEDIUM' THEN 'asian' WHEN '5-LOW' THEN 'latino hispanic' ELSE 'indian' END",
    "race_white": "CAST(o_custkey % 100 AS DOUBLE)",
    "race_black": "CAST(o_custkey % 90 AS DOUBLE)",
    "race_asian": "CAST(o_custkey % 80 AS DOUBLE)",
    "race_latino hispanic": "CAST(o_custkey % 70 AS DOUBLE)",
}
IMAGES_SQL = select_sql("orders", IMAGE)


def images(t: Tables) -> DataFrame:
    return select(t.orders, IMAGE)


# ---- conditions and codes ----------------------------------------------------------------------

CONDITION_YEARS = {2019: "ts < TIMESTAMP '2024-01-11'",
                   2020: "ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'",
                   2021: "ts >= TIMESTAMP '2024-01-21'"}
CONDITION_YEAR = "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 2019 WHEN ts < TIMESTAMP '2024-01-21' THEN 2020 ELSE 2021 END"
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
CONDITION = {
    "DUPERSID": "CAST(user_id AS STRING)",
    "CONDN": "event_id",
    "AGEDIAG": "CASE WHEN value < 40 THEN CAST(floor(value) AS INT) - 2 END",
    "ICD10CDX": "CASE WHEN event_type = 'error' AND value < 1 THEN '-15' ELSE "
                "CASE event_type WHEN 'click' THEN 'E' WHEN 'view' THEN 'I' WHEN 'purchase' THEN 'C' "
                f"WHEN 'signup' THEN 'J' ELSE 'F' END || lpad(CAST(1 + {_K} % 20 AS STRING), 2, '0') END",
    "CCSR1X": "'G' || CAST(user_id % 3 AS STRING)",
    "CCSR2X": "CASE WHEN value > 20 THEN 'H1' ELSE '-1' END",
    "CCSR3X": "'-1'",
}
# 1/2 answers in the latest year, event counts before; -1 and NULL stand for unknown.
FLAG = {"ER": "CASE WHEN value < 5 THEN 1 WHEN value > 60 THEN NULL ELSE {no} END",
        "IP": "CASE WHEN value < 15 THEN 1 WHEN value > 50 THEN -1 ELSE {no} END",
        "OP": "CASE WHEN value < 30 THEN 1 ELSE {no} END"}


def condition_files(t: Tables) -> dict[int, DataFrame]:
    files = {}
    for year, days in CONDITION_YEARS.items():
        tail, no = ("COND", 2) if year == 2021 else ("NUM", 0)
        rows = t.events.where(days)
        files[year] = select(rows, {**CONDITION, **{f"{k}{tail}": e.format(no=no) for k, e in FLAG.items()}})
    return files


CONDITIONS_SQL = select_sql("events", {
    **CONDITION, "YEAR": CONDITION_YEAR,
    **{k: e.format(no=f"(CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 2 ELSE 0 END)") for k, e in FLAG.items()},
})

_CODE = ("CASE p_type WHEN 'ECONOMY' THEN 'E' WHEN 'LARGE' THEN 'I' WHEN 'MEDIUM' THEN 'C' WHEN 'PROMO' THEN 'J' "
         "WHEN 'SMALL' THEN 'F' ELSE 'Z' END || lpad(CAST(1 + p_size % 20 AS STRING), 2, '0')")
FREQUENCY = {
    "ICDCMCode": f"{_CODE} || '.' || CAST(p_partkey AS STRING)",
    "TotalDiag": "CASE WHEN p_size = 50 AND p_brand = 'Brand#25' THEN NULL WHEN p_brand = 'Brand#24' THEN 0 "
                 "ELSE CAST(floor(p_retailprice) AS BIGINT) - 890 END",
}
HOLDS = {"ED": "p_type <> 'SMALL'", "IP": "p_size > 10", "OP": "p_size <= 30"}
CROSSWALK = {
    "ICD10CM": f"{_CODE} || CAST(p_partkey AS STRING)",
    "ICD10_DSC": "p_name",
    "CCSR1X": "'G' || CAST(p_partkey % 3 AS STRING)",
    "CCSR2X": "CASE WHEN p_size > 25 THEN 'H1' END",
    "CCSR3X": "CAST(NULL AS STRING)",
    "CCSR1X_DSC": "'group  ' || p_brand",
    "CCSR2X_DSC": "CASE WHEN p_size > 25 THEN p_type END",
    "CCSR3X_DSC": "CAST(NULL AS STRING)",
}
CHRONIC = {"ICD10CM": CROSSWALK["ICD10CM"],
           "CHRONIC_IND": "CASE p_size % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'B' WHEN 3 THEN 'N' ELSE 'X' END"}


def frequencies(t: Tables) -> DataFrame:
    base = select(t.part, {**FREQUENCY, **HOLDS})
    held = base.unpivot(["ICDCMCode", "TotalDiag"], list(HOLDS), "setting", "held").where("held").drop("held")
    return held.withColumn("year", F.explode(F.array(*[F.lit(y) for y in CONDITION_YEARS])))


FREQUENCIES_SQL = " UNION ALL ".join(
    f"SELECT *, '{s}' AS setting FROM ({select_sql('part', FREQUENCY)} WHERE {c})" for s, c in HOLDS.items())


def crosswalk(t: Tables) -> DataFrame:
    return select(t.part, CROSSWALK).withColumn("version", F.explode(F.array(F.lit(2020), F.lit(2021))))


CROSSWALK_SQL = select_sql("part", CROSSWALK)


def chronic(t: Tables) -> DataFrame:
    return select(t.part.where("p_brand <> 'Brand#1'"), CHRONIC)


CHRONIC_SQL = select_sql("part", CHRONIC) + " WHERE p_brand <> 'Brand#1'"
