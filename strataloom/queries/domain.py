"""Queries that run the plans on derived population and claims-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.balance import balance, ecdf_balance, ecdf_balances, numeric_balances, pattern_share, propensity
from ..operators.codes import long_flags
from ..operators.density import densities
from ..operators.matching import matched_pairs, stratum_match
from ..operators.ranks import normal_points
from ..plans import diagnoses, drugs, people, profiles, risk
from ..session import materialize
from ..sources import lookups as L
from . import derived as D
from .coverage import BANDS_SQL, TITLE_SQL, quantile_sql, score_sums
from .registry import draw_sql, nearest_sql, query

# ---- people ------------------------------------------------------------------------------------

REGIONS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{s.strip()}', '{r}')" for r, names in L.STATES_BY_REGION.items() for s in names.split(",")
) + ") AS v(state_name, region)"

POOL_SQL = f"""
    SELECT *, "DUPERSID" || CAST("YEAR" AS VARCHAR) AS "ID" FROM ({D.RESPONDENTS_SQL})
    WHERE "AGELAST" >= 18 AND "PERWTYYF" > 0 AND "DOBYY" > 0 AND "DOBMM" > 0"""


def pooled(t):
    return people.respondent_pool(D.person_files(t))


@query(f"""
SELECT "ID" AS "DUPERSID", "YEAR" AS "MEPS_DATA_YEAR", "AGELAST", round("PERWTYYF", 6) AS "PERWTYYF", "DOBYY", "DOBMM",
       "MARRYYYX", "REGIONYY", "TTLPYYX", "RXTOTYY" FROM ({POOL_SQL})
""")
def respondent_pool(t):
    return pooled(t).select("DUPERSID", "MEPS_DATA_YEAR", "AGELAST", F.round("PERWTYYF", 6).alias("PERWTYYF"), "DOBYY",
                            "DOBMM", "MARRYYYX", "REGIONYY", "TTLPYYX", "RXTOTYY")


PEOPLE_SQL = f"""
    SELECT "Id", "BIRTHDATE", "GENDER", coalesce("MARITAL", 'S') AS "MARITAL", region AS "REGIONYY", "INCOME_PCT",
           age AS "AGELAST", CAST(CASE WHEN age = 85 THEN 1936 ELSE year("BIRTHDATE") END AS INTEGER) AS "DOBYY",
           CAST(month("BIRTHDATE") AS INTEGER) AS "DOBMM",
           CASE WHEN "ETHNICITY" = 'hispanic' THEN 'HISPANIC'
                WHEN "RACE" IN ('white', 'black', 'asian') THEN 'NON-HISPANIC ' || upper("RACE") || ' ONLY'
                ELSE 'NON-HISPANIC OTHER RACE OR MULTIPLE RACE' END AS "RACETHX"
    FROM (SELECT *, least(datediff('day', "BIRTHDATE", DATE '2021-12-31') / 365.25::DOUBLE, 85) AS age,
                 CASE WHEN "INCOME" IS NOT NULL
                      THEN percent_rank() OVER (PARTITION BY "INCOME" IS NULL ORDER BY "INCOME") END AS "INCOME_PCT"
          FROM ({D.PATIENTS_SQL}))
    LEFT JOIN ({REGIONS_SQL}) ON "STATE" = state_name WHERE age >= 18"""


def conformed(t):
    return people.conform_people(D.patients(t), people.region_table(L.state_regions(t.spark)))


@query(PEOPLE_SQL)
def conform_people(t):
    return conformed(t)


PAYERS_ON_SQL = f"""
    SELECT "PATIENT", p."NAME" AS "PRIMARY_PAYER", p."OWNERSHIP" AS "PRIMARY_PAYER_ORG",
           s."NAME" AS "SECONDARY_PAYER", s."OWNERSHIP" AS "SECONDARY_PAYER_ORG"
    FROM ({D.TRANSITIONS_SQL}) x JOIN ({D.PAYERS_SQL}) p ON x."PAYER" = p."Id"
    LEFT JOIN ({D.PAYERS_SQL}) s ON x."SECONDARY_PAYER" = s."Id"
    WHERE CAST("START_DATE" AS DATE) <= DATE '2021-12-31' AND CAST("END_DATE" AS DATE) >= DATE '2021-12-31'"""


def payers_now(t):
    return people.payer_on(D.transitions(t), D.payers(t))


@query(PAYERS_ON_SQL)
def payer_on_day(t):
    return payers_now(t)


PEOPLE_INPUT_SQL = f"""
    SELECT "Id", "BIRTHDATE", "MARITAL", "REGIONYY", "INCOME_PCT", "AGELAST",
           {BANDS_SQL.format(x='"AGELAST"')} AS "AGE_GRP_9", "DOBYY", "DOBMM", "RACETHX",
           CASE WHEN "AGELAST" <= 65 THEN
                  CASE "PRIMARY_PAYER_ORG" WHEN 'PRIVATE' THEN '<65 ANY PRIVATE' WHEN 'GOVERNMENT' THEN '<65 PUBLIC ONLY'
                                           WHEN 'NO_INSURANCE' THEN '<65 UNINSURED' END
                WHEN "SECONDARY_PAYER_ORG" IS NULL THEN
                  CASE WHEN "PRIMARY_PAYER" = 'Medicare' THEN '65+ EDITED MEDICARE ONLY'
                       WHEN "PRIMARY_PAYER_ORG" = 'GOVERNMENT' THEN '65+ EDITED MEDICARE AND OTH PUB ONLY'
                       ELSE '65+ UNINSURED' END
                WHEN "PRIMARY_PAYER" = 'Medicare' AND "SECONDARY_PAYER_ORG" = 'PRIVATE' AND "INCOME_PCT" IS NOT NULL THEN
                  CASE WHEN "INCOME_PCT" > 0.7 OR "INCOME_PCT" < 0.2 THEN '65+ EDITED MEDICARE AND PRIVATE'
                       ELSE '65+ EDITED MEDICARE ONLY' END
                ELSE '65+ UNINSURED' END AS "INSURCYY",
           upper("GENDER") AS "SEX", 0 AS "MEPS_respondent"
    FROM ({PEOPLE_SQL}) JOIN ({PAYERS_ON_SQL}) ON "Id" = "PATIENT" """


def people_side(t):
    return people.people_input(conformed(t), payers_now(t))


@query(PEOPLE_INPUT_SQL)
def people_input(t):
    return people_side(t)


RESPONDENT_INPUT_SQL = f"""
    SELECT "Id", "BIRTHDATE", "MARITAL", "REGIONYY", "INCOME_PCT", "AGELAST",
           {BANDS_SQL.format(x='"AGELAST"')} AS "AGE_GRP_9", "DOBYY", "DOBMM", "RACETHX", "INSURCYY", "SEX",
           1 AS "MEPS_respondent"
    FROM (SELECT *, datediff('day', "BIRTHDATE", make_date("YEAR", 12, 31)) / 365.25::DOUBLE AS "AGELAST" FROM (
      SELECT "ID" AS "Id", "YEAR", "DOBYY", "DOBMM",
           make_date("DOBYY", "DOBMM", CAST(1 + floor({draw_sql(3, '"ID"')} * 28 / 4294967296.0::DOUBLE) AS INTEGER))
             AS "BIRTHDATE",
           CASE WHEN "MARRYYYX" = 1 THEN 'M' WHEN "MARRYYYX" = 2 THEN 'W' WHEN "MARRYYYX" IN (3, 4) THEN 'D' ELSE 'S' END
             AS "MARITAL",
           CASE "REGIONYY" WHEN 1 THEN 'Northeast' WHEN 2 THEN 'North Central' WHEN 3 THEN 'South' ELSE 'West' END
             AS "REGIONYY",
           CASE WHEN "TTLPYYX" IS NOT NULL
                THEN percent_rank() OVER (PARTITION BY "TTLPYYX" IS NULL ORDER BY "TTLPYYX") END AS "INCOME_PCT",
           CASE "RACETHX" WHEN 1 THEN 'HISPANIC' WHEN 2 THEN 'NON-HISPANIC WHITE ONLY'
                WHEN 3 THEN 'NON-HISPANIC BLACK ONLY' WHEN 4 THEN 'NON-HISPANIC ASIAN ONLY'
                ELSE 'NON-HISPANIC OTHER RACE OR MULTIPLE RACE' END AS "RACETHX",
           CASE "INSURCYY" WHEN 1 THEN '<65 ANY PRIVATE' WHEN 2 THEN '<65 PUBLIC ONLY' WHEN 3 THEN '<65 UNINSURED'
                WHEN 4 THEN '65+ EDITED MEDICARE ONLY' WHEN 5 THEN '65+ EDITED MEDICARE AND PRIVATE'
                WHEN 6 THEN '65+ EDITED MEDICARE AND OTH PUB ONLY' WHEN 7 THEN '65+ UNINSURED'
                WHEN 8 THEN '65+ NO MEDICARE AND ANY PUBLIC/PRIVATE' ELSE 'UNINSURED' END AS "INSURCYY",
           CASE "SEX" WHEN 2 THEN 'F' ELSE 'M' END AS "SEX"
      FROM ({POOL_SQL}) WHERE "REGIONYY" > 0))"""


def respondent_side(t):
    return people.respondent_input(pooled(t), 3)


@query(RESPONDENT_INPUT_SQL)
def respondent_input(t):
    return respondent_side(t)


_SHARES = ("SEX", "RACETHX", "MARITAL", "INSURCYY", "AGE_GRP_9")


@query(f"""
WITH b AS (SELECT 'synthetic' AS source, * FROM ({PEOPLE_INPUT_SQL})
           UNION ALL SELECT 'survey', * FROM ({RESPONDENT_INPUT_SQL})),
l AS ({' UNION ALL '.join(f"SELECT source, '{c}' AS category, " + chr(34) + c + chr(34) + " AS level FROM b" for c in _SHARES)})
SELECT category, level, source, count(*) AS n,
       round(count(*) / (SELECT count(*) FROM b WHERE b.source = l.source), 9) AS share
FROM l WHERE level IS NOT NULL GROUP BY 1, 2, 3
""")
def representativeness(t):
    table = people.representativeness(people_side(t), respondent_side(t))
    return table.withColumn("share", F.round("share", 9))


_KEYS = ", ".join(f'"{k}"' for k in people.PEOPLE_KEYS)
_KEY_TEXT = " || '|' || ".join(f"""length(CAST("{k}" AS VARCHAR)) || ':' || "{k}\"""" for k in people.PEOPLE_KEYS)
MATCHUP_SQL = f"""
    b AS (SELECT * FROM ({PEOPLE_INPUT_SQL}) WHERE "REGIONYY" IS NOT NULL AND "INSURCYY" IS NOT NULL
          UNION ALL SELECT * FROM ({RESPONDENT_INPUT_SQL})),
    rk AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS}, "MEPS_respondent" ORDER BY {draw_sql(8, '"Id"')}, "Id") - 1
                       AS r,
                  sum("MEPS_respondent") OVER (PARTITION BY {_KEYS}) AS nt,
                  sum(1 - "MEPS_respondent") OVER (PARTITION BY {_KEYS}) AS nc FROM b),
    mt AS (SELECT *, {_KEY_TEXT} || '|' || CAST(CASE WHEN "MEPS_respondent" = 1 THEN r ELSE r % nt END AS BIGINT) AS subclass
           FROM rk WHERE nt > 0 AND (("MEPS_respondent" = 1 AND r < nc) OR ("MEPS_respondent" = 0 AND r < 3 * nt))),
    mu AS (SELECT x."Id" AS "Synthea_ID", y."Id" AS "MEPS_ID", x."RACETHX", x."AGE_GRP_9", x."SEX", x."AGELAST", x.subclass
           FROM mt x JOIN mt y ON x.subclass = y.subclass AND x."MEPS_respondent" = 0 AND y."MEPS_respondent" = 1)"""


def matched(t):
    return people.match_people(people.matchable(people_side(t)), respondent_side(t), 8)


@query(f"WITH {MATCHUP_SQL} SELECT * FROM mu")
def people_matchup(t):
    return people.matchup(matched(t))


@query(f"""
SELECT "Id", CASE WHEN "REGIONYY" IS NULL AND "INSURCYY" IS NULL THEN 'REGIONYY,INSURCYY'
                  WHEN "REGIONYY" IS NULL THEN 'REGIONYY' ELSE 'INSURCYY' END AS missing
FROM ({PEOPLE_INPUT_SQL}) WHERE "REGIONYY" IS NULL OR "INSURCYY" IS NULL
""")
def people_refused(t):
    """Synthetic people without a stratum, which the match leaves out, and what they lack."""
    return people.refused(people_side(t)).select("Id", "missing")


_LEVELS = " UNION ALL ".join(
    f"""SELECT '{k}' AS covariate, CAST("{k}" AS VARCHAR) AS level, CAST(sum("MEPS_respondent") AS DOUBLE) AS scores
        FROM b GROUP BY 2""" for k in people.PEOPLE_KEYS)


@query(f"WITH {MATCHUP_SQL} {_LEVELS}")
def people_scores(t):
    """The score of the match on all six keys: per level, the scores add up to the respondents."""
    both = people.pool(people.matchable(people_side(t)), respondent_side(t))
    return score_sums(propensity(materialize(both), people.PEOPLE_KEYS, "MEPS_respondent"), people.PEOPLE_KEYS)


def _balance_sql(keys, rows: str, matched_rows: str, flag: str) -> str:
    """Shares of each level among treated and controls before and after the match, as the report shows them."""
    def side(k, table, stage, w):
        return f"""SELECT '{k}' AS covariate, CAST("{k}" AS VARCHAR) AS level,
            coalesce(sum({w}) FILTER ({flag} = 1), 0) / (SELECT sum({w}) FROM {table} WHERE {flag} = 1) AS treated_{stage},
            coalesce(sum({w}) FILTER ({flag} = 0), 0) / (SELECT sum({w}) FROM {table} WHERE {flag} = 0) AS control_{stage}
            FROM {table} GROUP BY 2"""

    def both(stage, table, w):
        return " UNION ALL ".join(side(k, table, stage, w) for k in keys)

    return f"""SELECT covariate, level, round(treated_all, 9) AS treated_all, round(control_all, 9) AS control_all,
        round(coalesce(treated_matched, 0), 9) AS treated_matched, round(coalesce(control_matched, 0), 9) AS control_matched
        FROM ({both('all', rows, '1.0::DOUBLE')}) LEFT JOIN ({both('matched', matched_rows, 'w')}) USING (covariate, level)"""


_WEIGHED = """
    mk AS (SELECT *, sum(1 - "MEPS_respondent") OVER (PARTITION BY subclass) AS k FROM mt),
    mw AS (SELECT *, CASE WHEN "MEPS_respondent" = 1 THEN 1.0::DOUBLE ELSE
             (sum(1 - "MEPS_respondent") OVER ()) / CAST(sum("MEPS_respondent") OVER () AS DOUBLE) / k END AS w FROM mk)"""


@query(f"WITH {MATCHUP_SQL}, {_WEIGHED} {_balance_sql(people.PEOPLE_KEYS, 'b', 'mw', chr(34) + 'MEPS_respondent' + chr(34))}")
def people_balance(t):
    """Balance of the six match keys before and after the match of people."""
    both = materialize(people.pool(people.matchable(people_side(t)), respondent_side(t)))
    after = stratum_match(both, people.PEOPLE_KEYS, "MEPS_respondent", "Id", people.PEOPLE_RATIO, 8)
    table = balance(both, materialize(after), people.PEOPLE_KEYS, "MEPS_respondent")
    shown = ("treated_all", "control_all", "treated_matched", "control_matched")
    return table.select("covariate", "level", *[F.round(c, 9).alias(c) for c in shown])


@query(f"""
WITH {MATCHUP_SQL},
v AS (SELECT "AGELAST" AS v, sum("MEPS_respondent") AS t, sum(1 - "MEPS_respondent") AS c FROM b GROUP BY 1),
f AS (SELECT abs(sum(t) OVER o / CAST(sum(t) OVER () AS DOUBLE) - sum(c) OVER o / CAST(sum(c) OVER () AS DOUBLE)) AS gap
      FROM v WINDOW o AS (ORDER BY v))
SELECT 'AGELAST' AS covariate, round(avg(gap), 9) AS ecdf_mean, round(max(gap), 9) AS ecdf_max FROM f
""")
def people_age_ecdf(t):
    """Distance of the age distributions of both sides."""
    both = people.pool(people.matchable(people_side(t)), respondent_side(t))
    table = ecdf_balance(both, "AGELAST", "MEPS_respondent")
    return table.select("covariate", F.round("ecdf_mean", 9).alias("ecdf_mean"), F.round("ecdf_max", 9).alias("ecdf_max"))


def _near_pairs(matched, treated, unit, control_as, treated_as):
    """Pairs with the scores of both rows, rounded for the comparison with SQL."""
    pairs = matched_pairs(matched, treated)
    return pairs.select(F.col(f"{unit}_x").alias(control_as), F.col(f"{unit}_y").alias(treated_as), *[
        F.round(a, 9).alias(b) for a, b in (("distance_x", "control_distance"), ("distance_y", "treated_distance"), ("gap_x", "gap"))])


_NEAR_COLUMNS = """round(control_score, 9) AS control_distance, round(treated_score, 9) AS treated_distance,
    round(abs(control_score - treated_score), 9) AS gap FROM near"""
_SHARE_SQL = f"""
    sc AS (SELECT *, sum("MEPS_respondent") OVER (PARTITION BY {_KEYS}) / CAST(count(*) OVER (PARTITION BY {_KEYS}) AS DOUBLE)
           AS score FROM b)"""


@query(f"""
WITH RECURSIVE {MATCHUP_SQL}, {_SHARE_SQL}, {nearest_sql('sc', "(\"SEX\" || '|' || \"AGE_GRP_9\")", '"MEPS_respondent"', '"Id"',
                                                         'score', draw_sql(8, '"Id"'), people.PEOPLE_RATIO)}
SELECT control AS "Synthea_ID", treated AS "MEPS_ID", {_NEAR_COLUMNS}
""")
def people_nearest(t):
    """People of the same sex and age band with the nearest score of all six keys."""
    match = people.match_people_nearest(people.matchable(people_side(t)), respondent_side(t), 8)
    return _near_pairs(match, "MEPS_respondent", "Id", "Synthea_ID", "MEPS_ID")


_STAGES_SQL = f"""{MATCHUP_SQL}, {_WEIGHED}, {_SHARE_SQL},
    st AS (SELECT 'all' AS stage, "MEPS_respondent" AS treated, 1.0::DOUBLE AS w, "AGELAST", "INCOME_PCT", score FROM sc
           UNION ALL SELECT 'matched', mw."MEPS_respondent", mw.w, mw."AGELAST", mw."INCOME_PCT", score
           FROM mw JOIN sc ON sc."Id" = mw."Id" AND sc."MEPS_respondent" = mw."MEPS_respondent"),
    lg AS (SELECT stage, treated, w, 'AGELAST' AS covariate, "AGELAST" AS x FROM st WHERE "AGELAST" IS NOT NULL
           UNION ALL SELECT stage, treated, w, 'INCOME_PCT', "INCOME_PCT" FROM st WHERE "INCOME_PCT" IS NOT NULL
           UNION ALL SELECT stage, treated, w, 'score', score FROM st)"""
_NUMERIC = ["AGELAST", "INCOME_PCT", "score"]


def _scored_stages(t):
    """All rows with the score of the six keys, and the matched ones."""
    both = materialize(people.pool(people.matchable(people_side(t)), respondent_side(t)))
    scored = materialize(pattern_share(both, people.PEOPLE_KEYS, "MEPS_respondent", "score"))
    after = stratum_match(scored, people.PEOPLE_KEYS, "MEPS_respondent", "Id", people.PEOPLE_RATIO, 8)
    return scored, materialize(after)


@query(f"""
WITH {_STAGES_SQL},
me AS (SELECT *, sum(w * x) OVER k / sum(w) OVER k AS m, sum(w) OVER k AS sw, sum(w * w) OVER k AS sw2
       FROM lg WINDOW k AS (PARTITION BY stage, covariate, treated)),
va AS (SELECT stage, covariate, treated, any_value(m) AS m, sum(w * (x - m) ** 2) * any_value(sw) / nullif(any_value(sw) ** 2 - any_value(sw2), 0) AS v
       FROM me GROUP BY 1, 2, 3),
cu AS (SELECT stage, covariate, x, sum(w) FILTER (treated = 1) AS t, sum(w) FILTER (treated = 0) AS c FROM lg GROUP BY 1, 2, 3),
ga AS (SELECT stage, covariate, abs(coalesce(sum(t) OVER o, 0) / sum(t) OVER k - coalesce(sum(c) OVER o, 0) / sum(c) OVER k) AS g FROM cu
       WINDOW o AS (PARTITION BY stage, covariate ORDER BY x), k AS (PARTITION BY stage, covariate)),
ec AS (SELECT stage, covariate, avg(g) AS e, max(g) AS f FROM ga GROUP BY 1, 2)
SELECT a.stage, a.covariate, round(a.m, 6) AS treated_mean, round(b.m, 6) AS control_mean, round((a.m - b.m) / sqrt(a.v), 6) + 0.0 AS std_diff,
  round(a.v / b.v, 6) AS variance_ratio, round(e, 6) AS ecdf_mean, round(f, 6) AS ecdf_max
FROM va a JOIN va b ON a.stage = b.stage AND a.covariate = b.covariate AND a.treated = 1 AND b.treated = 0
JOIN ec ON ec.stage = a.stage AND ec.covariate = a.covariate
""")
def people_numeric_balance(t):
    """Score, age and income rank of both sides before and after the match."""
    rows, after = _scored_stages(t)
    out = None
    for stage, frame, w in (("all", rows, None), ("matched", after, "weights")):
        one = numeric_balances(frame, _NUMERIC, "MEPS_respondent", w).join(
            ecdf_balances(frame, _NUMERIC, "MEPS_respondent", w), "covariate").withColumn("stage", F.lit(stage))
        out = one if out is None else out.unionByName(one)
    figures = ("treated_mean", "control_mean", "std_diff", "variance_ratio", "ecdf_mean", "ecdf_max")
    return out.select("stage", "covariate", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in figures])


@query(f"""
WITH {_STAGES_SQL},
sz AS (SELECT covariate, min(x) AS a, max(x) AS b, coalesce(nullif(0.9 * stddev_samp(x) * pow(count(*), -0.2), 0), 1) AS h
       FROM lg WHERE stage = 'all' GROUP BY 1),
gr AS (SELECT covariate, h, a - 3 * h AS low, (b + 3 * h - (a - 3 * h)) / 127 AS step FROM sz),
ce AS (SELECT stage, covariate, treated, CAST(floor((x - low) / step) AS INTEGER) AS i, (x - low) / step - floor((x - low) / step) AS far, w
       FROM lg JOIN gr USING (covariate)),
ma AS (SELECT stage, covariate, treated, i, sum(m) AS m FROM (
         SELECT stage, covariate, treated, i, w * (1 - far) AS m FROM ce UNION ALL SELECT stage, covariate, treated, i + 1, w * far FROM ce)
       GROUP BY 1, 2, 3, 4)
SELECT stage, covariate, CAST(treated AS INTEGER) AS treated, round(any_value(low) + j * any_value(step), 6) AS x,
  round(sum(m * exp(-0.5 * ((j - i) * step / h) ** 2)) / (sum(m) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM ma JOIN gr USING (covariate), (SELECT unnest(range(128)) AS j) GROUP BY stage, covariate, treated, j
""")
def people_densities(t):
    """Curves of score, age and income rank of both sides before and after the match."""
    rows, after = _scored_stages(t)
    curves = densities({"all": (rows, None), "matched": (after, "weights")}, _NUMERIC, "MEPS_respondent")
    return curves.select("stage", "covariate", "treated", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


IMAGES_SQL = f"""
    fm AS (SELECT avg("age") AS m, stddev_samp("age") AS s FROM ({D.IMAGES_SQL}) WHERE "age" >= 18),
    ps AS (SELECT stddev_samp(datediff('day', "BIRTHDATE", DATE '2021-12-31') / 365.25::DOUBLE) AS s
           FROM mt WHERE "MEPS_respondent" = 0),
    im AS (SELECT *, ("age" - fm.m) / fm.s * ps.s + fm.m AS stretched FROM ({D.IMAGES_SQL}), fm, ps WHERE "age" >= 18),
    fa AS (SELECT "filename", {BANDS_SQL.format(x="stretched")} AS "AGE_GRP_9",
                  CASE "dominant_gender" WHEN 'Man' THEN 'M' ELSE 'F' END AS "SEX",
                  CASE "dominant_race" WHEN 'latino hispanic' THEN 'HISPANIC' WHEN 'asian' THEN 'NON-HISPANIC ASIAN ONLY'
                       WHEN 'black' THEN 'NON-HISPANIC BLACK ONLY' WHEN 'white' THEN 'NON-HISPANIC WHITE ONLY'
                       ELSE 'NON-HISPANIC OTHER RACE OR MULTIPLE RACE' END AS "RACETHX", stretched AS "AGELAST"
           FROM im WHERE greatest("gender_man", "gender_woman") > 96
             AND "race_white" >= CASE "dominant_race" WHEN 'white' THEN 85 ELSE 0 END
             AND "race_black" >= CASE "dominant_race" WHEN 'black' THEN 25 ELSE 0 END
             AND "race_latino hispanic" >= CASE "dominant_race" WHEN 'latino hispanic' THEN 35 ELSE 0 END
             AND "race_asian" >= CASE "dominant_race" WHEN 'asian' THEN 60 ELSE 0 END)"""


def usable(t, match):
    return people.usable_images(D.images(t), people.actual_ages(match))


@query(f"""WITH {MATCHUP_SQL}, {IMAGES_SQL}
SELECT "filename", "AGE_GRP_9", "SEX", "RACETHX", round("AGELAST", 6) AS "AGELAST" FROM fa""")
def usable_images(t):
    return usable(t, matched(t)).withColumn("AGELAST", F.round("AGELAST", 6))


IMAGE_MATCH_SQL = f"""
    fb AS (SELECT "Synthea_ID" AS id, "SEX", "RACETHX", "AGE_GRP_9", 1 AS tr FROM mu
           UNION ALL SELECT "filename", "SEX", "RACETHX", "AGE_GRP_9", 0 FROM fa),
    fr AS (SELECT *, row_number() OVER (PARTITION BY "SEX", "RACETHX", "AGE_GRP_9", tr ORDER BY {draw_sql(9, 'id')}, id) - 1
                       AS r,
                  sum(tr) OVER (PARTITION BY "SEX", "RACETHX", "AGE_GRP_9") AS nt FROM fb),
    ff AS (SELECT p.id AS "Synthea_ID", min(f.id) AS "filename" FROM fr p JOIN fr f
             ON p."SEX" = f."SEX" AND p."RACETHX" = f."RACETHX" AND p."AGE_GRP_9" = f."AGE_GRP_9"
            AND p.tr = 1 AND f.tr = 0 AND f.r % p.nt = p.r AND f.r < 20 * p.nt
           GROUP BY 1)"""


@query(f"WITH {MATCHUP_SQL}, {IMAGES_SQL}, {IMAGE_MATCH_SQL} SELECT * FROM ff")
def image_match(t):
    match = materialize(matched(t))
    return people.match_images(people.matchup(match), usable(t, match), 9)


_IMAGE_ROWS = """(SELECT id, "SEX", "RACETHX", round(age, 9) AS age, tr FROM (
    SELECT "Synthea_ID" AS id, "SEX", "RACETHX", "AGELAST" AS age, 1 AS tr FROM mu
    UNION ALL SELECT "filename", "SEX", "RACETHX", "AGELAST", 0 FROM fa))"""


@query(f"""
WITH RECURSIVE {MATCHUP_SQL}, {IMAGES_SQL}, {nearest_sql(_IMAGE_ROWS, "(\"SEX\" || '|' || \"RACETHX\")", 'tr', 'id', 'age',
                                                         draw_sql(9, 'id'), 4)}
SELECT control AS filename, treated AS "Synthea_ID", {_NEAR_COLUMNS}
""")
def image_nearest(t):
    """Four images of the same sex and race group for each person, nearest in age."""
    match = materialize(matched(t))
    rounded = F.round("AGELAST", 9)
    near = people.match_images_nearest(people.matchup(match).withColumn("AGELAST", rounded),
                                       usable(t, match).withColumn("AGELAST", rounded), 9, 4)
    return _near_pairs(near, "final_database", "id", "filename", "Synthea_ID")


_IMAGE_FLAGS = f"""
    fw AS (SELECT *, CASE WHEN tr = 1 THEN 1.0::DOUBLE ELSE (sum(1 - tr) OVER ()) / CAST(sum(tr) OVER () AS DOUBLE)
             / sum(1 - tr) OVER (PARTITION BY "SEX", "RACETHX", "AGE_GRP_9", slot) END AS w
           FROM (SELECT *, CASE WHEN tr = 1 THEN r ELSE r % nt END AS slot,
                        sum(1 - tr) OVER (PARTITION BY "SEX", "RACETHX", "AGE_GRP_9") AS nf FROM fr)
           WHERE nt > 0 AND ((tr = 1 AND r < nf) OR (tr = 0 AND r < 20 * nt)))"""


@query(f"WITH {MATCHUP_SQL}, {IMAGES_SQL}, {IMAGE_MATCH_SQL}, {_IMAGE_FLAGS} " + _balance_sql(people.IMAGE_KEYS, 'fb', 'fw', 'tr'))
def image_balance(t):
    """Balance of the three keys of the images before and after their match to people."""
    match = materialize(matched(t))
    both = materialize(people.image_input(people.matchup(match), usable(t, match)))
    after = stratum_match(both, people.IMAGE_KEYS, "final_database", "Synthea_ID", people.IMAGE_RATIO, 9)
    table = balance(both, materialize(after), people.IMAGE_KEYS, "final_database")
    shown = ("treated_all", "control_all", "treated_matched", "control_matched")
    return table.select("covariate", "level", *[F.round(c, 9).alias(c) for c in shown])


@query(f"""
WITH {MATCHUP_SQL}, {IMAGES_SQL}, {IMAGE_MATCH_SQL}
SELECT mu."MEPS_ID", mu."Synthea_ID", ff."filename", {TITLE_SQL.format(c='mu."RACETHX"')} AS "RACETHX", mu."AGE_GRP_9",
       CASE mu."SEX" WHEN 'M' THEN 'Male' ELSE 'Female' END AS "GENDER", b."BIRTHDATE", b."REGIONYY", b."INSURCYY",
       mu."AGELAST", "PREFIX", "FIRST", "LAST", "SUFFIX", "MAIDEN", "ADDRESS", "CITY", "STATE", "COUNTY", "ZIP", "LAT", "LON",
       CASE "PRIMARY_PAYER" WHEN 'NO_INSURANCE' THEN 'Uninsured' ELSE {TITLE_SQL.format(c='"PRIMARY_PAYER"')} END
         AS "PRIMARY_PAYER",
       CASE "PRIMARY_PAYER_ORG" WHEN 'NO_INSURANCE' THEN '' ELSE {TITLE_SQL.format(c='"PRIMARY_PAYER_ORG"')} END
         AS "PRIMARY_PAYER_ORG",
       CASE b."MARITAL" WHEN 'M' THEN 'Married' WHEN 'W' THEN 'Widowed' WHEN 'D' THEN 'Divorced' ELSE 'Single' END
         AS "MARITAL_STATUS"
FROM ff JOIN mu USING ("Synthea_ID") JOIN ({RESPONDENT_INPUT_SQL}) b ON mu."MEPS_ID" = b."Id"
JOIN ({D.PATIENTS_SQL}) p ON mu."Synthea_ID" = p."Id" JOIN ({PAYERS_ON_SQL}) c ON mu."Synthea_ID" = c."PATIENT"
""")
def person_table(t):
    payers, respondents = payers_now(t), materialize(respondent_side(t))
    match = materialize(people.match_people(people.matchable(people_side(t)), respondents, 8))
    pairs = materialize(people.matchup(match))
    files = people.match_images(pairs, usable(t, match), 9)
    return people.person_table(files, pairs, respondents, D.patients(t), payers)


@query(f"""
WITH o AS (SELECT "age" AS sample, row_number() OVER (ORDER BY "age") AS position, count(*) OVER () AS n
           FROM ({D.IMAGES_SQL}) WHERE "age" >= 18),
q AS (SELECT *, p - 0.5 AS q, sqrt(-ln(least(p, 1 - p))) AS r FROM (SELECT *, (position - 0.5::DOUBLE) / n AS p FROM o))
SELECT sample, position, round({quantile_sql()}, 9) AS theoretical FROM q
""")
def image_age_points(t):
    """Normal quantile points of the image ages."""
    images = D.images(t).where("age >= 18")
    return normal_points(images, "age").withColumn("theoretical", F.round("theoretical", 9))


@query(f"""
WITH {MATCHUP_SQL},
o AS (SELECT age AS sample, row_number() OVER (ORDER BY age) AS position, count(*) OVER () AS n
      FROM (SELECT datediff('day', "BIRTHDATE", DATE '2021-12-31') / 365.25::DOUBLE AS age FROM mt WHERE "MEPS_respondent" = 0)),
q AS (SELECT *, p - 0.5 AS q, sqrt(-ln(least(p, 1 - p))) AS r FROM (SELECT *, (position - 0.5::DOUBLE) / n AS p FROM o))
SELECT round(sample, 9) AS sample, position, round({quantile_sql()}, 9) AS theoretical FROM q
""")
def people_age_points(t):
    """Normal quantile points of the matched people's ages."""
    points = normal_points(people.actual_ages(matched(t)), "AGE_ACTUAL")
    return points.select(F.round("sample", 9).alias("sample"), "position", F.round("theoretical", 9).alias("theoretical"))


@query(f"""
WITH {MATCHUP_SQL}, {IMAGES_SQL},
o AS (SELECT "AGELAST" AS sample, row_number() OVER (ORDER BY "AGELAST") AS position, count(*) OVER () AS n FROM fa),
q AS (SELECT *, p - 0.5 AS q, sqrt(-ln(least(p, 1 - p))) AS r FROM (SELECT *, (position - 0.5::DOUBLE) / n AS p FROM o))
SELECT round(sample, 6) AS sample, position, round({quantile_sql()}, 9) AS theoretical FROM q
""")
def stretched_age_points(t):
    """Normal quantile points of the stretched image ages."""
    points = normal_points(usable(t, matched(t)), "AGELAST")
    return points.select(F.round("sample", 6).alias("sample"), "position", F.round("theoretical", 9).alias("theoretical"))


# ---- diagnoses ---------------------------------------------------------------------------------

_CAT = ('"ICD10CDX"', '"CCSR1X"', '"CCSR2X"', '"CCSR3X"')
_SAME = " AND ".join(f"c.{c} IS NOT DISTINCT FROM k.{c}" for c in _CAT)
_GROUP = ", ".join(_CAT)


def _round_sql(conditions: str, codes: str) -> str:
    """One round: expand every condition to its candidates and keep the one that holds the draw."""
    return f"""
      SELECT c.*, "ICDCMCode", "ICD10_DSC", "ICD10CM" FROM (SELECT *, {draw_sql(21, 'yr', '"DUPERSID"', '"CONDN"')} AS u
        FROM {conditions}) c
      JOIN (SELECT *, CASE WHEN count("TotalDiag") OVER g = count(*) OVER g THEN sum("TotalDiag") OVER g END AS tot,
                   sum("TotalDiag") OVER (g ORDER BY {draw_sql('order', '"ICD10CM"')}, "ICD10CM") AS hi
            FROM {codes} WINDOW g AS (PARTITION BY setting, {_GROUP})) k
        ON {_SAME} AND (k.setting = c.setting OR k.setting = 'COMBINED')
      WHERE u * tot >= (hi - "TotalDiag") * 4294967296 AND u * tot < hi * 4294967296"""


COMPLETED_SQL = f"""
    cd AS (SELECT "DUPERSID", "CONDN", "AGEDIAG", "ICD10CDX", nullif("CCSR1X", '-1') AS "CCSR1X",
                  nullif("CCSR2X", '-1') AS "CCSR2X", nullif("CCSR3X", '-1') AS "CCSR3X", "YEAR" AS yr,
                  CASE WHEN "YEAR" = 2021 THEN
                         CASE WHEN "ER" = 1 THEN 'ED' WHEN "ER" <> 1 AND "IP" = 1 THEN 'IP'
                              WHEN "ER" <> 1 AND "IP" <> 1 AND "OP" = 1 THEN 'OP' ELSE 'ANY' END
                       ELSE CASE WHEN "ER" > 0 THEN 'ED' WHEN "ER" = 0 AND "IP" > 0 THEN 'IP'
                              WHEN "ER" = 0 AND "IP" = 0 AND "OP" > 0 THEN 'OP' ELSE 'ANY' END END AS setting
           FROM ({D.CONDITIONS_SQL}) WHERE "ICD10CDX" <> '-15'),
    cw AS (SELECT * FROM ({D.CROSSWALK_SQL})),
    fq AS (SELECT f.*, cw.*, substr(cw."ICD10CM", 1, 3) AS "ICD10CDX"
           FROM ({D.FREQUENCIES_SQL}) f JOIN cw ON replace(f."ICDCMCode", '.', '') = cw."ICD10CM"),
    r1 AS ({_round_sql('cd', 'fq')}),
    op AS (SELECT * FROM cd WHERE NOT EXISTS
             (SELECT 1 FROM r1 WHERE r1."DUPERSID" = cd."DUPERSID" AND r1."CONDN" = cd."CONDN" AND r1.yr = cd.yr)),
    cb AS (SELECT "ICDCMCode", "ICD10_DSC", "ICD10CM", {_GROUP}, 'COMBINED' AS setting,
                  CASE WHEN count("TotalDiag") = count(*) THEN sum("TotalDiag") END AS "TotalDiag"
           FROM fq GROUP BY ALL),
    r2 AS ({_round_sql('op', 'cb')}),
    dn AS (SELECT *, 1 AS round FROM r1 UNION ALL SELECT *, 2 FROM r2),
    fin AS (SELECT cd.*, "ICDCMCode", "ICD10_DSC", "ICD10CM", round FROM cd LEFT JOIN
              (SELECT yr, "DUPERSID", "CONDN", "ICDCMCode", "ICD10_DSC", "ICD10CM", round FROM dn) USING (yr, "DUPERSID", "CONDN"))"""


def completed(t):
    conditions = [diagnoses.clean_conditions(df, y) for y, df in D.condition_files(t).items()]
    candidates = diagnoses.candidate_codes(D.frequencies(t), D.crosswalk(t))
    return diagnoses.complete_codes(diagnoses.pool(*conditions), candidates, 21)


@query(f"""WITH {COMPLETED_SQL}
SELECT yr AS year, "DUPERSID", "CONDN", setting, "ICD10CDX", "CCSR1X", "CCSR2X", "ICDCMCode", "ICD10_DSC", "ICD10CM", round
FROM fin""")
def choice_cascade(t):
    """Completed codes: own setting first, then all settings together; open ones have no code."""
    return completed(t).select("year", "DUPERSID", "CONDN", "setting", "ICD10CDX", "CCSR1X", "CCSR2X", "ICDCMCode",
                               "ICD10_DSC", "ICD10CM", "round")


@query(f"WITH {COMPLETED_SQL} SELECT yr AS year, round, count(*) AS conditions FROM fin GROUP BY 1, 2")
def completion_coverage(t):
    return diagnoses.coverage(completed(t))


@query(f"""
WITH cw AS (SELECT * FROM ({D.CROSSWALK_SQL})), y AS (SELECT unnest([2019, 2020, 2021]) AS year)
SELECT setting, CAST(year AS INTEGER) AS year, "ICDCMCode", "TotalDiag", cw."ICD10CM",
       substr(cw."ICD10CM", 1, 3) AS "ICD10CDX", "ICD10_DSC", "CCSR1X", "CCSR2X", "CCSR3X"
FROM ({D.FREQUENCIES_SQL}) f JOIN cw ON replace(f."ICDCMCode", '.', '') = cw."ICD10CM", y
""")
def candidate_codes(t):
    return diagnoses.candidate_codes(D.frequencies(t), D.crosswalk(t)).drop("version")


DETAIL_SQL = f"""
    dx AS (SELECT fin."DUPERSID" || CAST(yr AS VARCHAR) AS "DUPERSID", "ICDCMCode" AS "ICD10CM_Pretty", fin."ICD10CM",
                  fin."ICD10_DSC",
                  trim(regexp_replace(coalesce("CCSR1X_DSC", '') || chr(10) || coalesce("CCSR2X_DSC", ''), '\\s+', ' ', 'g'))
                    AS "CCSR_DSC",
                  coalesce(CASE "CHRONIC_IND" WHEN 'A' THEN 'Acute' WHEN 'C' THEN 'Chronic' WHEN 'B' THEN 'Both'
                           WHEN 'N' THEN 'N/A' END, 'N/A') AS "CHRONIC_IND",
                  CASE WHEN "AGEDIAG" < 0 THEN 'Unknown' ELSE CAST("AGEDIAG" AS VARCHAR) END AS "Age_Diag"
           FROM fin JOIN cw ON fin."ICD10CM" = cw."ICD10CM"
           LEFT JOIN ({D.CHRONIC_SQL}) ch ON fin."ICD10CM" = ch."ICD10CM")"""


def detail(t):
    return diagnoses.diagnosis_detail(completed(t), D.crosswalk(t), diagnoses.chronic_table(D.chronic(t)))


@query(f"WITH {COMPLETED_SQL}, {DETAIL_SQL} SELECT * FROM dx")
def diagnosis_detail(t):
    return detail(t)


# ---- risk --------------------------------------------------------------------------------------

def _class_sql(prefixes):
    tests = []
    for length in (3, 4):
        listed = ", ".join(f"'{p}'" for p in prefixes if len(p) == length)
        if listed:
            tests.append(f'substr("ICD10CM", 1, {length}) IN ({listed})')
    return " OR ".join(tests)


_FLAGS_SQL = ", ".join(f"max(CASE WHEN {_class_sql(p)} THEN 1 ELSE 0 END) AS \"{c}\""
                       for c, p in L.comorbidity_prefixes().items())
_SCORE_SQL = " + ".join(f'"{c}" * ({w})' for c, w in L.comorbidity_weights().items())
_NAMES_SQL = ", ".join(f"('{c}', '{d}', {w})" for c, (d, w) in L.COMORBIDITIES.items())
RISK_SQL = f"""
    fl AS (SELECT "DUPERSID", {_FLAGS_SQL} FROM dx GROUP BY 1),
    sc AS (SELECT *, {_SCORE_SQL} AS score FROM fl),
    lg AS (UNPIVOT sc ON {', '.join(chr(34) + c + chr(34) for c in L.COMORBIDITIES)}, score
           INTO NAME "Field_Name" VALUE "Field_Value"),
    rk AS (SELECT "DUPERSID", "Field_Name", CAST("Field_Value" AS INTEGER) AS "Field_Value", n.d AS "Field_DSC_Short",
                  CAST(n.w AS INTEGER) AS vw_weights
           FROM lg JOIN (VALUES {_NAMES_SQL}, ('score', 'Elixhauser risk score', NULL)) n(f, d, w) ON "Field_Name" = n.f)"""


@query(f"WITH {COMPLETED_SQL}, {DETAIL_SQL}, {RISK_SQL} SELECT * FROM rk")
def comorbidity_detail(t):
    return risk.comorbidity_detail(detail(t))


# ---- drugs -------------------------------------------------------------------------------------

PERSON_DRUGS_SQL = f"""
    SELECT "DUPERSID" || CAST("YEAR" AS VARCHAR) AS "ID", "DUPERSID", "RXTOTYY", "RXEXPYY", "RXSLFYY", "PSU9621", "STRA9621",
           "PERWTYYF" / {D.YEAR_COUNT_SQL} AS "POOLWTYY", "RACETHX", "AGEYYX", "SEX", "YEAR" AS "MEPS_DATA_YEAR",
           {BANDS_SQL.format(x='"AGEYYX"')} AS "AGE_GRP_9",
           CASE "RACETHX" WHEN 1 THEN 'Hispanic' WHEN 2 THEN 'Non-Hispanic White Only' WHEN 3 THEN 'Non-Hispanic Black Only'
                WHEN 4 THEN 'Non-Hispanic Asian Only' WHEN 5 THEN 'Non-Hispanic Other Race Or Multiple Race'
                ELSE CAST("RACETHX" AS VARCHAR) END AS "RACETHX_DSC",
           CASE "SEX" WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS "SEX_DSC"
    FROM ({D.RESPONDENTS_SQL}) LEFT JOIN ({D.LINKAGE_SQL}) USING ("DUPERSID", "PANEL")"""


def drug_people(t):
    return drugs.person_drugs(D.drug_person_files(t), D.linkage(t))


@query(f"""SELECT * REPLACE (round("POOLWTYY", 6) AS "POOLWTYY") FROM ({PERSON_DRUGS_SQL})""")
def person_drugs(t):
    return drug_people(t).withColumn("POOLWTYY", F.round("POOLWTYY", 6))


@query(f"""
SELECT "AGE_GRP_9", "SEX_DSC", count(*) AS count, count(*) >= 60 AS large_enough
FROM ({PERSON_DRUGS_SQL}) WHERE "POOLWTYY" > 0 AND "AGEYYX" >= 18 GROUP BY 1, 2
""")
def drug_cut_sizes(t):
    return drugs.cut_sizes(drug_people(t), "age_gender")


@query(f"""
SELECT "AGE_GRP_9", "RACETHX_DSC", count(*) AS count, count(*) >= 60 AS large_enough
FROM ({PERSON_DRUGS_SQL}) WHERE "POOLWTYY" > 0 AND "AGEYYX" >= 18 GROUP BY 1, 2
""")
def drug_cut_sizes_race(t):
    return drugs.cut_sizes(drug_people(t), "age_race")


def _means_sql(cut: str) -> str:
    by = ", ".join(f'"{c}"' for c in drugs.CUTS[cut])
    head, using, group = (f"{by}, ", f"USING ({by})", f"GROUP BY {by}") if by else ("", "ON true", "")
    parts, shown = [], []
    for m, y in drugs.MEASURES.items():
        parts.append(f"""
{m}_m AS (SELECT {head}sum(w * y) / sum(w) AS mean, sum(w) AS tot FROM (SELECT *, "{y}" AS y FROM r) WHERE d {group}),
{m}_z AS (SELECT {head}h, i, sum(w * (y - mean) / tot) AS z FROM (SELECT *, "{y}" AS y FROM r) JOIN {m}_m {using}
          WHERE d GROUP BY {head}h, i),
{m}_g AS (SELECT g.*, coalesce(z, 0) AS z FROM (SELECT {head}mean, h, i FROM {m}_m CROSS JOIN (SELECT DISTINCT h, i FROM r)) g
          LEFT JOIN {m}_z USING ({head}h, i)),
{m}_f AS (SELECT {head}mean AS {m}_mean, sqrt(sum(v)) AS {m}_e FROM (
            SELECT {head}mean, h, count(*) / (count(*) - 1) * sum((z - zbar) ** 2) AS v
            FROM (SELECT *, avg(z) OVER (PARTITION BY {head}h) AS zbar FROM {m}_g) GROUP BY {head}mean, h)
          GROUP BY {head}mean)""")
        shown += [f"round({m}_mean, 4) AS {m}", f"round({m}_mean - 2.0859634472658364 * {m}_e, 4) AS {m}_low",
                  f"round({m}_mean + 2.0859634472658364 * {m}_e, 4) AS {m}_upp"]
        if cut == "age_race":
            shown += [f"round({m}_e, 4) AS {m}_se", f"round({m}_e / {m}_mean, 6) AS {m}_rse"]
    first, *others = [f"{m}_f" for m in drugs.MEASURES]
    joins = " ".join(f"JOIN {o} {using}" for o in others)
    return f"""
WITH r AS (SELECT *, "STRA9621" AS h, "PSU9621" AS i, "POOLWTYY" AS w, "AGEYYX" >= 18 AS d FROM ({PERSON_DRUGS_SQL})),
{','.join(parts)}
SELECT {head}{', '.join(shown)} FROM {first} {joins}"""


def _round_means(means, cut):
    by = drugs.CUTS[cut]
    return means.select(*by, *[F.round(c, 6 if c.endswith("_rse") else 4).alias(c) for c in means.columns if c not in by])


@query(_means_sql("all"))
def drug_means_all(t):
    return _round_means(drugs.drug_means(drug_people(t), "all"), "all")


@query(_means_sql("age_gender"))
def drug_means_age_gender(t):
    return _round_means(drugs.drug_means(drug_people(t), "age_gender"), "age_gender")


@query(_means_sql("age_race"))
def drug_means_age_race(t):
    return _round_means(drugs.drug_means(drug_people(t), "age_race"), "age_race")


PURCHASES_SQL = f"""
    SELECT *, "DUPERSID" || CAST("YEAR" AS VARCHAR) AS "ID" FROM ({D.FILLS_SQL})
    WHERE "RXNDC" <> '-15' AND "RXNAME" <> '-15'"""
DRUG_DETAIL_SQL = f"""
    SELECT "ID", "RXNAME", "YEAR" AS "MEPS_DATA_YEAR", count(DISTINCT coalesce("RXRECIDX", '?')) AS count_unique,
           CASE WHEN count("RXSFYYX") = count(*) THEN sum("RXSFYYX") END AS cost_oop, sum("RXXPYYX") AS cost_tot,
           CASE WHEN count("RXSFYYX") = count(*) THEN sum("RXXPYYX") - sum("RXSFYYX") END AS cost_plan,
           CASE WHEN "RXBEGYRX" < 0 THEN 'Unknown' WHEN "RXBEGYRX" = "YEAR" THEN 'Less than a year'
                ELSE ("YEAR" - "RXBEGYRX") || ' to ' || ("YEAR" - "RXBEGYRX" + 1) || ' years' END AS yrs_on_rx
    FROM ({PURCHASES_SQL}) GROUP BY "ID", "RXNAME", "RXBEGYRX", "YEAR" """


def purchases(t):
    return drugs.fills(D.fill_files(t))


@query(DRUG_DETAIL_SQL)
def drug_detail(t):
    return drugs.drug_detail(purchases(t))


@query(f"""SELECT "ID", "RXNDC", count(*) AS count FROM ({PURCHASES_SQL}) GROUP BY 1, 2""")
def drug_code_counts(t):
    return drugs.code_counts(purchases(t))


# ---- profiles ----------------------------------------------------------------------------------

# One person per order, with the ids of the condition and drug tables.
PERSON = {
    "MEPS_ID": f"CAST(o_orderkey AS STRING) || CAST({D.ORDER_YEAR} AS STRING)",
    "Synthea_ID": "'S' || CAST(o_orderkey AS STRING)",
    "filename": "'img' || CAST(o_orderkey AS STRING) || '.png'",
    "FIRST": "CASE o_custkey % 3 WHEN 0 THEN 'Chris' WHEN 1 THEN 'Ada' ELSE 'Noor' END",
    "LAST": "'Of ' || o_orderpriority",
    "PREFIX": "CASE WHEN o_orderstatus = 'O' THEN 'Dr.' ELSE 'Mx.' END",
    "GENDER": "CASE o_orderkey % 2 WHEN 0 THEN 'Male' ELSE 'Female' END",
    "RACETHX": "CASE o_custkey % 6 WHEN 0 THEN 'Hispanic' WHEN 1 THEN 'Non-Hispanic White Only' "
               "WHEN 2 THEN 'Non-Hispanic Black Only' WHEN 3 THEN 'Non-Hispanic Asian Only' "
               "ELSE 'Non-Hispanic Other Race Or Multiple Race' END",
    "AGELAST": "o_totalprice / 5500",
    "BIRTHDATE": "CAST(o_orderdate AS DATE)",
    "MARITAL_STATUS": "'Single'",
    "CITY": "'City'", "STATE": "'State'",
    "PRIMARY_PAYER": "'Medicare'", "PRIMARY_PAYER_ORG": "'Government'",
}
PERSONS_SQL = D.select_sql("orders", PERSON)
PERSONS_BANDED_SQL = f"""SELECT *, {BANDS_SQL.format(x='"AGELAST"')} AS "AGE_GRP_9" FROM ({PERSONS_SQL})"""


def persons(t):
    from ..functions.recode import band

    return D.select(t.orders, PERSON).withColumn("AGE_GRP_9", band("AGELAST"))


@query(f"""
WITH s AS (SELECT CAST(row_number() OVER (ORDER BY "Synthea_ID") AS INTEGER) AS n, * FROM (
             SELECT * FROM ({PERSONS_SQL}) ORDER BY {draw_sql(13, '"Synthea_ID"')}, "Synthea_ID" LIMIT 200))
SELECT n, "Synthea_ID", "MEPS_ID", "PREFIX" || ' ' || "FIRST" || ' ' || "LAST" AS name,
       CASE "FIRST" WHEN 'Chris' THEN 'Chris''' ELSE "FIRST" || '''s' END AS possessive_name,
       CASE "GENDER" WHEN 'Male' THEN 'him' ELSE 'her' END AS obj_pronoun,
       CASE "GENDER" WHEN 'Male' THEN 'his' ELSE 'her' END AS pos_pronoun,
       './etc/faces/' || "filename" AS image, CAST(floor("AGELAST") AS INTEGER) AS age, "GENDER", "RACETHX", "BIRTHDATE",
       "MARITAL_STATUS", "CITY" || ', ' || "STATE" AS location,
       "PRIMARY_PAYER" || ' (' || "PRIMARY_PAYER_ORG" || ')' AS health_plan
FROM s
""")
def profile_header(t):
    """Headers of 200 sampled people, numbered."""
    chosen = profiles.sampled_people(persons(t), 200, 13)
    return profiles.header(chosen).join(chosen.select("Synthea_ID", "n"), "Synthea_ID")


@query(f"""
WITH {COMPLETED_SQL}, {DETAIL_SQL}
SELECT "DUPERSID" AS "MEPS_ID", "ICD10CM_Pretty" AS "ICD-10-CM Diagnosis Code", "ICD10_DSC" AS "Specific Diagnosis",
       "CCSR_DSC" AS "Clinical Diagnosis Category (CCSR)", "CHRONIC_IND" AS "Chronic or Acute Condition? (CCIR)",
       "Age_Diag" AS "Age when first diagnosed"
FROM dx WHERE "DUPERSID" IN (SELECT "MEPS_ID" FROM ({PERSONS_SQL}))
""")
def profile_conditions(t):
    return profiles.condition_rows(persons(t), detail(t))


def _sentence_sql(counts: str, none: str, lead: str, one: str, many: str) -> str:
    return f"""SELECT "Synthea_ID", coalesce(k, 0) AS rows,
       "FIRST" || CASE WHEN k IS NULL THEN '{none}' WHEN k = 1 THEN '{lead}1 unique {one}'
                       ELSE '{lead}' || k || ' unique {many}' END AS sentence
FROM ({PERSONS_SQL}) LEFT JOIN ({counts}) c ON "MEPS_ID" = c.id"""


@query(f"WITH {COMPLETED_SQL}, {DETAIL_SQL} " + _sentence_sql(
    'SELECT "DUPERSID" AS id, count(*) AS k FROM dx GROUP BY 1',
    " did not receive a diagnosis for any medical conditions in 2021.", " received a diagnosis for ",
    "medical condition in 2021.", "medical conditions in 2021."))
def profile_conditions_text(t):
    return profiles.condition_sentence(persons(t), detail(t))


@query(f"""
WITH d AS (SELECT "ID", "RXNAME", yrs_on_rx, count_unique, cost_oop, cost_plan, cost_tot FROM ({DRUG_DETAIL_SQL})
           WHERE "ID" IN (SELECT "MEPS_ID" FROM ({PERSONS_SQL}))),
u AS (SELECT * FROM d UNION ALL
      SELECT "ID", 'Total', NULL, CAST(sum(count_unique) AS BIGINT),
             CASE WHEN count(cost_oop) = count(*) THEN sum(cost_oop) END,
             CASE WHEN count(cost_plan) = count(*) THEN sum(cost_plan) END,
             CASE WHEN count(cost_tot) = count(*) THEN sum(cost_tot) END
      FROM d GROUP BY 1)
SELECT "ID" AS "MEPS_ID", "RXNAME" AS "Drug Name", yrs_on_rx AS "Length of time taking the drug",
       count_unique AS "Number of purchases in 2021", '$' || format('{{:,.2f}}', cost_oop) AS "Out-of-pocket cost",
       '$' || format('{{:,.2f}}', cost_plan) AS "Cost to drug plan", '$' || format('{{:,.2f}}', cost_tot) AS "Total cost"
FROM u
""")
def profile_drugs(t):
    return profiles.drug_money(profiles.drug_rows(persons(t), drugs.drug_detail(purchases(t))))


@query(_sentence_sql(f'SELECT "ID" AS id, count(*) AS k FROM ({DRUG_DETAIL_SQL}) GROUP BY 1',
                     " did not take any prescribed drugs in 2021.", " took ", "prescribed drug in 2021.",
                     "prescribed drugs in 2021."))
def profile_drugs_text(t):
    return profiles.drug_sentence(persons(t), drugs.drug_detail(purchases(t)))


def _peers_sql(measure: str, own: str) -> str:
    def cut(name, by, position, label):
        using = " AND ".join(f'p.{a} = m.{b}' for a, b in by) or "true"
        return f"""SELECT "Synthea_ID", "MEPS_ID", {position} AS position, {label} AS breakout, {measure}, {measure}_low,
            {measure}_upp FROM ({PERSONS_BANDED_SQL}) p JOIN ({_means_sql(name)}) m ON {using}"""

    race = ("'...all US residents in the same general age (' || p.\"AGE_GRP_9\" || ') and race/ethnicity group (' || "
            "p.\"RACETHX\" || ') as ' || \"FIRST\"")
    gender = ("'...all US residents who are the same gender (' || p.\"GENDER\" || ') and general age (' || "
              "p.\"AGE_GRP_9\" || ') as ' || \"FIRST\"")
    age = ('"AGE_GRP_9"', '"AGE_GRP_9"')
    cuts = [cut("age_race", [age, ('"RACETHX"', '"RACETHX_DSC"')], 1, race),
            cut("age_gender", [age, ('"GENDER"', '"SEX_DSC"')], 2, gender),
            cut("all", [], 3, "'...all US residents age 18 and up'")]
    return f"""SELECT c.*, o."{own}" AS own_value FROM ({' UNION ALL '.join(cuts)}) c
        LEFT JOIN ({PERSON_DRUGS_SQL}) o ON o."ID" = c."MEPS_ID" """


def _peer_query(t, measure, own):
    use = materialize(drug_people(t))
    means = {cut: _round_means(table, cut) for cut, table in drugs.all_drug_means(use).items()}
    table = profiles.peer_comparison(persons(t), use, own, means, measure)
    return table.withColumn("breakout", F.translate("breakout", "\n", " "))


@query(_peers_sql("mean_util", "RXTOTYY"))
def profile_use(t):
    """Own use against three peer means; line breaks of the labels are shown as blanks."""
    return _peer_query(t, "mean_util", "RXTOTYY")


@query(_peers_sql("mean_oop_spend", "RXSLFYY"))
def profile_spending(t):
    return _peer_query(t, "mean_oop_spend", "RXSLFYY")


@query(f"""
WITH {COMPLETED_SQL}, {DETAIL_SQL}, {RISK_SQL}
SELECT "DUPERSID" AS "MEPS_ID", CASE "Field_Name" WHEN 'score' THEN 1 ELSE 0 END AS position,
       CASE "Field_Name" WHEN 'score' THEN 'Elixhauser Risk Score (total sum of' || chr(10) || 'comorbidity contributions)'
            ELSE "Field_DSC_Short" END AS "Elixhauser Comorbidity",
       CASE "Field_Name" WHEN 'score' THEN "Field_Value" ELSE vw_weights END AS "Elixhauser Score Contribution"
FROM rk WHERE ("Field_Name" = 'score' OR "Field_Value" <> 0) AND "DUPERSID" IN (SELECT "MEPS_ID" FROM ({PERSONS_SQL}))
""")
def profile_comorbidities(t):
    return profiles.comorbidity_rows(persons(t), risk.comorbidity_detail(detail(t)))


@query(f"WITH {COMPLETED_SQL}, {DETAIL_SQL}, {RISK_SQL} " + _sentence_sql(
    """SELECT "DUPERSID" AS id, count(*) AS k FROM rk WHERE "Field_Name" <> 'score' AND "Field_Value" <> 0 GROUP BY 1""",
    " did not receive a diagnosis in 2021 that maps to any Elixhauser Comorbidity categories.",
    " received a diagnosis in 2021 for ", "Elixhauser Comorbidity category.", "Elixhauser Comorbidity categories."))
def profile_comorbidities_text(t):
    return profiles.comorbidity_sentence(persons(t), risk.comorbidity_detail(detail(t)))


def _money(c: str, places: int = 2) -> str:
    return f"coalesce(CAST(CAST({c} AS DECIMAL(18,{places})) AS VARCHAR), '')"


def _shown_sql(fields, order, person, source, name):
    return f"""(SELECT {person} AS id, string_agg({" || '|' || ".join(fields)}, '; ' ORDER BY {order}) AS {name}, count(*) AS k
        FROM {source} GROUP BY 1)"""


_DOCUMENTS_SQL = f"""
    pcd AS {_shown_sql([f"coalesce(CAST({c} AS VARCHAR), '')" for c in ('"ICD10CM_Pretty"', '"ICD10_DSC"', '"Age_Diag"')],
                      ', '.join(f'{c} NULLS FIRST' for c in ('"ICD10CM_Pretty"', '"ICD10_DSC"', '"CCSR_DSC"', '"CHRONIC_IND"', '"Age_Diag"')),
                      '"DUPERSID"', 'dx', 'conditions')},
    pdd AS (SELECT "ID", "RXNAME", yrs_on_rx, count_unique, cost_oop, cost_plan, cost_tot FROM ({DRUG_DETAIL_SQL})),
    pdu AS (SELECT 0 AS p, * FROM pdd UNION ALL SELECT 1, "ID", 'Total', NULL, CAST(sum(count_unique) AS BIGINT), NULL, NULL,
             CASE WHEN count(cost_tot) = count(*) THEN sum(cost_tot) END FROM pdd GROUP BY "ID"),
    pds AS {_shown_sql(['"RXNAME"', "CAST(count_unique AS VARCHAR)", _money('cost_tot')], ', '.join(f'{c} NULLS FIRST' for c in
                      ('p', '"RXNAME"', 'yrs_on_rx', 'count_unique', 'cost_oop', 'cost_plan', 'cost_tot')), '"ID"', 'pdu', 'drugs')},
    pcm AS (SELECT "DUPERSID", CASE "Field_Name" WHEN 'score' THEN 1 ELSE 0 END AS p,
             CASE "Field_Name" WHEN 'score' THEN 'Score' ELSE "Field_DSC_Short" END AS c,
             CASE "Field_Name" WHEN 'score' THEN "Field_Value" ELSE vw_weights END AS w
           FROM rk WHERE "Field_Name" = 'score' OR "Field_Value" <> 0),
    pcs AS {_shown_sql(['c', 'CAST(w AS VARCHAR)'], 'p, c, w NULLS FIRST', '"DUPERSID"', 'pcm', 'comorbidities')},
    pus AS (SELECT "Synthea_ID" AS id, string_agg(position || '|' || {_money('mean_util', 6)} || '|' || coalesce(CAST(own_value AS VARCHAR), ''), '; '
             ORDER BY position) AS uses FROM ({_peers_sql("mean_util", "RXTOTYY")}) GROUP BY 1)"""


def _documents_sql(rows: str) -> str:
    return f"""
SELECT n, s."Synthea_ID", s."MEPS_ID", CAST(0 AS BIGINT) AS part, "PREFIX" || ' ' || "FIRST" || ' ' || "LAST" AS name,
  coalesce(pcd.k, 0) AS n_conditions, coalesce(pds.k - 1, 0) AS n_drugs, coalesce(pcs.k - 1, 0) AS n_comorbidities,
  "FIRST" || CASE WHEN pds.k IS NULL THEN ' did not take any prescribed drugs in 2021.' WHEN pds.k = 2 THEN ' took 1 unique prescribed drug in 2021.'
                  ELSE ' took ' || (pds.k - 1) || ' unique prescribed drugs in 2021.' END AS drugs_text,
  coalesce(conditions, '') AS conditions, coalesce(drugs, '') AS drugs, coalesce(comorbidities, '') AS comorbidities, uses
FROM ({rows}) s LEFT JOIN pcd ON pcd.id = "MEPS_ID" LEFT JOIN pds ON pds.id = "MEPS_ID" LEFT JOIN pcs ON pcs.id = "MEPS_ID"
LEFT JOIN pus ON pus.id = s."Synthea_ID"
"""


def _documents_shown(table):
    """The nested columns as text, for the comparison with SQL."""
    def text(column, *fields):
        def line(x):
            return F.concat_ws("|", *[F.coalesce(f(x).cast("string"), F.lit("")) for f in fields])

        return F.array_join(F.transform(column, line), "; ").alias(column)

    def field(name):
        return lambda x: x[name]

    def money(name, places=2):
        return lambda x: x[name].cast(f"decimal(18,{places})")

    score = F.lit(profiles.SCORE_TITLE.split()[0])
    return table.select(
        "n", "Synthea_ID", "MEPS_ID", "part", "name", "n_conditions", "n_drugs", "n_comorbidities", "drugs_text",
        text("conditions", *map(field, ("ICD-10-CM Diagnosis Code", "Specific Diagnosis", "Age when first diagnosed"))),
        text("drugs", field("Drug Name"), field("Number of purchases in 2021"), money("Total cost")),
        text("comorbidities", lambda x: F.when(x["Elixhauser Comorbidity"].startswith(score), "Score").otherwise(x["Elixhauser Comorbidity"]),
             field("Elixhauser Score Contribution")),
        text("use", field("position"), money("mean_util", 6), field("own_value")).alias("uses"))


def _profile_inputs(t):
    use, dx = materialize(drug_people(t)), materialize(detail(t))
    means = {cut: _round_means(table, cut) for cut, table in drugs.all_drug_means(use).items()}
    return persons(t), dx, drugs.drug_detail(purchases(t)), use, means, risk.comorbidity_detail(dx)


_SAMPLED_SQL = f"""SELECT CAST(row_number() OVER (ORDER BY "Synthea_ID") AS INTEGER) AS n, * FROM (
    SELECT * FROM ({PERSONS_SQL}) ORDER BY {draw_sql(13, '"Synthea_ID"')}, "Synthea_ID" LIMIT 200)"""


@query(f"WITH {COMPLETED_SQL}, {DETAIL_SQL}, {RISK_SQL}, {_DOCUMENTS_SQL} " + _documents_sql(_SAMPLED_SQL))
def profile_documents(t):
    """One document for each of 200 sampled people."""
    return _documents_shown(profiles.profiles(*_profile_inputs(t), 200, 13))


@query(f"WITH {COMPLETED_SQL}, {DETAIL_SQL}, {RISK_SQL}, {_DOCUMENTS_SQL} "
       + _documents_sql(f"SELECT CAST(NULL AS INTEGER) AS n, * FROM ({PERSONS_SQL})"))
def profile_documents_all(t):
    """One document for every person."""
    return _documents_shown(profiles.documents(*_profile_inputs(t)).withColumn("n", F.lit(None).cast("int")))


# ---- every comorbidity class -------------------------------------------------------------------

# Codes, classes and weights are typed here apart from the lookup tables. A code may count for several classes.
CLASS_OF_CODE = {
    "I509": "chf", "I4891": "carit", "I351": "valv", "I269": "pcd", "I739": "pvd", "I10": "hypunc", "I119": "hypc",
    "G8110": "para", "G20": "ond", "J449": "cpd", "E119": "diabunc", "E1122": "diabc", "E039": "hypothy", "N189": "rf",
    "K746": "ld", "K259": "pud", "B20": "aids", "C819": "lymph", "C780": "metacanc", "C509": "solidtum", "M059": "rheumd",
    "D65": "coag", "E669": "obes", "E43": "wloss", "E871": "fed", "D500": "blane", "D519": "dane", "F1020": "alcohol",
    "F112": "drug", "F209": "psycho", "F329": "depre", "I110": "chf hypc", "I132": "chf hypc", "I426": "chf alcohol",
    "K700": "ld alcohol", "F315": "psycho depre", "Z000": "", "K250": "", "D501": "", "G830": "para", "I728": "",
}
CLASS_WEIGHT = {
    "chf": 7, "carit": 5, "valv": -1, "pcd": 4, "pvd": 2, "hypunc": 0, "hypc": 0, "para": 7, "ond": 6, "cpd": 3,
    "diabunc": 0, "diabc": 0, "hypothy": 0, "rf": 5, "ld": 11, "pud": 0, "aids": 0, "lymph": 9, "metacanc": 12,
    "solidtum": 4, "rheumd": 0, "coag": 3, "obes": -4, "wloss": 6, "fed": 5, "blane": -2, "dane": -2, "alcohol": 0,
    "drug": -7, "psycho": 0, "depre": -3,
}


@query(f"""
WITH k(code, cls) AS (VALUES {', '.join(f"('{c}', '{x}')" for c, xs in CLASS_OF_CODE.items() for x in xs.split())}),
w(cls, weight) AS (VALUES {', '.join(f"('{c}', {x})" for c, x in CLASS_WEIGHT.items())}),
o AS (SELECT o_custkey, ([{', '.join(f"'{c}'" for c in CLASS_OF_CODE)}])[o_orderkey % {len(CLASS_OF_CODE)} + 1] AS code FROM orders),
c AS (SELECT DISTINCT o_custkey, cls FROM o JOIN k USING (code))
SELECT o_custkey AS "DUPERSID", cls AS "Field_Name", CAST(1 AS INTEGER) AS "Field_Value" FROM c
UNION ALL SELECT o_custkey, 'score', CAST(coalesce(sum(weight), 0) AS INTEGER)
FROM (SELECT DISTINCT o_custkey FROM o) LEFT JOIN c USING (o_custkey) LEFT JOIN w USING (cls) GROUP BY 1
""")
def comorbidity_all_classes(t):
    """Flags and score over codes that reach all classes."""
    code = F.element_at(F.array(*map(F.lit, CLASS_OF_CODE)), (F.col("o_orderkey") % len(CLASS_OF_CODE) + 1).cast("int"))
    rows = t.orders.select(F.col("o_custkey").alias("DUPERSID"), code.alias("ICD10CM"))
    table = long_flags(risk.comorbidity_flags(rows), "DUPERSID")
    return table.where("Field_Value <> 0 OR Field_Name = 'score'").select("DUPERSID", "Field_Name", "Field_Value")
