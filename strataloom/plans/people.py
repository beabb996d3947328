"""From survey files, synthetic people and images to one person table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import covers, drawn_day, years_between
from ..functions.nulls import if_known
from ..functions.recode import band, first_rule, recode, top_code
from ..functions.text import title_case
from ..operators.aggregates import proportional, shares, stretch
from ..operators.balance import pattern_share, propensity
from ..operators.columns import any_column, confident, harmonize_year, pool, relocate, tag_year
from ..operators.joins import dimension_roles
from ..operators.matching import first_control, matched_pairs, stratum_match
from ..operators.nearest import nearest_match
from ..operators.ranks import percent_rank
from ..session import materialize
from ..sources import lookups as L
from ..sources.schemas import PERSON_COLUMNS

# Reference day, top age and the birth year it stands for, income split of seniors.
YEAR_END = dt.date(2021, 12, 31)
TOP_AGE, TOP_BIRTH_YEAR = 85, 1936
MIDDLE_INCOME = (0.2, 0.7)
# Keys and ratios of the two matches.
PEOPLE_KEYS = ["MARITAL", "SEX", "RACETHX", "REGIONYY", "INSURCYY", "AGE_GRP_9"]
PEOPLE_RATIO = 3
IMAGE_KEYS = ["SEX", "RACETHX", "AGE_GRP_9"]
IMAGE_RATIO = 20
# Keys that a match on a finer score still holds exactly.
PEOPLE_EXACT = ["SEX", "AGE_GRP_9"]
IMAGE_EXACT = ["SEX", "RACETHX"]
# Least scores of the image attributes.
GENDER_CERTAIN = 96
RACE_CERTAIN = {
    "white": ("race_white", 85), "black": ("race_black", 25),
    "latino hispanic": ("race_latino hispanic", 35), "asian": ("race_asian", 60),
}
MATCH_COLUMNS = (
    "Id BIRTHDATE MARITAL REGIONYY INCOME_PCT AGELAST AGE_GRP_9 DOBYY DOBMM RACETHX INSURCYY SEX MEPS_respondent"
).split()


def respondent_pool(files: Mapping[int, DataFrame]) -> DataFrame:
    """Adults with a positive weight and a known birth month, of all years, under common names."""
    years = [
        tag_year(harmonize_year(df, year, PERSON_COLUMNS), year, "DUPERSID", "DUPERSID", "MEPS_DATA_YEAR")
        for year, df in files.items()
    ]
    return pool(*years).where("AGELAST >= 18 AND PERWTYYF > 0 AND DOBYY > 0 AND DOBMM > 0")


def conform_people(patients: DataFrame, regions: DataFrame) -> DataFrame:
    """Synthetic adults with region, income rank (among all ages), age, race group and marital code.

    `regions` is the literal table of 51 states.
    """
    placed = patients.join(regions, F.col("STATE") == F.col("state_name"), "left")
    ranked = percent_rank(placed, "INCOME", "INCOME_PCT")
    aged = ranked.withColumn(
        "AGELAST", top_code(years_between("BIRTHDATE", F.lit(YEAR_END)), float(TOP_AGE))
    )
    return aged.where("AGELAST >= 18").select(
        "Id", "BIRTHDATE", "GENDER",
        F.coalesce("MARITAL", F.lit(L.MARITAL_DEFAULT)).alias("MARITAL"),
        "REGIONYY", "INCOME_PCT", "AGELAST",
        if_known(F.col("AGELAST") == TOP_AGE, TOP_BIRTH_YEAR, F.year("BIRTHDATE")).alias("DOBYY"),
        F.month("BIRTHDATE").alias("DOBMM"),
        race_group().alias("RACETHX"),
    )


def race_group(race: str = "RACE", ethnicity: str = "ETHNICITY") -> Column:
    """Ethnicity goes before race."""
    return first_rule((F.col(ethnicity) == "hispanic", L.HISPANIC), default=recode(race, L.RACE_NAMES, L.OTHER_RACE))


def region_table(regions: DataFrame) -> DataFrame:
    return regions.select(F.col("state").alias("state_name"), F.col("region").alias("REGIONYY"))


def payer_on(transitions: DataFrame, payers: DataFrame, day: dt.date = YEAR_END) -> DataFrame:
    """Primary and secondary payer of each person on a day."""
    names = payers.select("Id", "NAME", "OWNERSHIP").distinct()
    current = transitions.where(covers(F.to_date("START_DATE"), F.to_date("END_DATE"), day))
    both = dimension_roles(current, names, "Id", [("PAYER", "P_", "inner"), ("SECONDARY_PAYER", "S_", "left")])
    return both.select(
        "PATIENT", F.col("P_NAME").alias("PRIMARY_PAYER"), F.col("P_OWNERSHIP").alias("PRIMARY_PAYER_ORG"),
        F.col("S_NAME").alias("SECONDARY_PAYER"), F.col("S_OWNERSHIP").alias("SECONDARY_PAYER_ORG"),
    )


def insurance_class() -> Column:
    """Insurance class from age, payers and income rank.

    Up to 65 the owner of the primary payer decides, and other owners give NULL. Above 65, what is
    not covered by a rule counts as uninsured.
    """
    owner, second = F.col("PRIMARY_PAYER_ORG"), F.col("SECONDARY_PAYER_ORG")
    medicare = F.col("PRIMARY_PAYER") == "Medicare"
    supplemented = medicare & (second == "PRIVATE")
    younger = recode(owner, {"PRIVATE": L.PRIVATE_UNDER_65, "GOVERNMENT": L.PUBLIC_UNDER_65,
                             "NO_INSURANCE": L.NONE_UNDER_65})
    older = first_rule(
        (second.isNull() & medicare, L.MEDICARE),
        (second.isNull() & (owner == "GOVERNMENT"), L.MEDICARE_PUBLIC),
        (supplemented & F.col("INCOME_PCT").between(*MIDDLE_INCOME), L.MEDICARE),
        (supplemented & F.col("INCOME_PCT").isNotNull(), L.MEDICARE_PRIVATE),
        default=L.NONE_65,
    )
    return if_known(F.col("AGELAST") <= 65, younger, older)


def people_input(people: DataFrame, payers_now: DataFrame) -> DataFrame:
    """Synthetic side of the match (flag 0): people who have a payer on the day."""
    return (
        people.join(payers_now, F.col("Id") == F.col("PATIENT"))
        .withColumns({
            "INSURCYY": insurance_class(),
            "SEX": F.upper("GENDER"),
            "AGE_GRP_9": band("AGELAST"),
            "MEPS_respondent": F.lit(0),
        })
        .select(*MATCH_COLUMNS)
    )


def respondent_input(respondents: DataFrame, seed: int | str) -> DataFrame:
    """Survey side of the match (flag 1), in the columns of the synthetic side."""
    ranked = percent_rank(respondents.where("REGIONYY > 0"), "TTLPYYX", "INCOME_PCT")
    born = drawn_day(F.col("DOBYY"), F.col("DOBMM"), seed, "DUPERSID")
    year_end = F.make_date(F.col("MEPS_DATA_YEAR"), F.lit(12), F.lit(31))
    coded = ranked.select(
        F.col("DUPERSID").alias("Id"),
        born.alias("BIRTHDATE"),
        recode("MARRYYYX", L.MARITAL_CODES, L.MARITAL_DEFAULT).alias("MARITAL"),
        recode("REGIONYY", L.REGION_CODES).alias("REGIONYY"),
        "INCOME_PCT",
        years_between(born, year_end).alias("AGELAST"),
        "DOBYY", "DOBMM",
        recode("RACETHX", L.RACE_CODES, L.OTHER_RACE).alias("RACETHX"),
        recode("INSURCYY", L.INSURANCE_CODES, L.INSURANCE_DEFAULT).alias("INSURCYY"),
        recode("SEX", L.SEX_CODES, "M").alias("SEX"),
        F.lit(1).alias("MEPS_respondent"),
    )
    return relocate(coded.withColumn("AGE_GRP_9", band("AGELAST")), "AGE_GRP_9", after="AGELAST")


def representativeness(people: DataFrame, respondents: DataFrame,
                       categories=("SEX", "RACETHX", "MARITAL", "INSURCYY", "AGE_GRP_9")) -> DataFrame:
    """Share of each category in both sources, one line per (category, level, source)."""
    both = pool(people.withColumn("source", F.lit("synthetic")), respondents.withColumn("source", F.lit("survey")))
    # All categories are counted from one grouped table; a window over the few levels gives totals.
    folded = both.groupBy("source", *categories).agg(F.count(F.lit(1)).alias("n"))
    levels = folded.unpivot(["source", "n"], list(categories), "category", "level")
    counts = levels.groupBy("source", "category", "level").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(W.partitionBy("source", "category"))
    return counts.withColumn("share", F.col("n") / total).where("level IS NOT NULL").select(
        "category", "level", "source", "n", "share"
    )


def match_people(people: DataFrame, respondents: DataFrame, seed: int | str, score: bool = False) -> DataFrame:
    """Matched rows of both sides: up to three synthetic people per respondent in each stratum."""
    both = materialize(pool(people, respondents))
    if score:
        both = propensity(both, PEOPLE_KEYS, "MEPS_respondent")
    return stratum_match(both, PEOPLE_KEYS, "MEPS_respondent", "Id", PEOPLE_RATIO, seed)


def match_people_nearest(people: DataFrame, respondents: DataFrame, seed: int | str, ratio: int = PEOPLE_RATIO) -> DataFrame:
    """Matched rows of both sides, exact on sex and age band, nearest in the score of all six keys (`distance`)."""
    both = materialize(pool(people, respondents))
    scored = pattern_share(both, PEOPLE_KEYS, "MEPS_respondent", "score")
    return nearest_match(scored, PEOPLE_EXACT, "MEPS_respondent", "Id", "score", ratio, seed).drop("score")


def match_images_nearest(pairs: DataFrame, images: DataFrame, seed: int | str, ratio: int = IMAGE_RATIO) -> DataFrame:
    """People and images matched on sex and race group, nearest in age; `id` is a person or a file name."""
    keys = [*IMAGE_EXACT, "AGELAST"]
    people = pairs.select(F.col("Synthea_ID").alias("id"), *keys, F.lit(1).alias("final_database"))
    files = images.select(F.col("filename").alias("id"), *keys, F.lit(0).alias("final_database"))
    return nearest_match(materialize(pool(people, files)), IMAGE_EXACT, "final_database", "id", "AGELAST", ratio, seed)


def matchup(matched: DataFrame) -> DataFrame:
    """One row per matched synthetic person with the respondent of its subclass."""
    pairs = matched_pairs(matched, "MEPS_respondent")
    return pairs.select(
        F.col("Id_x").alias("Synthea_ID"), F.col("Id_y").alias("MEPS_ID"), F.col("RACETHX_x").alias("RACETHX"),
        F.col("AGE_GRP_9_x").alias("AGE_GRP_9"), F.col("SEX_x").alias("SEX"), F.col("AGELAST_x").alias("AGELAST"),
        "subclass",
    )


def actual_ages(matched: DataFrame) -> DataFrame:
    """Matched synthetic people with their age as born, without the top code."""
    return matched.where("MEPS_respondent = 0").withColumn(
        "AGE_ACTUAL", years_between("BIRTHDATE", F.lit(YEAR_END))
    )


def usable_images(attributes: DataFrame, ages: DataFrame) -> DataFrame:
    """Images of adults with certain gender and race, age stretched to the spread of the people."""
    adults = stretch(attributes.where("age >= 18"), "age", "AGELAST", ages, "AGE_ACTUAL")
    certain = confident(any_column(adults, "gender_", lambda c: c > GENDER_CERTAIN), "dominant_race", RACE_CERTAIN)
    names = {**L.RACE_NAMES, "latino hispanic": L.HISPANIC}
    return certain.select(
        "filename", band("AGELAST").alias("AGE_GRP_9"),
        recode("dominant_gender", {"Man": "M", "Woman": "F"}).alias("SEX"),
        recode("dominant_race", names, L.OTHER_RACE).alias("RACETHX"), "AGELAST",
    )


def image_input(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """Both sides of the match of images: people (flag 1) and files (flag 0), with the file name as the id."""
    people = pairs.select("Synthea_ID", *IMAGE_KEYS, F.lit(1).alias("final_database"))
    files = images.select(F.col("filename").alias("Synthea_ID"), *IMAGE_KEYS, F.lit(0).alias("final_database"))
    return pool(people, files)


def match_images(pairs: DataFrame, images: DataFrame, seed: int | str) -> DataFrame:
    """One file per person: of up to twenty images matched to the person, the first by name."""
    matched = stratum_match(materialize(image_input(pairs, images)), IMAGE_KEYS, "final_database", "Synthea_ID", IMAGE_RATIO, seed)
    return first_control(matched, "final_database", "Synthea_ID", "Synthea_ID", "filename")


def person_table(files: DataFrame, pairs: DataFrame, respondents: DataFrame, patients: DataFrame,
                 payers_now: DataFrame) -> DataFrame:
    """The person table: names and place of the synthetic person, answers of the respondent."""
    answers = respondents.select(
        F.col("Id").alias("MEPS_ID"), "BIRTHDATE", "REGIONYY", "INSURCYY",
        recode("MARITAL", L.MARITAL_LABELS, "Single").alias("MARITAL_STATUS"),
    )
    places = patients.select(
        F.col("Id").alias("Synthea_ID"), "PREFIX", "FIRST", "LAST", "SUFFIX", "MAIDEN", "ADDRESS", "CITY",
        "STATE", "COUNTY", "ZIP", "LAT", "LON",
    )

    def shown(column: str, none: str) -> Column:
        return if_known(F.col(column) == "NO_INSURANCE", none, title_case(column)).alias(column)

    plans = payers_now.select(
        F.col("PATIENT").alias("Synthea_ID"), shown("PRIMARY_PAYER", "Uninsured"), shown("PRIMARY_PAYER_ORG", "")
    )
    joined = files.join(pairs, "Synthea_ID").join(answers, "MEPS_ID").join(places, "Synthea_ID").join(
        plans, "Synthea_ID"
    )
    return joined.select(
        "MEPS_ID", "Synthea_ID", "filename", title_case("RACETHX").alias("RACETHX"), "AGE_GRP_9",
        if_known(F.col("SEX") == "M", "Male", "Female").alias("GENDER"), "BIRTHDATE", "REGIONYY", "INSURCYY",
        "AGELAST", "PREFIX", "FIRST", "LAST", "SUFFIX", "MAIDEN", "ADDRESS", "CITY", "STATE", "COUNTY", "ZIP",
        "LAT", "LON", "PRIMARY_PAYER", "PRIMARY_PAYER_ORG", "MARITAL_STATUS",
    )


def build_persons(files: Mapping[int, DataFrame], patients: DataFrame, transitions: DataFrame, payers: DataFrame,
                  regions: DataFrame, attributes: DataFrame, seed: int | str) -> tuple[DataFrame, DataFrame]:
    """The whole job, from survey files, synthetic people and image attributes to the person table.

    Returns the persons and, beside them, the synthetic people that the match refused for a missing
    key. Tables that several steps use are written once in between.
    """
    payers_now = payer_on(transitions, payers)
    respondents = materialize(respondent_input(respondent_pool(files), seed))
    synthetic = materialize(people_input(conform_people(patients, region_table(regions)), payers_now))
    matched = materialize(match_people(matchable(synthetic), respondents, seed))
    pairs = materialize(matchup(matched))
    images = materialize(usable_images(attributes, actual_ages(matched)))
    table = person_table(match_images(pairs, images, seed), pairs, respondents, patients, payers_now)
    return table, refused(synthetic)


def matchable(df: DataFrame) -> DataFrame:
    """Rows with all match keys. Others have no stratum, and the match refuses them."""
    return df.dropna(subset=PEOPLE_KEYS)


def refused(df: DataFrame) -> DataFrame:
    """The rows that lack a match key, with the names of the missing keys."""
    gaps = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in PEOPLE_KEYS]))
    return df.withColumn("missing", F.array_join(gaps, ",")).where("missing <> ''")


def unmatchable(df: DataFrame) -> DataFrame:
    """How many rows lack each match key."""
    return df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in PEOPLE_KEYS])


def state_allocation(population: DataFrame, people: int = 80_000) -> DataFrame:
    """People to simulate per state, in proportion to population."""
    return proportional(population.where(F.col("state") != "Puerto Rico"), "pop", people, "simulate")


def image_shares(images: DataFrame) -> DataFrame:
    return shares(images, "RACETHX")
