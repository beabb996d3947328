"""Completing truncated diagnosis codes, and the diagnosis detail table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import drop_sentinel, if_known, sentinel_to_null
from ..functions.recode import first_rule, recode
from ..functions.text import code_prefix, drop_first_punctuation, squish
from ..operators.choice import fill_settings, weighted_choice
from ..operators.columns import pool
from ..operators.joins import natural_join
from ..session import materialize
from ..sources import lookups as L
from ..sources.schemas import CONDITION_FLAGS

SETTINGS = ("ED", "IP", "OP")
NO_SETTING = "ANY"
CATEGORY = ["ICD10CDX", "CCSR1X", "CCSR2X", "CCSR3X"]
CODE = ["ICDCMCode", "ICD10_DSC", "ICD10CM"]
# Crosswalk version that each data year is joined with.
CROSSWALK_OF_YEAR = {2021: 2021, 2020: 2020, 2019: 2020}


def clean_conditions(df: DataFrame, year: int) -> DataFrame:
    """Drop suppressed codes, blank out empty categories, and find the care setting."""
    kept = sentinel_to_null(drop_sentinel(df, ["ICD10CDX"], "-15"), CATEGORY[1:], "-1")
    return kept.select(
        "DUPERSID", "CONDN", "AGEDIAG", *CATEGORY,
        care_setting(*CONDITION_FLAGS[year], counts=year < 2021).alias("setting"), F.lit(year).alias("year"),
    )


def care_setting(emergency: str, inpatient: str, outpatient: str, counts: bool) -> Column:
    """Emergency first, else inpatient, else outpatient, else none.

    Flags count as set at 1. Counts count as set above 0 and as unset only at exactly 0, so after a
    missing or negative count no later setting is tried.
    """
    er, ip, op = F.col(emergency), F.col(inpatient), F.col(outpatient)

    def on(c: Column) -> Column:
        return c > 0 if counts else c == 1

    def off(c: Column) -> Column:
        return c == 0 if counts else c != 1

    return first_rule((on(er), "ED"), (off(er) & on(ip), "IP"), (off(er) & off(ip) & on(op), "OP"),
                      default=NO_SETTING)


def candidate_codes(frequencies: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Code frequencies (setting, year, ICDCMCode, TotalDiag) with the categories of the crosswalk.

    The crosswalk has a `version` column: the table of a year is joined with its own version.
    """
    code = drop_first_punctuation("ICDCMCode")
    plain = frequencies.select(
        "setting", "year", "ICDCMCode", "TotalDiag", code.alias("ICD10CM"), code_prefix(code).alias("ICD10CDX"),
        recode("year", CROSSWALK_OF_YEAR).alias("version"),
    )
    names = crosswalk.select("version", "ICD10CM", "ICD10_DSC", *CATEGORY[1:])
    return plain.join(_by_sorting(names), ["version", "ICD10CM"])


def _by_sorting(codes: DataFrame) -> DataFrame:
    """A table of codes that is merged and not copied to every task.

    Spark measures a table by its compressed files: lists of codes that seem to fit its limit for
    broadcasts take a hundred times as much in the memory of each task.
    """
    return codes.hint("merge")


def complete_codes(conditions: DataFrame, candidates: DataFrame, seed: int | str, keep_open: bool = True) -> DataFrame:
    """One full code per condition, drawn by frequency in its setting and category.

    A condition without setting, or whose category its setting cannot complete, is drawn from all
    settings together (`round` 2). What no setting knows stays open, with NULL codes.
    """
    filled = materialize(
        fill_settings(candidates, "setting", ["year", *CATEGORY], CODE, "TotalDiag", SETTINGS, NO_SETTING)
    )
    return weighted_choice(
        conditions, filled, ["year", "setting", *CATEGORY], "ICD10CM", "TotalDiag",
        ["year", "DUPERSID", "CONDN"], seed, keep_open,
    ).drop("TotalDiag")


def coverage(completed: DataFrame) -> DataFrame:
    """Conditions by year and by the round that completed them (NULL: still open)."""
    return completed.groupBy("year", "round").agg(F.count(F.lit(1)).alias("conditions"))


def chronic_table(indicator: DataFrame) -> DataFrame:
    return indicator.select("ICD10CM", recode("CHRONIC_IND", L.CHRONIC_LABELS).alias("CHRONIC_IND"))


def diagnosis_detail(completed: DataFrame, crosswalk: DataFrame, chronic: DataFrame) -> DataFrame:
    """The diagnosis table: full code, description, category text, chronic flag, age at diagnosis."""
    names = crosswalk.select("version", "ICD10CM", "ICD10_DSC", *CATEGORY[1:],
                             *[F.col(f"{c}_DSC") for c in CATEGORY[1:]])
    known = completed.where(F.col("ICD10CM").isNotNull()).withColumn("version", recode("year", CROSSWALK_OF_YEAR))
    # One code may stand for a large share of all conditions: Spark splits the skewed side.
    described = natural_join(natural_join(known, _by_sorting(names)), _by_sorting(chronic), "left")
    texts = [F.coalesce(f"{c}_DSC", F.lit("")) for c in CATEGORY[1:]]
    return described.select(
        F.concat(F.col("DUPERSID"), F.col("year").cast("string")).alias("DUPERSID"),
        F.col("ICDCMCode").alias("ICD10CM_Pretty"), "ICD10CM", "ICD10_DSC",
        squish(F.concat_ws("\n", *texts)).alias("CCSR_DSC"),
        F.coalesce("CHRONIC_IND", F.lit("N/A")).alias("CHRONIC_IND"),
        if_known(F.col("AGEDIAG") < 0, "Unknown", F.col("AGEDIAG").cast("string")).alias("Age_Diag"),
    )


def diagnoses(files: Mapping[int, DataFrame], frequencies: DataFrame, crosswalk: DataFrame, chronic: DataFrame,
              seed: int | str) -> tuple[DataFrame, DataFrame]:
    """(completed conditions, diagnosis detail) for the condition files of several years."""
    conditions = pool(*[clean_conditions(df, year) for year, df in files.items()])
    completed = materialize(complete_codes(conditions, candidate_codes(frequencies, crosswalk), seed))
    return completed, diagnosis_detail(completed, crosswalk, chronic_table(chronic))
