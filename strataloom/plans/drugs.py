"""Drug use and cost: person table, survey means, drug detail."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import span_words
from ..functions.nulls import distinct_count, drop_sentinel, if_known, strict_sum
from ..functions.recode import recode, whole_band
from ..functions.text import whole_text
from ..operators.columns import harmonize_year, pool, pooled_weight, tag_year
from ..operators.survey import SurveyDesign, cell_sizes, means_of_totals, survey_totals
from ..sources import lookups as L
from ..sources.schemas import FILL_COLUMNS, PERSON_DRUG_COLUMNS

DESIGN = SurveyDesign(strata="STRA9621", psu="PSU9621", weight="POOLWTYY")
MEASURES = {"mean_util": "RXTOTYY", "mean_oop_spend": "RXSLFYY", "mean_tot_spend": "RXEXPYY"}
CUTS = {"all": [], "age_gender": ["AGE_GRP_9", "SEX_DSC"], "age_race": ["AGE_GRP_9", "RACETHX_DSC"]}


def person_drugs(files: Mapping[int, DataFrame], linkage: DataFrame) -> DataFrame:
    """Use and cost per person and year with pooled weight, design columns, bands and labels."""
    years = [
        tag_year(harmonize_year(df, year, PERSON_DRUG_COLUMNS), year, "DUPERSID", "ID", "MEPS_DATA_YEAR")
        for year, df in files.items()
    ]
    design = linkage.select("DUPERSID", "PANEL", "STRA9621", "PSU9621")
    pooled = pool(*years).withColumn("POOLWTYY", pooled_weight(F.col("PERWTYYF"), len(files)))
    sex = F.col("SEX")
    return pooled.join(design, ["DUPERSID", "PANEL"], "left").select(
        "ID", "DUPERSID", "RXTOTYY", "RXEXPYY", "RXSLFYY", "PSU9621", "STRA9621", "POOLWTYY", "RACETHX", "AGEYYX",
        "SEX", "MEPS_DATA_YEAR",
        whole_band("AGEYYX").alias("AGE_GRP_9"),
        recode("RACETHX", L.RACE_LABELS, whole_text("RACETHX")).alias("RACETHX_DSC"),
        if_known(sex.isin(*L.SEX_LABELS), recode("SEX", L.SEX_LABELS), "Unknown").alias("SEX_DSC"),
    )


def cut_sizes(people: DataFrame, cut: str) -> DataFrame:
    return cell_sizes(people.where("POOLWTYY > 0 AND AGEYYX >= 18"), CUTS[cut])


def drug_means(people: DataFrame, cut: str, **options) -> DataFrame:
    """Mean use, out-of-pocket and total spending of adults, with confidence limits."""
    return _cut_means(survey_totals(people, MEASURES, DESIGN, CUTS[cut], F.col("AGEYYX") >= 18), cut, **options)


def all_drug_means(people: DataFrame, **options) -> dict[str, DataFrame]:
    """`drug_means` of every cut, from one reading of the people."""
    finest = list(dict.fromkeys(c for cut in CUTS.values() for c in cut))
    totals = survey_totals(people, MEASURES, DESIGN, finest, F.col("AGEYYX") >= 18)
    return {cut: _cut_means(totals, cut, **options) for cut in CUTS}


def _cut_means(totals: DataFrame, cut: str, **options) -> DataFrame:
    with_errors = cut == "age_race"
    means = means_of_totals(totals, list(MEASURES), CUTS[cut], rse=with_errors, **options)
    return means if with_errors else means.drop(*[f"{m}_se" for m in MEASURES])


def fills(files: Mapping[int, DataFrame]) -> DataFrame:
    """Purchases of all years with a known drug name and code."""
    years = [
        tag_year(harmonize_year(drop_sentinel(df, ["RXNDC", "RXNAME"], "-15"), year, FILL_COLUMNS),
                 year, "DUPERSID", "ID", "MEPS_DATA_YEAR")
        for year, df in files.items()
    ]
    return pool(*years)


def drug_detail(purchases: DataFrame) -> DataFrame:
    """Per person, drug and start year: purchases, costs and time on the drug."""
    return (
        purchases.groupBy("ID", "RXNAME", "RXBEGYRX", "MEPS_DATA_YEAR")
        .agg(distinct_count("RXRECIDX").alias("count_unique"), strict_sum("RXSFYYX").alias("cost_oop"),
             strict_sum("RXXPYYX").alias("cost_tot"))
        .select(
            "ID", "RXNAME", "MEPS_DATA_YEAR", "count_unique", "cost_oop", "cost_tot",
            (F.col("cost_tot") - F.col("cost_oop")).alias("cost_plan"),
            span_words(F.col("MEPS_DATA_YEAR"), "RXBEGYRX").alias("yrs_on_rx"),
        )
    )


def code_counts(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("ID", "RXNDC").agg(F.count(F.lit(1)).alias("count"))
