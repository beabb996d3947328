"""Comorbidity flags and score per person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.codes import long_flags, prefix_flags
from ..sources import lookups as L


def comorbidity_flags(detail: DataFrame, person: str = "DUPERSID", code: str = "ICD10CM") -> DataFrame:
    return prefix_flags(detail, person, code, L.comorbidity_prefixes(), L.comorbidity_weights())


def comorbidity_detail(detail: DataFrame, person: str = "DUPERSID", code: str = "ICD10CM") -> DataFrame:
    """Long form with description and weight: 32 rows per person."""
    names = L.comorbidity_descriptions(detail.sparkSession)
    flags = long_flags(comorbidity_flags(detail, person, code), person)
    return flags.join(F.broadcast(names), "Field_Name").select(  # 32 literal rows
        person, "Field_Name", "Field_Value", "Field_DSC_Short", "vw_weights"
    )
