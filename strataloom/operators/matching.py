"""k:1 matching without replacement inside exact strata.

When the exact strata are made of the same variables as the score, all distances in a stratum are
equal, and nearest-neighbour matching is a matter of ranks: no pair of rows is ever compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.draws import draw32
from .hot import TARGET_ROWS, parts_of_sizes
from .joins import require_keys
from .running import running_totals


def stratum_match(df: DataFrame, strata: Sequence[str], treated: str, unit: str, ratio: int = 1,
                  seed: int | str = 0, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Keep matched rows and add `subclass` and `weights`.

    `treated` is a 0/1 column. Rows of a stratum stand in the order of a keyed draw. Control c
    (from 0) goes to treated c mod T while c < ratio * T, so each treated gets a first control
    before any gets a second. A treated row weighs 1; a control weighs one over the controls of its
    subclass, scaled so that control weights add up to the number of matched controls. A missing
    stratum key is an error.
    """
    strata = list(strata)
    rows = require_keys(df, strata, "stratum_match")
    flag = F.col(treated).cast("long")
    # One grouped table tells the oversized strata and the numbers of matched rows.
    sizes = rows.groupBy(*strata).agg(F.sum(flag).alias("__t"), F.sum(F.lit(1) - flag).alias("__c"))
    hot = parts_of_sizes(sizes.withColumn("__rows", F.col("__t") + F.col("__c")), strata, "__rows", target_rows)
    scale = sizes.agg(
        F.sum(F.least(F.col("__c"), F.lit(ratio) * F.col("__t"))) / F.nullif(F.sum(F.least("__t", "__c")), F.lit(0))
    ).scalar()

    ranked = running_totals(
        rows.withColumn("__order", draw32(seed, unit)), strata, "__order", [unit],
        {"__t": flag, "__c": F.lit(1) - flag}, hot=hot,
    )
    n_t, n_c = F.col("__t_total"), F.col("__c_total")
    used = F.least(n_c, F.lit(ratio) * n_t)
    is_treated = F.col("__t") == 1
    slot = F.when(is_treated, F.col("__t_before")).when(n_t > 0, F.col("__c_before") % n_t)
    matched = ranked.withColumns({"__used": used, "__slot": slot}).where(
        F.when(is_treated, F.col("__slot") < F.col("__used")).otherwise(F.col("__c_before") < F.col("__used"))
    )
    per_slot = F.floor((F.col("__used") - 1 - F.col("__slot")) / F.col("__t_total")) + 1
    return matched.select(
        *df.columns,
        subclass_name(strata, F.col("__slot")).alias("subclass"),
        F.when(is_treated, F.lit(1.0)).otherwise(scale / per_slot).alias("weights"),
    )


def subclass_name(strata: Sequence[str], slot: Column) -> Column:
    """Stratum values and slot as one text; each value stands behind its length, so no two strata share a name."""
    values = [F.col(c).cast("string") for c in strata]
    return F.concat_ws("|", *[F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in values], slot.cast("string"))


def matched_pairs(matched: DataFrame, treated: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """One row per matched control (suffix x) with its treated row (suffix y).

    A subclass has one treated row and at most `ratio` controls, so the treated row is handed to
    the controls inside the subclass, and the matched rows are read and shuffled once.
    """
    names = [c for c in matched.columns if c != "subclass"]
    partner = F.max(F.when(F.col(treated) == 1, F.struct(*names))).over(W.partitionBy("subclass"))
    rows = matched.withColumn("__partner", partner).where(F.col(treated) == 0)
    return rows.select(
        "subclass",
        *[F.col(c).alias(c + suffixes[0]) for c in names],
        *[F.col("__partner").getField(c).alias(c + suffixes[1]) for c in names],
    )


def first_control(matched: DataFrame, treated: str, unit: str, treated_as: str, control_as: str) -> DataFrame:
    """One row per matched treated unit with the control of its subclass that comes first by name."""
    is_treated = F.col(treated) == 1
    return matched.groupBy("subclass").agg(
        F.max(F.when(is_treated, F.col(unit))).alias(treated_as),
        F.min(F.when(~is_treated, F.col(unit))).alias(control_as),
    ).drop("subclass")
