"""Design-based means of complex samples, with Taylor-linearised variance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import t_multiplier
from ..session import materialize
from .joins import null_safe_join, require_keys


@dataclass(frozen=True)
class SurveyDesign:
    """Column names of the design. Clusters are numbered inside their stratum."""

    strata: str
    psu: str
    weight: str


def survey_totals(df: DataFrame, measures: dict[str, str], design: SurveyDesign, by: Sequence[str] = (),
                  domain: Column | None = None) -> DataFrame:
    """Weighted totals per cut and cluster, written once; the rows are read once, with partial aggregation.

    The means of this cut and of every coarser one are taken from them. The domain is a filter that
    comes after the design is declared: clusters without a domain member still count. A missing
    stratum, cluster or weight is an error.
    """
    w = F.col(design.weight)
    inside = F.lit(True) if domain is None else F.coalesce(domain, F.lit(False))
    rows = require_keys(df, [design.strata, design.psu, design.weight], "survey design").select(
        *by,
        F.col(design.strata).alias("__h"),
        F.col(design.psu).alias("__i"),
        F.when(inside, w).alias("__w"),
        *[F.when(inside, F.col(y)).alias(f"__y_{m}") for m, y in measures.items()],
        inside.alias("__in"),
    )
    return materialize(rows.groupBy(*by, "__h", "__i", "__in").agg(
        F.sum("__w").alias("__w"),
        F.max(F.coalesce(F.col("__w") > 0, F.lit(False))).alias("__active"),
        *[F.sum(F.col("__w") * F.col(f"__y_{m}")).alias(f"__s_{m}") for m in measures],
        *[F.max(F.col(f"__y_{m}").isNull()).alias(f"__gap_{m}") for m in measures],
    ))


def survey_mean(df: DataFrame, measures: dict[str, str], design: SurveyDesign, by: Sequence[str] = (),
                domain: Column | None = None, **options) -> DataFrame:
    """Weighted mean of each measure per cut, as `<name>`, `_se`, `_low`, `_upp` (and `_rse`).

    `measures` maps output names to columns; the options are those of `means_of_totals`.
    """
    return means_of_totals(survey_totals(df, measures, design, by, domain), list(measures), by, **options)


def means_of_totals(totals_per_cluster: DataFrame, names: Sequence[str], by: Sequence[str] = (), level: float = 0.95,
                    df_t: str | float = "design", lonely_psu: str = "fail", rse: bool = False) -> DataFrame:
    """Means of a cut, from `survey_totals` of the same cut or a finer one.

    `df_t` is "design" (clusters minus strata that hold a domain row with positive weight), "inf"
    for a normal interval, or a number. `lonely_psu` says what a stratum with one cluster does:
    "fail", "remove" it, or "adjust" by its distance from the overall mean. A missing measure in a
    cut makes that cut's figures NULL. Means, residuals and variances are taken from the totals, so
    no row is joined back to its mean.
    """
    if lonely_psu not in ("fail", "remove", "adjust"):
        raise ValueError(f"unknown lonely_psu: {lonely_psu}")
    by = list(by)
    totals_per_cluster = totals_per_cluster.groupBy(*by, "__h", "__i", "__in").agg(
        F.sum("__w").alias("__w"), F.max("__active").alias("__active"),
        *[F.sum(f"__s_{m}").alias(f"__s_{m}") for m in names],
        *[F.max(f"__gap_{m}").alias(f"__gap_{m}") for m in names],
    )
    cells = totals_per_cluster.where("__in")
    clusters = totals_per_cluster.groupBy("__h", "__i").agg(F.max("__active").cast("int").alias("__active"))
    strata = clusters.groupBy("__h").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__active").alias("__active")
    )

    # Per cut and stratum: centred sums of squares and products of the cluster totals, where the
    # clusters that are absent from the cut count as zeros.
    parts = cells.groupBy(*by, "__h").agg(
        F.count(F.lit(1)).alias("__k"),
        F.sum("__w").alias("__w"),
        F.avg("__w").alias("__mw"),
        F.var_pop("__w").alias("__vw"),
        *[F.sum(f"__s_{m}").alias(f"__s_{m}") for m in names],
        *[F.avg(f"__s_{m}").alias(f"__ms_{m}") for m in names],
        *[F.var_pop(f"__s_{m}").alias(f"__vs_{m}") for m in names],
        *[F.covar_pop(f"__s_{m}", "__w").alias(f"__cs_{m}") for m in names],
        *[F.max(f"__gap_{m}").alias(f"__gap_{m}") for m in names],
    )
    parts = null_safe_join(parts, strata.select("__h", "__n"), ["__h"])
    n, k = F.col("__n"), F.col("__k")
    absent = F.lit(1.0) - k / n
    alone = {"fail": F.raise_error(F.lit("survey design: a stratum has one cluster")).cast("double"),
             "remove": F.lit(0.0), "adjust": F.lit(1.0)}[lonely_psu]
    factor = F.when(n > 1, n / (n - 1)).otherwise(alone)

    def spread(variance: str, mean_a: str, mean_b: str) -> Column:
        product = F.col(mean_a) * F.col(mean_b)
        # A lonely cluster is not centred on itself.
        return factor * k * F.when(n > 1, F.col(variance) + absent * product).otherwise(product)

    totals = parts.groupBy(*by).agg(
        F.sum("__w").alias("__w"),
        F.sum(spread("__vw", "__mw", "__mw")).alias("__qww"),
        *[F.sum(f"__s_{m}").alias(f"__s_{m}") for m in names],
        *[F.sum(spread(f"__vs_{m}", f"__ms_{m}", f"__ms_{m}")).alias(f"__qss_{m}") for m in names],
        *[F.sum(spread(f"__cs_{m}", f"__ms_{m}", "__mw")).alias(f"__qsw_{m}") for m in names],
        *[F.max(f"__gap_{m}").alias(f"__gap_{m}") for m in names],
    )
    # One step per quantity, so that each is worked out once.
    w_all = F.col("__w")
    means = totals.withColumn("__t", _multiplier(strata, df_t, level)).withColumns({
        m: F.when(~F.col(f"__gap_{m}"), F.col(f"__s_{m}") / F.nullif(w_all, F.lit(0.0))) for m in names
    })
    errors = means.withColumns({
        f"{m}_se": F.when(F.col(m).isNotNull(), F.sqrt(F.greatest(F.lit(0.0), (
            F.col(f"__qss_{m}") - 2 * F.col(m) * F.col(f"__qsw_{m}") + F.col(m) * F.col(m) * F.col("__qww")
        ))) / w_all) for m in names
    })
    out = list(by)
    for m in names:
        half = F.col("__t") * F.col(f"{m}_se")
        out += [m, f"{m}_se", (F.col(m) - half).alias(f"{m}_low"), (F.col(m) + half).alias(f"{m}_upp")]
        if rse:
            out.append((F.col(f"{m}_se") / F.col(m)).alias(f"{m}_rse"))
    return errors.select(*out)


def _multiplier(strata: DataFrame, df_t: str | float, level: float) -> Column:
    if df_t == "inf":
        return F.lit(NormalDist().inv_cdf((1 + level) / 2))
    if df_t != "design":
        return t_multiplier(float(df_t), level)
    degrees = strata.agg((F.sum("__active") - F.sum((F.col("__active") > 0).cast("long"))).alias("degrees"))
    return degrees.select(t_multiplier(F.col("degrees"), level)).scalar()


def cell_sizes(df: DataFrame, by: Sequence[str], least: int = 60) -> DataFrame:
    """Rows per cut and whether the cut is large enough to publish."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count")).withColumn("large_enough", F.col("count") >= least)
