"""Covariate balance before and after matching, and the propensity score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .joins import null_safe_join, require_keys


def _patterns(df: DataFrame, covariates: Sequence[str], treated: str, weight) -> DataFrame:
    """Rows folded to covariate patterns, then to one line per (covariate, level, treated)."""
    folded = df.groupBy(*covariates, treated).agg(F.sum(weight).alias("w"))
    typed = folded.select(*[F.col(c).cast("string").alias(c) for c in covariates], F.col(treated), "w")
    return (
        typed.unpivot([treated, "w"], list(covariates), "covariate", "level")
        .groupBy("covariate", "level")
        .agg(F.sum(F.when(F.col(treated) == 1, F.col("w"))).alias("t"),
             F.sum(F.when(F.col(treated) == 0, F.col("w"))).alias("c"))
    )


def levels(df: DataFrame, covariates: Sequence[str], score: str) -> DataFrame:
    """Per level of each covariate, the sum of the scores (`scores`); rows are folded to patterns first."""
    folded = df.groupBy(*covariates).agg(F.sum(score).alias("w"))
    typed = folded.select(*[F.col(c).cast("string").alias(c) for c in covariates], "w")
    return typed.unpivot(["w"], list(covariates), "covariate", "level").groupBy("covariate", "level").agg(
        F.sum("w").alias("scores"))


def ecdf_balances(df: DataFrame, values: Sequence[str], treated: str, weight=None) -> DataFrame:
    """Per numeric covariate, mean and largest difference of the two weighted distribution functions over its distinct values.

    Rows fold to distinct values of each covariate, which are written in ranges; ranges are added up
    one after another, so no task holds all values. Missing values are left out. A covariate without
    values on one side has NULL figures; one without any has no row.
    """
    w = F.lit(1.0) if weight is None else F.col(weight)
    long = df.select(F.col(treated).alias("__side"), w.cast("double").alias("__w"), *[F.col(v).cast("double").alias(v) for v in values])
    folded = long.unpivot(["__side", "__w"], list(values), "covariate", "v").where("v IS NOT NULL").groupBy("covariate", "v").agg(
        F.coalesce(F.sum(F.when(F.col("__side") == 1, F.col("__w"))), F.lit(0.0)).alias("t"),
        F.coalesce(F.sum(F.when(F.col("__side") == 0, F.col("__w"))), F.lit(0.0)).alias("c"))
    by = ["covariate", "v"]
    ranged = materialize(materialize(folded).repartitionByRange(*by).withColumn("__range", F.spark_partition_id()))
    totals = ranged.groupBy("covariate", "__range").agg(F.sum("t").alias("rt"), F.sum("c").alias("rc"))
    each = W.partitionBy("covariate")
    before = each.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(  # a row per covariate and range
        "covariate", "__range", F.coalesce(F.sum("rt").over(before), F.lit(0.0)).alias("t0"), F.sum("rt").over(each).alias("nt"),
        F.coalesce(F.sum("rc").over(before), F.lit(0.0)).alias("c0"), F.sum("rc").over(each).alias("nc"))
    inside = W.partitionBy("covariate", "__range").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    steps = ranged.withColumns({"t1": F.sum("t").over(inside), "c1": F.sum("c").over(inside)}).join(starts, ["covariate", "__range"])
    gap = F.abs((F.col("t0") + F.col("t1")) / F.nullif(F.col("nt"), F.lit(0.0)) - (F.col("c0") + F.col("c1")) / F.nullif(F.col("nc"), F.lit(0.0)))
    return steps.groupBy("covariate").agg(F.avg(gap).alias("ecdf_mean"), F.max(gap).alias("ecdf_max"))


def ecdf_balance(df: DataFrame, value: str, treated: str, weight=None) -> DataFrame:
    """`ecdf_balances` of one covariate."""
    return ecdf_balances(df, [value], treated, weight).select("ecdf_mean", "ecdf_max", "covariate")


def balance(df: DataFrame, matched: DataFrame, covariates: Sequence[str], treated: str,
            weight: str = "weights") -> DataFrame:
    """Share of each covariate level among treated and controls, in all rows and in matched rows.

    The standardised difference divides by the standard deviation of the level indicator among all
    treated rows, in both stages, and is NULL where that is zero. Only covariate patterns, with
    counts, are expanded to levels; the rows themselves are grouped once per stage.
    """
    stages = []
    for stage, frame, w in (("all", df, F.lit(1.0)), ("matched", matched, F.col(weight))):
        levels = _patterns(frame, covariates, treated, w)
        sums = levels.groupBy("covariate").agg(F.sum("t").alias("nt"), F.sum("c").alias("nc"))
        stages.append(
            levels.join(sums, "covariate").select(
                "covariate", "level",
                (F.coalesce("t", F.lit(0.0)) / F.col("nt")).alias(f"treated_{stage}"),
                (F.coalesce("c", F.lit(0.0)) / F.col("nc")).alias(f"control_{stage}"),
            )
        )
    both = null_safe_join(stages[0], stages[1], ["covariate", "level"], "left")
    both = both.na.fill(0.0, ["treated_matched", "control_matched"])
    sd = F.nullif(F.sqrt(F.col("treated_all") * (1 - F.col("treated_all"))), F.lit(0.0))
    return both.select(
        "covariate", "level",
        "treated_all", "control_all", ((F.col("treated_all") - F.col("control_all")) / sd).alias("std_diff_all"),
        "treated_matched", "control_matched",
        ((F.col("treated_matched") - F.col("control_matched")) / sd).alias("std_diff_matched"),
    )


def numeric_balances(df: DataFrame, values: Sequence[str], treated: str, weight=None) -> DataFrame:
    """Weighted means, standardised difference and variance ratio of numeric covariates, a row for each.

    A score is one more covariate. Each covariate leaves out its own missing values with their weights. A side
    without values has NULL figures, and so has a ratio to a variance that is zero or, with less than two
    rows, not known. The rows are read twice, whatever the number of covariates: for the means, about which
    the sums stay small, and for all weighted central moments in one aggregate.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    numbers = [F.col(v).cast("double") for v in values]
    centres = df.agg(F.struct(*[F.coalesce(F.avg(x), F.lit(0.0)).alias(f"m{i}") for i, x in enumerate(numbers)]).alias("m")).scalar()
    rows = df.select(F.col(treated).alias("__side"), w.alias("__w"), *[x.alias(f"__x{i}") for i, x in enumerate(numbers)])
    rows = rows.withColumn("__centre", centres)
    sums = {}
    for i in range(len(values)):
        d, w = F.col(f"__x{i}") - F.col(f"__centre.m{i}"), F.col("__w")
        for side, flag in (("t", 1), ("c", 0)):
            on = (F.col("__side") == flag) & F.col(f"__x{i}").isNotNull()
            sums |= {f"{side}{i}_{name}": F.sum(F.when(on, term))
                     for name, term in (("w", w), ("w2", w * w), ("s", w * d), ("q", w * d * d))}
    folded = rows.agg(F.max("__centre").alias("__centre"), *[c.alias(n) for n, c in sums.items()])

    def line(i: int, name: str):
        def mean(side):
            return F.col(f"{side}{i}_s") / F.nullif(F.col(f"{side}{i}_w"), F.lit(0.0))

        def variance(side):
            sw, sw2, q = (F.col(f"{side}{i}_{x}") for x in ("w", "w2", "q"))
            return (q - sw * mean(side) * mean(side)) * sw / F.nullif(sw * sw - sw2, F.lit(0.0))

        def positive(x):
            return F.when(x > 1e-12 * F.col(f"t{i}_q"), x)  # what rounding leaves of equal values is no variance

        centre = F.col(f"__centre.m{i}")
        return F.struct(
            F.lit(name).alias("covariate"), (mean("t") + centre).alias("treated_mean"), (mean("c") + centre).alias("control_mean"),
            ((mean("t") - mean("c")) / F.sqrt(positive(variance("t")))).alias("std_diff"),
            (variance("t") / F.when(variance("c") > 1e-12 * F.col(f"c{i}_q"), variance("c"))).alias("variance_ratio"))

    return folded.select(F.inline(F.array(*[line(i, name) for i, name in enumerate(values)])))


def numeric_balance(df: DataFrame, value: str, treated: str, weight=None) -> DataFrame:
    """`numeric_balances` of one covariate."""
    return numeric_balances(df, [value], treated, weight)


def pattern_share(df: DataFrame, covariates: Sequence[str], treated: str, to: str = "distance") -> DataFrame:
    """Add the treated share of each covariate pattern: the score of a model with all interactions, in one grouped table."""
    covariates = list(covariates)
    shares = require_keys(df, covariates, "pattern_share").groupBy(*covariates).agg(F.avg(treated).alias(to))
    return null_safe_join(df, shares, covariates, "left")


def propensity(df: DataFrame, covariates: Sequence[str], treated: str, to: str = "distance",
               max_iter: int = 25, tol: float = 1e-8) -> DataFrame:
    """Add the probability of being treated, by logistic regression (re-weighted least squares).

    The covariates are categories, so the score has one value per covariate pattern, and the
    model is fitted to the treated share of each pattern with row counts as weights, however many
    rows there are. (One line per outcome, with counts as weights, would start the fit at scores
    next to 0 and 1, from where it may not come back.)
    Covariates with one level carry nothing and are left out, as in any model with an intercept.
    """
    covariates = list(covariates)
    patterns = materialize(
        require_keys(df, covariates, "propensity")
        .groupBy(*[F.col(c).cast("string").alias(f"x{i}") for i, c in enumerate(covariates)])
        .agg(F.avg(F.col(treated).cast("double")).alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    )
    levels = patterns.agg(*[F.count_distinct(f"x{i}") for i in range(len(covariates))]).first()
    terms = [f"x{i}" for i, n in enumerate(levels) if n > 1] or ["1"]
    formula = RFormula(formula="label ~ " + " + ".join(terms), featuresCol="features", labelCol="y")
    fit = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="features", labelCol="y",
                                      weightCol="weight", predictionCol="p", maxIter=max_iter, tol=tol)
    scored = Pipeline(stages=[formula, fit]).fit(patterns).transform(patterns)
    keys = [f"x{i}" for i in range(len(covariates))]
    table = scored.groupBy(*keys).agg(F.max("p").alias(to))
    named = table.withColumnsRenamed({f"x{i}": f"__x_{c}" for i, c in enumerate(covariates)})
    same = reduce(lambda a, b: a & b, [F.col(c).cast("string") == F.col(f"__x_{c}") for c in covariates])
    return df.join(named, same, "left").drop(*[f"__x_{c}" for c in covariates])
