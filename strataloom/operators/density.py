"""Kernel densities of numeric covariates on both sides of a match, from rows folded to a fixed grid.

Each row shares its weight between the two grid points next to its value, in proportion to its
nearness (linear binning), so the rows are read once for all covariates, sides and stages and fold
to as many rows as there are grid points. The normal kernel is then summed over the grid in one
array expression. The error against the direct sum over rows is of the order of the squared grid step
over the squared bandwidth; it is zero for values on the grid.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POINTS = 128  # of a grid; the sums are quadratic in it
CUT = 3.0  # bandwidths that the grid goes beyond the values


def grids(df: DataFrame, values: Sequence[str], points: int = POINTS) -> DataFrame:
    """Per covariate, `low` and `step` of its grid and the bandwidth, 0.9 sd n^(-1/5) over all rows with a value.

    A covariate without spread has the bandwidth 1; one without values has no row.
    """
    long = df.select(*[F.col(v).cast("double").alias(v) for v in values]).unpivot([], list(values), "covariate", "x")
    sizes = long.where("x IS NOT NULL").groupBy("covariate").agg(
        F.min("x").alias("a"), F.max("x").alias("b"), F.stddev_samp("x").alias("sd"), F.count("x").alias("n"))
    width = F.coalesce(F.nullif(F.lit(0.9) * F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)), F.lit(0.0)), F.lit(1.0))
    low = F.col("a") - F.lit(CUT) * F.col("width")
    return sizes.withColumn("width", width).select(
        "covariate", low.alias("low"), ((F.col("b") + F.lit(CUT) * F.col("width") - low) / F.lit(points - 1.0)).alias("step"), "width")


def densities(stages: dict[str, tuple[DataFrame, str | None]], values: Sequence[str], treated: str, points: int = POINTS) -> DataFrame:
    """`stage`, `covariate`, `treated`, `x`, `density` at every grid point.

    `stages` maps names to (rows, weight column or None for equal weights); the grid comes from the
    first stage, whose range must hold the values of the others: rows beyond its grid are an error. Missing values are left
    out with their weights.
    """
    grid = F.broadcast(grids(next(iter(stages.values()))[0], values, points))  # a row per covariate
    every = None
    for stage, (df, weight) in stages.items():
        w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
        one = df.select(F.lit(stage).alias("stage"), F.col(treated).cast("int").alias("treated"), w.alias("w"),
                        *[F.col(v).cast("double").alias(v) for v in values])
        every = one if every is None else every.unionByName(one)
    long = every.unpivot(["stage", "treated", "w"], list(values), "covariate", "x").where("x IS NOT NULL").join(grid, "covariate")
    place = (F.col("x") - F.col("low")) / F.col("step")
    cell = F.floor(place).cast("int")
    inside = F.when((cell < 0) | (cell >= points - 1), F.raise_error(F.lit("densities: a value lies beyond the grid")).cast("int"))
    keys = ["stage", "covariate", "treated"]
    binned = long.withColumns({"cell": inside.otherwise(cell), "far": place - F.floor(place)}).groupBy(*keys, "cell").agg(
        F.sum(F.col("w") * (F.lit(1.0) - F.col("far"))).alias("near"), F.sum(F.col("w") * F.col("far")).alias("next"))
    whole = binned.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("near", "next")))).alias("cells"), F.sum(F.col("near") + F.col("next")).alias("w"))

    def mass(i):
        own, before = F.try_element_at("cells", i), F.try_element_at("cells", i - 1)
        return F.coalesce(own["near"], F.lit(0.0)) + F.coalesce(before["next"], F.lit(0.0))

    every_point = F.sequence(F.lit(0), F.lit(points - 1))
    placed = whole.join(grid, "covariate").withColumn(
        "masses", F.filter(F.transform(every_point, lambda i: F.struct(i.alias("i"), mass(i).alias("m"))), lambda x: x["m"] != 0))
    ratio = F.col("step") / F.col("width")
    scale = F.lit(1 / math.sqrt(2 * math.pi)) / (F.col("w") * F.col("width"))

    def height(j):
        return F.aggregate("masses", F.lit(0.0), lambda total, p: total + p["m"] * F.exp(
            F.lit(-0.5) * F.pow((j - p["i"]) * F.col("ratio"), F.lit(2.0))))

    curve = F.transform(every_point, lambda j: F.struct((F.col("low") + j * F.col("step")).alias("x"), (height(j) * F.col("scale")).alias("density")))
    return placed.withColumns({"ratio": ratio, "scale": scale}).select(*keys, F.inline(curve))
