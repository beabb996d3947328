"""Shares, moments and picks per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col
from .joins import null_safe_join


def shares(df: DataFrame, category: str, source: str | None = None) -> DataFrame:
    """Rows per category and their share of all rows of the source, NULL categories included in
    the total but not listed."""
    by = [source] if source else []
    counts = df.groupBy(*by, category).agg(F.count(F.lit(1)).alias("n"))
    if source:
        totals = counts.groupBy(source).agg(F.sum("n").alias("__total"))
        counts = null_safe_join(counts, totals, [source])
        total = F.col("__total")
    else:
        total = df.agg(F.count(F.lit(1))).scalar()
    listed = counts.where(F.col(category).isNotNull())
    return listed.withColumn("share", F.col("n") / total).drop("__total")


def moments(df: DataFrame, value: str, prefix: str = "") -> DataFrame:
    """One row with the mean and the sample standard deviation."""
    return df.agg(F.avg(value).alias(f"{prefix}mean"), F.stddev_samp(value).alias(f"{prefix}sd"))


def stretch(df: DataFrame, value: str, to: str, target: DataFrame, target_value: str) -> DataFrame:
    """Scale the spread of a column to that of another sample; its own mean stays.

    The moments are scalar subqueries, so the rows themselves are not shuffled or joined.
    """
    own = moments(df, value).select(F.struct("mean", "sd")).scalar()
    target_sd = target.agg(F.stddev_samp(target_value)).scalar()
    known = df.withColumns({"__own": own, "__target": target_sd})
    mean, sd = F.col("__own.mean"), F.col("__own.sd")
    return known.withColumn(to, (F.col(value) - mean) / sd * F.col("__target") + mean).drop("__own", "__target")


def first_by(df: DataFrame, by: Sequence[str], value: str, order: Column | str) -> DataFrame:
    """One value per group: the one with the least order key."""
    return df.groupBy(*by).agg(F.min_by(value, as_col(order)).alias(value))


def count_or_zero(people: DataFrame, rows: DataFrame, key: str, to: str) -> DataFrame:
    """Add the number of rows per person; a person without rows has 0."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(to))
    return people.join(counts, key, "left").withColumn(to, F.coalesce(to, F.lit(0).cast("long")))


def proportional(df: DataFrame, weight: str, total: int, to: str) -> DataFrame:
    """Share `total` out in proportion to a weight, each share cut to a whole number."""
    whole = df.agg(F.sum(weight)).scalar()
    return df.withColumn(to, (F.lit(float(total)) * F.col(weight) / whole).cast("int"))
