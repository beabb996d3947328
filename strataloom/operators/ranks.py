"""Exact ranks over a whole table, without one task for the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.quantiles import normal_quantile, plotting_position
from ..session import materialize


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """Per distinct value: `copies`, `before` (rows with a smaller value) and `rows` (all rows).

    Equal values fold into one row first, so a value that fills a third of the table is one row
    per task. The distinct values are written once, in ranges, as many as the session has shuffle
    partitions; a range is a window partition, and range totals carry the counts across. Values
    keep their type. Missing values take no part.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("copies"))
    ranged = materialize(materialize(counts).repartitionByRange(value).withColumn("__range", F.spark_partition_id()))
    ranges = ranged.groupBy("__range").agg(F.sum("copies").alias("__in_range"))
    upto = W.partitionBy().orderBy("__range").rowsBetween(W.unboundedPreceding, W.currentRow)
    # One row per shuffle partition from here on.
    offsets = ranges.select(
        "__range",
        (F.sum("__in_range").over(upto) - F.col("__in_range")).alias("__offset"),
        F.sum("__in_range").over(W.partitionBy()).alias("rows"),
    )
    inside = W.partitionBy("__range").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        ranged.withColumn("__local", F.sum("copies").over(inside) - F.col("copies"))
        .join(offsets, "__range")
        .select(value, "copies", (F.col("__local") + F.col("__offset")).alias("before"), "rows")
    )


def percent_rank(df: DataFrame, value: str, to: str) -> DataFrame:
    """(rank - 1) / (rows - 1) with the least rank for ties; NULL for NULL; 0 for a lone row.

    Rows without a value are led past the join. A value that many rows share is one key against
    one row, which Spark's skew handling splits.
    """
    share = F.when(F.col("rows") > 1, F.col("before") / (F.col("rows") - 1)).otherwise(F.lit(0.0))
    ranks = value_ranks(df, value).select(F.col(value).alias("__rv"), share.alias(to))
    known = df.where(F.col(value).isNotNull()).join(ranks, F.col(value) == F.col("__rv"), "left").drop("__rv")
    return known.unionByName(df.where(F.col(value).isNull()).withColumn(to, F.lit(None).cast("double")))


def normal_points(df: DataFrame, value: str, block: int = 10_000) -> DataFrame:
    """Sample value against theoretical normal quantile, one row per row of the input.

    Copies of a value get neighbouring positions, as after a sort. A value with very many copies
    is cut into blocks of blocks that are spread over the tasks before they are written out.
    """
    ranks = value_ranks(df, value)
    outer = ranks.withColumn("__outer", F.explode(F.expr(f"sequence(1L, copies, {block * block}L)")))
    reach = F.least(F.col("copies"), F.col("__outer") + F.lit(block * block - 1))
    blocks = outer.repartition("before", "__outer").withColumn(
        "first", F.explode(F.sequence(F.col("__outer"), reach, F.lit(block).cast("long")))
    ).repartition("before", "first")
    last = F.least(F.col("copies"), F.col("first") + F.lit(block - 1))
    points = blocks.withColumn("copy", F.explode(F.sequence("first", last)))
    place = F.col("before") + F.col("copy")
    return points.select(
        F.col(value).cast("double").alias("sample"), place.alias("position"),
        normal_quantile(plotting_position(place, F.col("rows"))).alias("theoretical"),
    )
