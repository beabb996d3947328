"""Finding oversized groups and splitting them by a uniform draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import SPAN
from .joins import null_safe_join

TARGET_ROWS = 1_000_000
PARTS = "__parts"
PART = "__part"


def hot_groups(df: DataFrame, keys: Sequence[str], target_rows: int = TARGET_ROWS) -> DataFrame:
    """All groups above `target_rows` and the number of parts each is to be split into.

    Every group gets as many parts as its rows need, so there are at most two parts per
    `target_rows` rows of the input. The table grows with the input and is joined as any other.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return parts_of_sizes(sizes, keys, "__rows", target_rows)


def parts_of_sizes(sizes: DataFrame, keys: Sequence[str], rows: str, target_rows: int) -> DataFrame:
    """`hot_groups` from group sizes that are known already."""
    size = F.col(rows)
    return sizes.where(size > target_rows).select(*keys, F.ceil(size / F.lit(float(target_rows))).cast("long").alias(PARTS))


def part_of(draw: Column, parts: Column) -> Column:
    """Part number of a draw in [0, 2**32): parts are equal slices, in the order of the draw."""
    return F.coalesce(F.floor(draw * parts / F.lit(float(SPAN))).cast("long"), F.lit(0).cast("long"))


def split_hot(df: DataFrame, keys: Sequence[str], draw: str, hot: DataFrame) -> DataFrame:
    """Add the part count (NULL for ordinary groups) and the part number of each row."""
    return null_safe_join(df, hot, keys, "left").withColumn(PART, part_of(F.col(draw), F.col(PARTS)))
