"""Running totals inside groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .hot import PART, PARTS, TARGET_ROWS, hot_groups, split_hot
from .joins import null_safe_join


def running_totals(df: DataFrame, keys: Sequence[str], draw: str, ties: Sequence[str],
                   values: dict[str, Column], target_rows: int | None = TARGET_ROWS,
                   hot: DataFrame | None = None) -> DataFrame:
    """Per row, the sum of each value over the rows before it in its group, and over the group.

    Rows are ordered by a uniform `draw` column and then by `ties`. Groups above `target_rows`
    are cut into equal slices of the draw: each slice is one window partition, and slice totals
    carry the sums across slices. Adds `<name>_before`
    and `<name>_total` for every entry of `values`. `target_rows=None` is for inputs that are
    known to be small: every group is then one window partition. `hot` gives the oversized groups
    where the caller knows them.
    """
    for name, value in values.items():
        df = df.withColumn(name, value)
    if target_rows is None:
        return _within(df, keys, [draw, *ties], list(values))
    cut = split_hot(df, keys, draw, hot_groups(df, keys, target_rows) if hot is None else hot)

    slices = (
        cut.where(F.col(PARTS).isNotNull())
        .groupBy(*keys, PART)
        .agg(*[F.sum(n).alias(f"__slice_{n}") for n in values])
    )
    upto = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*keys)
    offsets = slices.select(
        *keys, PART,
        *[(F.sum(f"__slice_{n}").over(upto) - F.col(f"__slice_{n}")).alias(f"__offset_{n}") for n in values],
        *[F.sum(f"__slice_{n}").over(whole).alias(f"__whole_{n}") for n in values],
    )

    local = _within(cut, [*keys, PART], [draw, *ties], list(values))
    joined = null_safe_join(local, offsets, [*keys, PART], "left")
    for n in values:
        joined = joined.withColumns({
            f"{n}_before": F.col(f"{n}_before") + F.coalesce(f"__offset_{n}", F.lit(0)),
            f"{n}_total": F.coalesce(f"__whole_{n}", f"{n}_total"),
        })
    extra = [f"__offset_{n}" for n in values] + [f"__whole_{n}" for n in values]
    return joined.drop(PART, PARTS, *extra)


def _within(df: DataFrame, keys: Sequence[str], order: Sequence[str], names: Sequence[str]) -> DataFrame:
    place = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*keys)
    return df.select(
        "*",
        *[(F.sum(n).over(place) - F.col(n)).alias(f"{n}_before") for n in names],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in names],
    )
