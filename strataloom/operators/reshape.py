"""Long form, and nested rows of bounded length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import draw32
from ..session import materialize
from .hot import PARTS, hot_groups
from .joins import null_safe_join
from .running import running_totals


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name_to: str = "name",
            value_to: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name_to, value_to)


COPIES = 10_000  # equal rows that are written out together


def parts(df: DataFrame, keys: Sequence[str], draw: str, ties: Sequence[str], rows: int, to: str = "part") -> DataFrame:
    """Number the rows of each group, in the order of a draw, in parts of `rows` rows; the last part may be shorter.

    One rule for groups of every size, and no task holds a whole group. The rows are written once;
    groups of one part are known by their size, so only the rows of longer ones are sorted.
    """
    df = materialize(df)
    long = hot_groups(df, keys, rows).drop(PARTS)
    counted = running_totals(null_safe_join(df, long, keys, "left_semi"), keys, draw, ties, {"__row": F.lit(1).cast("long")})
    numbered = counted.withColumn(to, F.floor(F.col("__row_before") / rows)).drop("__row", "__row_before", "__row_total")
    return null_safe_join(df, long, keys, "left_anti").withColumn(to, F.lit(0).cast("long")).unionByName(numbered)


def nest(df: DataFrame, keys: Sequence[str], items: Sequence[str], target_rows: int = 100_000) -> DataFrame:
    """Group rows into arrays `data` of structs, sorted, with a `part` number.

    Every part holds `target_rows` rows but the last of a group, so no array grows with the group.
    Equal rows are folded to a count first and every copy gets a draw of its own, so they are cut, too.
    """
    folded = df.groupBy(*keys, *items).agg(F.count(F.lit(1)).alias("__copies"))
    blocks = folded.withColumn("__first", F.explode(F.expr(f"sequence(0L, __copies - 1L, {COPIES}L)")))
    last = F.least(F.col("__first") + F.lit(COPIES - 1), F.col("__copies") - 1)
    copies = blocks.withColumn("__copy", F.explode(F.sequence("__first", last)))
    placed = copies.withColumn("__draw", draw32("nest", *items, "__copy"))
    return parts(placed, keys, "__draw", [*items, "__copy"], target_rows).groupBy(*keys, "part").agg(
        F.sort_array(F.collect_list(F.struct(*items))).alias("data")
    )


def unnest(df: DataFrame, keys: Sequence[str], column: str = "data") -> DataFrame:
    return df.select(*keys, F.inline(column))
