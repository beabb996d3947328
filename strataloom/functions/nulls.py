"""Expressions that keep a missing value missing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def if_known(condition: Column, yes, no) -> Column:
    """`yes` / `no` by a condition; NULL where the condition itself is NULL."""
    return F.when(condition.isNull(), F.lit(None)).when(condition, as_value(yes)).otherwise(as_value(no))


def strict_sum(c: Column | str) -> Column:
    """Sum that is NULL as soon as one input of the group is NULL."""
    c = as_col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def distinct_count(c: Column | str) -> Column:
    """Number of distinct values where a missing value counts as one more value."""
    c = as_col(c)
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))


def sentinel_to_null(df: DataFrame, columns: Iterable[str], sentinel) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns})


def drop_sentinel(df: DataFrame, columns: Iterable[str], sentinel: str) -> DataFrame:
    """Drop rows where any column equals the sentinel, compared as text; NULL rows drop too."""
    for c in columns:
        df = df.where(F.col(c).cast("string") != F.lit(sentinel))
    return df
