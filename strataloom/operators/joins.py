"""Joins in which a missing key matches a missing key, and joins that keep both copies of a column.

A broadcast hint is given only to literal tables and to the few heavy hitters of `join_heavy`; Spark
checks the size of every other side itself, and splits skewed sort-merge partitions at run time.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

log = logging.getLogger(__name__)
_RIGHT = "__right_"


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                   residual: Column | None = None) -> DataFrame:
    """Join on equal keys where NULL equals NULL; key columns appear once, from the left side."""
    right = right.withColumnsRenamed({c: _RIGHT + c for c in on})
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(_RIGHT + c)) for c in on])
    if residual is not None:
        condition = condition & residual
    out = left.join(right, condition, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[_RIGHT + c for c in on])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns the two sides share; NULL keys match each other."""
    on = [c for c in left.columns if c in set(right.columns)]
    if not on:
        raise ValueError("the two sides share no column")
    log.info("natural %s join on %s", how, ", ".join(on))
    return null_safe_join(left, right, on, how)


def not_in(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Rows of `left` whose key does not occur in `right`; the right side is reduced to its keys."""
    on = list(on) if on else [c for c in left.columns if c in set(right.columns)]
    return null_safe_join(left, right.select(*on).distinct(), on, "left_anti")


def join_suffix(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join that keeps both copies of clashing columns, marked by the suffixes."""
    clash = [c for c in left.columns if c in set(right.columns) and c not in on]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return null_safe_join(left, right, on, how)


def join_keyed(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "inner",
               suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """`join_suffix` with different key names, given as {left name: right name}."""
    return join_suffix(left, right.withColumnsRenamed({r: k for k, r in keys.items()}), list(keys), how, suffixes)


def join_heavy(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", partitions: int | None = None) -> DataFrame:
    """`null_safe_join` for a left side in which single keys may hold a large part of the rows.

    Keys are counted with partial aggregation. A heavy hitter has more rows than half an average shuffle
    partition, so there are at most two per partition; its rows are dealt over salts, of a
    sixteenth of a partition each, and its rows of the right side are copied once per salt. All other
    keys are joined as they are. `partitions` is the session's number of shuffle partitions by default.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("join_heavy keeps the rows of the left side")
    spark = left.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = materialize(left.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")))
    total = sizes.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    heavy = F.broadcast(sizes.where(F.col("__rows") > total / (2 * partitions)).select(
        *on, F.ceil(F.col("__rows") / F.lit(max(1.0, total / (16 * partitions)))).cast("int").alias("__salts")))
    # The salt of a row is the same after a retry: it comes from the row and its partition, not from a count of rows.
    plain = [f.name for f in left.schema if not f.dataType.simpleString().startswith(("map", "variant"))]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.spark_partition_id()), F.col("__salts"))
    salted = null_safe_join(left, heavy, on, "left").withColumn("__salt", F.coalesce(spread, F.lit(0)).cast("int")).drop("__salts")
    copied = null_safe_join(right, heavy, on, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    return null_safe_join(salted, copied, [*on, "__salt"], how).drop("__salt")


def dimension_roles(fact: DataFrame, dimension: DataFrame, key: str,
                    roles: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Join one dimension in several roles: (fact key, column prefix, join type) per role."""
    out = fact
    for fact_key, prefix, how in roles:
        named = dimension.withColumnsRenamed(
            {c: fact_key if c == key else prefix + c for c in dimension.columns}
        )
        out = null_safe_join(out, named, [fact_key], how)
    return out


def peers(df: DataFrame, means: DataFrame, on: Sequence[str], label: Column, position: int) -> DataFrame:
    """Attach the mean row of each row's own cut, with a label and its place among the cuts.

    A row or cut with a missing key has no peers.
    """
    return df.join(means, list(on)).withColumns({"breakout": label, "position": F.lit(position)})


def require_keys(df: DataFrame, keys: Iterable[str], what: str) -> DataFrame:
    """Fail at run time when a key is NULL, in place of losing or mixing such rows."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    first = next(iter(keys))
    checked = F.when(missing, F.raise_error(F.lit(f"{what}: missing key"))).otherwise(F.col(first))
    return df.withColumn(first, checked)
