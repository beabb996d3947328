"""Keyed samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.draws import draw32


def sample_rows(df: DataFrame, n: int, key: str, seed: int | str) -> DataFrame:
    """n rows without replacement: the least keyed draws (a top-n, not a full sort)."""
    return df.withColumn("__draw", draw32(seed, key)).orderBy("__draw", key).limit(n).drop("__draw")


def sample_ids(df: DataFrame, n: int, row_key: str, id_column: str, seed: int | str) -> DataFrame:
    """Distinct ids among n sampled rows, so possibly fewer than n, numbered from 1 in id order."""
    picked = sample_rows(df.select(row_key, id_column) if row_key != id_column else df.select(id_column),
                         n, row_key, seed)
    ids = picked.select(id_column).distinct()
    # At most n rows are left for the one window partition.
    return ids.withColumn("n", F.row_number().over(W.partitionBy().orderBy(id_column)))
