"""Uniform draws keyed by row identity.

A draw depends on the seed and the key columns only. It is the same for every partitioning and
after every task retry, and any SQL engine with md5 can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col

SPAN = 4294967296  # draws are whole numbers in [0, 2**32)


def draw32(seed: int | str, *keys: Column | str) -> Column:
    """A whole-number draw in [0, 2**32). NULL keys take part as the text `\\N`."""
    parts = [F.coalesce(as_col(k).cast("string"), F.lit("\\N")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.coalesce(number, F.lit(0))  # never NULL, and so known to the optimizer


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """A draw in [0, 1)."""
    return draw32(seed, *keys) / F.lit(float(SPAN))
