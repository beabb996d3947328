"""Classes and scores from code prefixes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = 62  # class bits per long


def prefix_table(df: DataFrame, classes: Mapping[str, Sequence[str]]) -> dict[int, DataFrame]:
    """Per prefix length a table (prefix, class bits) with one row per prefix."""
    words = range((len(classes) + WORD - 1) // WORD)
    bits: dict[int, dict[str, list[int]]] = {}
    for place, prefixes in enumerate(classes.values()):
        for prefix in prefixes:
            row = bits.setdefault(len(prefix), {}).setdefault(prefix, [0 for _ in words])
            row[place // WORD] |= 1 << (place % WORD)
    schema = "prefix string, " + ", ".join(f"bits{w} long" for w in words)
    spark = df.sparkSession
    return {
        length: spark.createDataFrame([(p, *b) for p, b in sorted(rows.items())], schema)
        for length, rows in sorted(bits.items())
    }


def prefix_flags(df: DataFrame, key: str, code: str, classes: Mapping[str, Sequence[str]],
                 weights: Mapping[str, int]) -> DataFrame:
    """One row per key: a 0/1 column per class, and `score`, the weights of its classes added up.

    A class holds when any code of the key starts with one of its prefixes. Each prefix length is
    one lookup in a small literal table that gives the classes as bits; bits are or-ed before and
    after one shuffle by key, so a key with very many codes is one value per task on the way.
    """
    if not classes:
        raise ValueError("no classes given")
    names = list(classes)
    words = range((len(names) + WORD - 1) // WORD)
    found = df.select(key, code)
    for length, table in prefix_table(df, classes).items():
        table = table.withColumnsRenamed({"prefix": "__prefix", **{f"bits{w}": f"__b{length}_{w}" for w in words}})
        found = found.join(  # a literal table: its size is the number of prefixes given
            F.broadcast(table), F.substring(F.col(code), 1, length) == F.col("__prefix"), "left"
        ).drop("__prefix")
    marks = found.groupBy(key).agg(*[
        F.bit_or(_either([c for c in found.columns if c.startswith("__b") and c.endswith(f"_{w}")])).alias(f"__w{w}")
        for w in words
    ])
    flags = {
        n: F.shiftrightunsigned(F.col(f"__w{i // WORD}"), i % WORD).bitwiseAND(F.lit(1)).cast("int")
        for i, n in enumerate(names)
    }
    scored = marks.select(key, *[c.alias(n) for n, c in flags.items()])
    score = F.lit(0)
    for n in names:
        if weights.get(n):
            score = score + F.col(n) * F.lit(weights[n])
    return scored.withColumn("score", score)


def _either(columns: Sequence[str]):
    out = F.lit(0).cast("long")
    for c in columns:
        out = out.bitwiseOR(F.coalesce(F.col(c), F.lit(0).cast("long")))
    return out


def long_flags(flags: DataFrame, key: str) -> DataFrame:
    """Flags and score in long form: (key, Field_Name, Field_Value)."""
    fields = [c for c in flags.columns if c != key]
    return flags.unpivot([key], fields, "Field_Name", "Field_Value")
