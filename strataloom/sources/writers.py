"""Writers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, csv: bool = False, append: bool = False,
                partition_by: Iterable[str] = ()) -> DataFrame:
    """Write a table and give it back as read from storage, so later steps do not redo its plan."""
    writer = df.write.mode("append" if append else "overwrite").partitionBy(*partition_by)
    if csv:
        writer.option("header", True).option("nullValue", "NA").csv(path)
        return df.sparkSession.read.schema(df.schema).option("header", True).option("nullValue", "NA").csv(path)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_batches(frames: Iterable[DataFrame], path: str) -> None:
    """First frame replaces the table, each later one is appended."""
    for i, df in enumerate(frames):
        write_table(df, path, append=i > 0)


def export_subset(tables: dict[str, DataFrame], names: Iterable[str], base: str) -> None:
    """Write only the named tables of a set, each below `base`."""
    for name in names:
        write_table(tables[name], f"{base}/{name}")
