"""Readers. None of them infers a schema from the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import strip_quotes


def _schema(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_csv(spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header. Columns are found by their header name; "NA" and blanks are missing.

    All files of a folder must have the same header: one with other columns, or in another order,
    is an error. `multi_line` is for values with line breaks in quotes; such files are not split.
    """
    wanted = _schema(schema)
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    text = StructType.fromDDL(", ".join(f"`{c}` string" for c in reader.csv(path).columns))
    raw = reader.schema(text).option("nullValue", "NA").option("enforceSchema", False).csv(path)
    return raw.select(*[
        F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")).try_cast(f.dataType).alias(f.name) for f in wanted.fields
    ])


def read_lines(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """Lines of text files, as `value`, without the first `skip` lines of each file; files may be split.

    Lines are counted per split, and a split knows how many lines of its file stand before it, so a
    line's number is found where the line is read. Only the splits in which a file begins are compared line by line.
    """
    lines = spark.read.text(path)
    if not skip:
        return lines
    placed = lines.select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__at"),
                          F.monotonically_increasing_id().alias("__id"))  # goes up by one inside a split
    splits = placed.groupBy("__file", "__at").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.partitionBy("__file").orderBy("__at").rowsBetween(W.unboundedPreceding, -1))
    early = splits.withColumn("__before", F.coalesce(before, F.lit(0))).where(F.col("__before") < skip).drop("__n")
    number = F.col("__before") + F.col("__id") - F.col("__first")
    return placed.join(early, ["__file", "__at"], "left").where(F.coalesce(number >= skip, F.lit(True))).select("value")


def read_quoted_csv(spark: SparkSession, path: str, names: Mapping[str, str], all_columns: list[str],
                    titles: Sequence[str] = (), skip: int = 0) -> DataFrame:
    """CSV whose values and headers stand in single quotes, below title lines.

    `all_columns` are the columns of the file in order and `names` the wanted ones with their new
    names. The header is the line that repeats all column names, and a title line is one of
    `titles` alone in its line, or one of the first `skip` lines of a file, whatever it says; every other line is
    data, so the file can be split.
    """
    schema = ", ".join(f"`{c}` string" for c in all_columns)
    if skip:
        raw = read_lines(spark, path, skip).where(F.length("value") > 0).select(F.from_csv("value", schema).alias("line")).select("line.*")
    else:
        raw = spark.read.schema(StructType.fromDDL(schema)).csv(path)
    clean = raw.select(*[strip_quotes(F.col(f"`{c}`")).alias(c) for c in all_columns])
    header = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.lit(c)) for c in all_columns])
    alone = [F.col(f"`{c}`").isNull() for c in all_columns[1:]]
    title = reduce(and_, alone, F.coalesce(F.col(f"`{all_columns[0]}`").isin(*titles), F.lit(False)))
    return clean.where(~header & ~title).select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def read_partition(spark: SparkSession, base: str, schema: str | StructType | None = None, **parts) -> DataFrame:
    """Rows of one partition of a table, such as `type="FYC", year=2021` or `setting="ED", year=2020`.

    The partition columns are filtered, so only their folders are read, and then dropped.
    """
    reader = spark.read
    if schema is not None:
        kinds = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in parts.items())
        reader = reader.schema(StructType(_schema(schema).fields + StructType.fromDDL(kinds).fields))
    df = reader.parquet(base)
    for name, value in parts.items():
        df = df.where(F.col(name) == F.lit(value))
    return df.drop(*parts)
