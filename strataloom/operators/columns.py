"""Column sets: move, rename by year, pick by prefix or type."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.nulls import as_value, strict_sum


def relocate(df: DataFrame, *moved: str, before: str | None = None, after: str | None = None) -> DataFrame:
    """Move columns before or after another column; to the front when neither is given."""
    rest = [c for c in df.columns if c not in moved]
    if before is not None:
        at = rest.index(before)
    elif after is not None:
        at = rest.index(after) + 1
    else:
        at = 0
    return df.select(*rest[:at], *moved, *rest[at:])


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]


def any_column(df: DataFrame, prefix: str, test) -> DataFrame:
    """Keep rows where `test(column)` holds for any column whose name starts with the prefix."""
    hits = [test(F.col(f"`{c}`")) for c in df.columns if c.startswith(prefix)]
    if not hits:
        raise ValueError(f"no column starts with {prefix!r}")
    return df.where(reduce(lambda a, b: a | b, hits))


def confident(df: DataFrame, label: str, minimum: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Drop rows whose label has a score column below its minimum; other labels stay.

    `minimum` maps a label value to (score column, least score). A missing score does not drop a row.
    """
    for value, (score, least) in minimum.items():
        low = (F.col(label) == value) & (F.col(f"`{score}`") < least)
        df = df.where(~F.coalesce(low, F.lit(False)))
    return df


def harmonize_year(df: DataFrame, year: int, columns: Iterable[str]) -> DataFrame:
    """Pick columns and give year-suffixed ones a common name.

    `columns` are the common names, with `YY` where the file of one year has its two digits. A
    name the file holds as it stands (a birth year `DOBYY`) is kept.
    """
    present = set(df.columns)
    return df.selectExpr(*[f"`{_year_name(c, year, present)}` AS `{c}`" for c in columns])


def _year_name(column: str, year: int, present: set[str]) -> str:
    digits = f"{year % 100:02d}"
    spots = [i for i in range(len(column) - 1) if column[i : i + 2] == "YY"]
    for name in [column, *[column[:i] + digits + column[i + 2 :] for i in spots]]:
        if name in present:
            return name
    raise ValueError(f"no column for {column!r} in the file of {year}")


def tag_year(df: DataFrame, year: int, id_column: str, to: str, year_column: str) -> DataFrame:
    """Add the data year and an id that is unique across years (id text followed by the year)."""
    return df.withColumns(
        {year_column: F.lit(year), to: F.concat(F.col(id_column).cast("string"), F.lit(str(year)))}
    )


def pool(*frames: DataFrame, fill: bool = False) -> DataFrame:
    """Stack frames by column name and keep duplicates; `fill` allows missing columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def pooled_weight(weight: Column, years: int) -> Column:
    return weight / F.lit(float(years))


def total_row(df: DataFrame, label: str, text="Total", by: Iterable[str] = ()) -> DataFrame:
    """Append one row per group (or one row) with the sums of all numeric columns.

    A sum with a missing part is missing. The label column of the new rows holds `text`; other non-numeric columns are NULL.
    """
    by = list(by)
    sums = [strict_sum(f"`{c}`").alias(c) for c in numeric_columns(df, exclude=by)]
    totals = df.groupBy(*by).agg(*sums).withColumn(label, as_value(text))
    return pool(df, totals, fill=True)
