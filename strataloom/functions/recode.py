"""Bands, code-to-label recodes and ordered rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col, as_value
from .text import whole_text

# Age bands.
AGE_EDGES = (5, 18, 30, 40, 50, 60, 70, 80)
AGE_LABELS = (
    "Under 5", "5 - 17", "18 - 29", "30 - 39", "40 - 49",
    "50 - 59", "60 - 69", "70 - 79", "80 and over",
)


def band(c: Column | str, edges: Sequence[float] = AGE_EDGES, labels: Sequence[str] = AGE_LABELS) -> Column:
    """Half-open bands on real numbers: label k covers [edge k-1, edge k). NULL stays NULL."""
    c = as_col(c)
    out = F.when(c < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        out = out.when(c < edge, label)
    return out.when(c >= edges[-1], labels[-1])


def whole_band(
    c: Column | str, edges: Sequence[int] = AGE_EDGES, labels: Sequence[str] = AGE_LABELS
) -> Column:
    """Closed bands on whole numbers: label k covers edge k-1 to edge k minus 1.

    A value in a gap between two bands (17.5) is given back as text.
    """
    c = as_col(c)
    out = F.when(c < edges[0], labels[0])
    for low, high, label in zip(edges, edges[1:], labels[1:]):
        out = out.when(c.between(low, high - 1), label)
    return out.when(c >= edges[-1], labels[-1]).otherwise(whole_text(c))


def recode(c: Column | str, labels: Mapping, default=None) -> Column:
    """Label per code; codes that are not listed, and NULL, take the default."""
    c = as_col(c)
    out = None
    for code, label in labels.items():
        out = F.when(c == code, label) if out is None else out.when(c == code, label)
    return out.otherwise(as_value(default))


def first_rule(*rules: tuple[Column, object], default=None) -> Column:
    """Value of the first rule that holds; a rule that is NULL does not hold."""
    out = None
    for condition, value in rules:
        value = as_value(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(as_value(default))


def top_code(c: Column | str, limit) -> Column:
    """Values above the limit become the limit; NULL stays NULL."""
    c = as_col(c)
    return F.when(c > limit, F.lit(limit)).otherwise(c)
