"""Query of the personal data search."""

from __future__ import annotations

from pyspark.sql import functions as F

from .pii import BASE_KINDS, find_personal_data, span_list
from .registry import query, table


def _count(kind):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@query()
def op9_personal_data(spark, folder):
    """Counts and digests of the spans of every document."""
    found = find_personal_data(table(spark, folder, "documents"))
    counts = [_count(k).alias(f"n_{k}") for k in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.concat("base", "added")).alias("spans"))
