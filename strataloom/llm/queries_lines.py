"""Query of the line removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from .lines import without_repeated_lines
from .registry import query, table


@query()
def op2_line_dedup(spark, folder):
    """What stays of every document without the lines that nearly repeat an earlier one."""
    found = without_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return found.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"),
                        F.length(text).cast("long").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"))
