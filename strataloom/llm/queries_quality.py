"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from .quality import fit_quality, held_out, with_score
from .registry import query, table


@query()
def op7_quality_classifier(spark, folder):
    """Score and verdict of every document."""
    docs = table(spark, folder, "documents")
    model = fit_quality(docs, table(spark, folder, "labels"))
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
