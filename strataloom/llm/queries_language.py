"""Query of the language identification."""

from __future__ import annotations

from pyspark.sql import functions as F

from .language import identify, learn_languages
from .quality import held_out
from .registry import query, table


@query()
def op13_language(spark, folder):
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    found = identify(docs, learn_languages(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
