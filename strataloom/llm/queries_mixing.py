"""Query of the mixing."""

from __future__ import annotations

from .mixing import mixture
from .registry import query, table


@query()
def op8_mixture(spark, folder):
    """What the mix takes of every document."""
    mixed = mixture(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
