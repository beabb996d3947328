"""Query of the packing."""

from __future__ import annotations

import public_tokenizers

from .packing import pack
from .registry import query, table


@query()
def op4_best_two_fit(spark, folder):
    """Every document, packed into sequences of 4096 tokens."""
    packed = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
