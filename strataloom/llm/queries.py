"""One query per operator, on its whole table with production parameters."""

from __future__ import annotations

from . import queries_chat, queries_embeddings, queries_language, queries_lines, queries_minhash, queries_mixing, queries_packing, queries_pii, queries_prefixes, queries_quality, queries_repeats, queries_retrieval, queries_rules  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
