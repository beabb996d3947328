"""Queries on the star-schema tables, each with its SQL counterpart."""

from . import coverage, domain  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
