"""Column expressions on words and lines that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bytes between words.
GAP_CLASS = "\\x20\\x09-\\x0D"
GAPS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The maximal runs of non-gap characters, in order; an empty array without any."""
    return F.array_remove(F.split(text, f"[{GAP_CLASS}]+"), "")


def n_words(text: Column) -> Column:
    """The number of words, without building them: each word and its gaps shrink to one character."""
    shrunk = F.regexp_replace(text, f"[{GAP_CLASS}]*+[^{GAP_CLASS}]++[{GAP_CLASS}]*+", "x")
    return F.length(F.regexp_replace(shrunk, f"[{GAP_CLASS}]++", "")).cast("long")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once per row."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def unused(name: str, columns: Iterable[str]) -> str:
    """`name`, made longer until no column has it, whatever the case of its letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
