"""Text functions of the report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col, as_value


def title_case(c: Column | str) -> Column:
    """Capitalise each word, also after a hyphen ("Non-Hispanic White Only")."""
    pieces = F.split(F.lower(as_col(c)), "(?<=-)")
    return F.array_join(F.transform(pieces, F.initcap), "")


def squish(c: Column | str) -> Column:
    """Trim, and turn each run of white space into one blank."""
    return F.trim(F.regexp_replace(as_col(c), r"\s+", " "))


def drop_first_punctuation(c: Column | str) -> Column:
    """Remove the first punctuation mark only ("E11.9" to "E119")."""
    return F.regexp_replace(as_col(c), r"^([^\p{P}]*)\p{P}", "$1")


def strip_quotes(c: Column | str) -> Column:
    """Remove every single quote; a blank that was quoted becomes NULL."""
    return F.nullif(F.trim(F.regexp_replace(as_col(c), "'", "")), F.lit(""))


def code_prefix(c: Column | str, length: int = 3) -> Column:
    return F.substring(as_col(c), 1, length)


def possessive(name: Column | str) -> Column:
    name = as_col(name)
    return F.when(name.endswith("s"), F.concat(name, F.lit("'"))).otherwise(F.concat(name, F.lit("'s")))


def pronouns(gender: Column | str) -> tuple[Column, Column]:
    """(object pronoun, possessive pronoun) for "Male" and any other known gender."""
    male = as_col(gender) == "Male"
    known = as_col(gender).isNotNull()
    return (
        F.when(male, "him").when(known, "her"),
        F.when(male, "his").when(known, "her"),
    )


def wrap(c: Column | str, width: int) -> Column:
    """Greedy line breaks: no line over `width` unless one word alone is longer."""
    broken = F.regexp_replace(as_col(c), rf"(.{{1,{width}}})(?:\s+|$)", "$1\n")
    return F.regexp_replace(broken, r"\n$", "")


def dollars(c: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(as_col(c), 2))


def whole_text(c: Column | str) -> Column:
    """A number as text, without ".0" when it is whole."""
    c = as_col(c)
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def counted(n: Column | str, none, one, many) -> Column:
    """One of three texts by count; `{n}` parts are built by the caller."""
    n = as_col(n)
    return F.when(n == 0, as_value(none)).when(n == 1, as_value(one)).otherwise(as_value(many))
