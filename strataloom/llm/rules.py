"""Quality rules: a table of thresholds compiled into one projection, without user functions.

The statistics are built from whole texts. Defined results: a null or empty text has no words and
fails the base rule; a null id is kept as it is; rows with the same id are judged each on its own;
an empty table gives an empty table; columns of the input other than the two named are not read,
so extra columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import GAPS, let, without, words

SYMBOLS = "#*$%&|<>"

# Frequent short words of the four languages, in lower case.
STOP_WORDS = (
    "the of and to in that it is was for on are as with they be at this have from or by "
    "der die und das von den mit ist im sich nicht ein eine als zu auf für "
    "le la les de des et un une du en est que pour dans qui par sur au avec "
    "el los las y del por con su para se una al lo como no"
).split()


@dataclass(frozen=True)
class Rule:
    """Passes when `low <= measure <= high`; a missing measure (no words, no lines) passes."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        value, bad = F.expr(self.measure), F.lit(False)
        if self.low is not None:
            bad = bad | F.coalesce(value < F.lit(self.low), F.lit(False))
        if self.high is not None:
            bad = bad | F.coalesce(value > F.lit(self.high), F.lit(False))
        return bad


BASE = (
    Rule("few_words", "n_words", low=50),
    Rule("repeated_windows", "100 * n_repeat_words - 50 * n_words", high=0),
)
RULES = (
    Rule("word_length", "word_chars / nullif(n_words, 0)", low=2.0, high=15.0),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", high=0.1),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", low=0.03),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", high=0.5),
)


def repeated_window_words(word_list: Column, width: int = 3) -> Column:
    """Words that lie in a window of `width` words found twice or more in the list.

    Windows are compared by a chained 64-bit hash, sorted with their places; equal neighbours are
    repeats, and the words they cover are counted once.
    """
    keys = F.transform(
        F.sequence(F.lit(0), F.size(word_list) - width),
        lambda i: F.struct(F.xxhash64(*[word_list[i + k] for k in range(width)]).alias("k"), i.alias("i")),
    )

    def covered(order: Column) -> Column:
        def place(x: Column, j: Column) -> Column:
            before = F.get(order, j - 1)["k"]
            after = F.get(order, j + 1)["k"]
            return F.when((before == x["k"]) | (after == x["k"]), x["i"])

        starts = F.filter(F.transform(order, place), lambda p: p.isNotNull())
        spread = F.flatten(F.transform(starts, lambda p: F.array(*[p + k for k in range(width)])))
        return F.size(F.array_distinct(spread))

    return F.when(F.size(word_list) >= width, let(F.sort_array(keys), covered)).otherwise(0)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and counts of each text: words, their code points, symbols, lines, repeated lines, repeated windows."""
    text = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    split = text.withColumns({
        "__words": words(F.col("__text")),
        "__lines": F.filter(F.split("__text", "\n"), lambda x: F.length(without(x, GAPS)) > 0),
    })
    return split.select(
        id_col,
        F.size("__words").cast("long").alias("n_words"),
        F.length(without(F.col("__text"), GAPS)).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(without(F.col("__text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        let(F.col("__words"), repeated_window_words).cast("long").alias("n_repeat_words"),
        F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


def any_fails(rules) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | rule.fails()
    return out


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, rules=RULES) -> DataFrame:
    """Statistics of each document, `base_failed`, and `kept`: no base rule and no other rule fails."""
    stats = text_statistics(docs, id_col, text_col)
    return stats.select("*", any_fails(base).alias("base_failed"), (~any_fails([*base, *rules])).alias("kept"))
