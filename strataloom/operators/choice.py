"""Weighted choice: one candidate per draw, with probability proportional to its weight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import SPAN, draw32
from ..functions.nulls import strict_sum
from ..session import materialize
from .hot import PART, PARTS, TARGET_ROWS, part_of
from .joins import null_safe_join
from .running import running_totals

WIDE = 8  # candidates of one category that one part of the draw range may hold
TASK_ROWS = 100_000  # candidates that one task folds, so that its memory does not grow with the table


def choice_intervals(candidates: DataFrame, category: Sequence[str], code: str, weight: str,
                     target_rows: int | None = TARGET_ROWS, count_to: str | None = None) -> DataFrame:
    """Give each candidate its half-open slice [draw_from, draw_to) of the draw range [0, 2**32).

    Slices are worked out once per category, not once per drawing row. Candidates stand in the
    order of a hash of their code. Weights are whole numbers; others are an error. A category with
    a missing weight, or with nothing but zeros, gets no slices at all. `count_to` names a column for
    the number of candidates of the category.
    """
    whole = F.col(weight).cast("long")
    broken = F.raise_error(F.lit("choice_intervals: a weight is not a whole number")).cast("long")
    checked = F.when(F.col(weight) != whole, broken).otherwise(F.coalesce(whole, F.lit(0)))
    placed = running_totals(
        candidates.withColumn("__place", draw32("order", code)),
        category, "__place", [code, weight],
        {"__w": checked,
         "__gap": F.when(F.col(weight).isNull(), 1).otherwise(0), "__one": F.lit(1)},
        target_rows,
    )

    def edge(count):
        # Exact ceiling of count * 2**32 / total: a draw u has u/2**32 >= count/total from there on.
        return F.expr(
            f"((CAST({count} AS DECIMAL(27,0)) * {SPAN}BD + CAST(__w_total AS DECIMAL(27,0)) - 1BD)"
            " div CAST(__w_total AS DECIMAL(27,0)))"
        )

    sliced = placed.where("__gap_total = 0 AND __w_total > 0").withColumns(
        {"draw_from": edge("__w_before"), "draw_to": edge("(__w_before + __w)")}
    )
    if count_to:
        sliced = sliced.withColumn(count_to, F.col("__one_total"))
    helpers = ["__place"] + [f"__{v}{s}" for v in ("w", "gap", "one") for s in ("", "_before", "_total")]
    return sliced.where("draw_from < draw_to").drop(*helpers)


def weighted_choice(rows: DataFrame, candidates: DataFrame, category: Sequence[str], code: str, weight: str,
                    row_key: Sequence[str], seed: int | str, keep_open: bool = False,
                    target_rows: int = TARGET_ROWS, cuts: int | None = None) -> DataFrame:
    """Attach to each row one candidate of its category, drawn in proportion to the weights.

    `row_key` names the row for its draw and must be unique. Category keys may be NULL and then
    match NULL. Rows without a usable category are dropped, or kept with NULLs by `keep_open`.

    Every category is cut along the draw range into `cuts` parts, the session's number of shuffle
    partitions by default, and one with many candidates into more. So the rows of a category of any size
    are spread over the tasks without being counted, and a row is compared with some of the
    candidates of its category, not with all. The intervals with their cuts are written first:
    Spark then knows their bytes, and broadcasts what its own limit allows.
    """
    category = list(category)
    cuts = cuts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    intervals = choice_intervals(candidates, category, code, weight, target_rows, "__codes")
    parts = F.greatest(F.lit(cuts).cast("long"), F.ceil(F.col("__codes") / F.lit(WIDE)))
    clash = [c for c in intervals.columns if c in set(rows.columns) and c not in category]
    cut = intervals.drop(*clash).withColumn(PARTS, parts).withColumn(
        PART, F.explode(F.sequence(part_of(F.col("draw_from"), F.col(PARTS)), part_of(F.col("draw_to") - 1, F.col(PARTS)))))
    spread = materialize(cut.drop("__codes"))

    wide = spread.where(F.col(PARTS) > cuts).select(*category, PARTS).distinct()
    drawn = null_safe_join(rows, wide, category, "left").withColumn("__draw", draw32(seed, *row_key))
    drawn = drawn.withColumn(PART, part_of(F.col("__draw"), F.coalesce(PARTS, F.lit(cuts).cast("long")))).drop(PARTS)
    inside = (F.col("__draw") >= F.col("draw_from")) & (F.col("__draw") < F.col("draw_to"))
    return null_safe_join(
        drawn, spread.drop(PARTS), [*category, PART], "left" if keep_open else "inner", inside
    ).drop("__draw", "draw_from", "draw_to", PART)


def fill_settings(candidates: DataFrame, setting: str, category: Sequence[str], code: Sequence[str],
                  weight: str, settings: Sequence[str], open_setting: str) -> DataFrame:
    """Candidate table in which every setting covers every category that any setting covers.

    A category that a setting lacks, or cannot use (missing or all-zero weights), is filled with
    the candidates of all settings taken together; `open_setting` is filled throughout. So a
    choice by (setting, category) does the setting's own round and the residual round in one
    join. Adds `round`: 1 for a setting's own candidates, 2 for filled ones.

    The candidates are written first and read by each of the three uses. Nearly every one is a group
    of its own when the settings are taken together, so they are dealt over as many tasks as their
    number needs before they are grouped, and no task collects groups of a whole input split.
    """
    base = materialize(candidates.select(setting, *category, *code, weight))
    tasks = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // TASK_ROWS))
    key = [setting, *category]
    usable = (
        base.groupBy(*key)
        .agg(strict_sum(weight).alias("__sum"))
        .where(F.col("__sum") > 0)
        .select(*key)
    )
    own = null_safe_join(base, usable, key, "left_semi").withColumn("round", F.lit(1))
    dealt = base.repartition(tasks, *category, *code)
    combined = dealt.groupBy(*category, *code).agg(strict_sum(weight).alias(weight))
    wanted = combined.withColumn(
        setting, F.explode(F.array(*[F.lit(s) for s in [*settings, open_setting]]))
    )
    filled = null_safe_join(wanted, usable, key, "left_anti").withColumn("round", F.lit(2))
    return own.unionByName(filled)
