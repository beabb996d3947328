"""k:1 nearest matching without replacement, inside exact strata, on a score that is finer than the strata.

The rule is greedy by distance: of all free pairs in a stratum the closest one is matched, then the
closest of the rest, until one side is used up; ties go to the lower treated score, then to the
lower control score, then to the keyed draw. Every treated row gets a first control before any gets
a second: each further control is a turn of the same rule among the controls that are left.

On a line of scores the closest free pair always consists of neighbours, so no table of pairs is
needed. Rows with equal scores fold to one node with counts, and nodes are cut into ranges of
(stratum, score). A range works through its neighbour pairs with a heap. Where the stratum goes on
beyond the range, it matches a pair only if both rows are nearer to each other than to the nearest free rows
of the other side there; what is undecided waits. The rows that are left, free controls among them, go on in new
ranges with other borders, until no stratum has rows of both sides. Strata that lie in one range
are finished at once, so the ranges decide only how many rounds there are, not what is matched.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import draw32
from ..session import materialize
from .joins import require_keys
from .matching import subclass_name
from .running import running_totals

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

_OUT = ("flow boolean, stratum string, score double, t_all long, t long, c long, c_used long, turn long, "
        "t_from long, c_score double, c_from long, m long")
_NAMES = [x.split()[0] for x in _OUT.split(", ")]
_KINDS = {"boolean": pa.bool_(), "string": pa.string(), "double": pa.float64(), "long": pa.int64()}


def closest_first(scores: list[float], t: list[int], c: list[int], beyond: tuple = (None,) * 4) -> list[tuple[int, int, int]]:
    """One turn on ascending nodes with `t` treated and `c` control rows, which are counted down.

    Returns (treated node, control node, rows). `beyond` has the scores of the nearest free treated and
    control rows below the range and above it, where the stratum goes on; pairs that these might
    break are left.
    """
    low_t, low_c, high_t, high_c = beyond
    flows = []
    for i in range(len(scores)):
        if t[i] and c[i]:
            m = min(t[i], c[i])
            flows.append((i, i, m))
            t[i] -= m
            c[i] -= m
    alive = [i for i in range(len(scores)) if t[i] or c[i]]
    after = dict(zip(alive, [*alive[1:], None]))
    before = dict(zip(alive, [None, *alive[:-1]]))
    heap, waiting = [], set()

    def meet(i, j):
        if i is not None and j is not None and (t[i] > 0) != (t[j] > 0):
            a, b = (i, j) if t[i] else (j, i)
            heapq.heappush(heap, (scores[j] - scores[i], scores[a], scores[b], i, j))

    for i in alive:
        meet(i, after[i])
    while heap:
        gap, _, _, i, j = heapq.heappop(heap)
        if not (t[i] or c[i]) or not (t[j] or c[j]):
            continue  # one of the two has been used up
        a, b = (i, j) if t[i] else (j, i)
        # At equal distance the lower score goes first.
        inside = ((low_c is None or scores[a] - low_c > gap) and (low_t is None or scores[b] - low_t > gap)
                  and (high_c is None or high_c - scores[a] >= gap) and (high_t is None or high_t - scores[b] >= gap))
        if not inside or i in waiting or j in waiting:
            waiting |= {i, j}
            continue
        m = min(t[a], c[b])
        flows.append((a, b, m))
        t[a] -= m
        c[b] -= m
        left, right = before[i], after[j]
        kept = [x for x in (i, j) if t[x] or c[x]]
        chain = [left, *kept, right]
        for x, y in zip(chain[:-1], chain[1:]):
            if x is not None:
                after[x] = y
            if y is not None:
                before[y] = x
            meet(x, y)
    return flows


def _work(rows: list[list], stratum: str, beyond: tuple | None, ratio: int) -> Iterator[tuple]:
    """Flows of a stratum in a range, and its nodes where it goes on in another range (`beyond` is given)."""
    scores, t_all, t, c, used, turns = map(list, rows)
    cut, turn = beyond is not None, turns[0]
    while True:
        given = [n - left for n, left in zip(t_all, t)]  # treated rows of each node that have been served in this turn
        for a, b, m in closest_first(scores, t, c, beyond or (None,) * 4):
            yield True, stratum, scores[a], 0, 0, 0, 0, turn, given[a], scores[b], used[b], m
            given[a] += m
            used[b] += m
        if cut:
            for node in zip(scores, t_all, t, c, used):
                yield False, stratum, *node, turn, 0, 0.0, 0, 0
        if cut or turn == ratio or not any(c):
            return
        turn, t = turn + 1, list(t_all)


def _matched_ranges(nodes: DataFrame, borders: dict[tuple, tuple], ratio: int) -> DataFrame:
    """`_work` for all strata of all ranges; nodes come sorted by range, stratum and score."""
    shared = nodes.sparkSession.sparkContext.broadcast(borders)  # two entries per range, at most
    schema = pa.schema([(x.split()[0], _KINDS[x.split()[1]]) for x in _OUT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []

        def finish():
            out.extend(_work(list(zip(*rows)), now[1], shared.value.get(now), ratio))

        def flushed():
            batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for part, stratum, *node in zip(*(x.to_pylist() for x in batch.columns)):
                if (part, stratum) != now:
                    if rows:
                        finish()
                    now, rows = (part, stratum), []
                rows.append(node)
            if out:
                yield flushed()
        if rows:
            finish()
        if out:
            yield flushed()

    return nodes.select("__part", "stratum", "score", "t_all", "t", "c", "c_used", "turn").mapInArrow(run, _OUT)


def _borders(ranged: DataFrame) -> tuple[int, dict[tuple, tuple]]:
    """Number of ranges, and per (range, stratum that goes on in another range) the nearest free scores beyond the range."""
    ends = ranged.groupBy("__part").agg(F.min("stratum").alias("a"), F.max("stratum").alias("b")).collect()
    parts_of: dict[str, set[int]] = {}
    for part, a, b in ends:
        for stratum in {a, b}:
            parts_of.setdefault(stratum, set()).add(part)
    cut = [(part, stratum) for stratum, parts in parts_of.items() if len(parts) > 1 for part in parts]
    if not cut:
        return len(ends), {}
    edges = F.broadcast(ranged.sparkSession.createDataFrame(cut, "__part int, stratum string"))  # two rows per range, at most
    free = {side: F.when(F.col(side) > 0, F.col("score")) for side in "tc"}
    found = ranged.join(edges, ["__part", "stratum"]).groupBy("stratum", "__part").agg(
        *[f(free[side]).alias(f"{side}_{name}") for side in "tc" for name, f in (("first", F.min), ("last", F.max))])
    rows: dict[str, list] = {}
    for r in found.collect():
        rows.setdefault(r["stratum"], []).append(r)
    out = {}
    for stratum, own in rows.items():
        own.sort(key=lambda r: r["__part"])
        for k, r in enumerate(own):
            def known(some, name):
                return [x[name] for x in some if x[name] is not None]

            out[r["__part"], stratum] = (*(max(known(own[:k], f"{side}_last"), default=None) for side in "tc"),
                                         *(min(known(own[k + 1:], f"{side}_first"), default=None) for side in "tc"))
    return len(ends), out


def _flows(nodes: DataFrame, ratio: int, ranges: int | None) -> DataFrame:
    """All matches as (stratum, turn, treated score and first rank, control score and first rank, rows)."""
    state = nodes.select("stratum", "score", F.col("t").alias("t_all"), "t", "c", F.lit(0).cast("long").alias("c_used"),
                         F.lit(1).cast("long").alias("turn"))
    by, found, first, tried = ["stratum", "score"], None, ranges, 0
    while True:
        ranged = state.repartitionByRange(ranges, *by) if ranges else state.repartitionByRange(*by)
        ranged = materialize(ranged.withColumn("__part", F.spark_partition_id()))
        count, borders = _borders(ranged)
        some = materialize(_matched_ranges(
            ranged.repartition("__part").sortWithinPartitions("__part", *by), borders, ratio))
        flows = some.where("flow").select("stratum", "turn", F.col("score").alias("t_score"), "t_from", "c_score", "c_from", "m")
        found = flows if found is None else found.unionByName(flows)
        left = some.where("NOT flow").select("stratum", *state.columns[1:])
        # A stratum that goes on spans ranges, so there is less than one per range.
        sums = left.groupBy("stratum").agg(F.sum("t").alias("__t"), F.sum("c").alias("__c"), F.max("turn").alias("__turn"))
        going = materialize(sums.where((F.col("__c") > 0) & ((F.col("__t") > 0) | (F.col("__turn") < ratio))))
        served = going.agg(F.min("__t")).first()[0]
        if served is None:
            return found
        again = F.col("__t") == 0
        state = left.join(F.broadcast(going), "stratum").withColumns({
            "t": F.when(again, F.col("t_all")).otherwise(F.col("t")), "turn": F.col("turn") + again.cast("long"),
        }).where("t_all > 0 OR c > 0").select(*state.columns)
        # Other borders in each round: two or three rounds settle what lies near the borders of the first. Fewer
        # ranges after some rounds of a turn, so that a chain of ever closer rows over many ranges ends, too.
        first = first or count
        tried = 0 if served == 0 else tried + 1
        ranges = first + 1 + tried if tried < 4 else max(1, (first + 1) >> (tried - 3))


def nearest_match(df: DataFrame, strata: Sequence[str], treated: str, unit: str, score: str, ratio: int = 1,
                  seed: int | str = 0, ranges: int | None = None) -> DataFrame:
    """Keep matched rows and add `distance` (the score), `subclass`, `weights` and `gap`.

    `treated` is a 0/1 column. `gap` is the difference of the scores of a control and its treated
    row. A treated row weighs 1; a control weighs one over the controls of its subclass, scaled so
    that control weights add up to the number of matched controls. A missing stratum key and a
    missing score are errors. `ranges` is the number of ranges of the first round; Spark's own
    number of shuffle partitions by default.
    """
    strata = list(strata)
    kept = [c for c in df.columns if c not in ("distance", "subclass", "weights", "gap") or c in (unit, treated, *strata)]
    rows = require_keys(df, [*strata, score], "nearest_match").withColumns({
        "__flag": F.col(treated).cast("long"), "__score": _known(F.col(score).cast("double")) + F.lit(0.0)})
    rows = rows.withColumn("__stratum", subclass_name(strata, F.lit("")))
    places = running_totals(rows.withColumn("__order", draw32(seed, unit)), ["__stratum", "__score", "__flag"], "__order", [unit],
                            {"__n": F.lit(1)})
    places = materialize(places.select(*kept, "__stratum", "__score", "__flag", F.col("__n_before").cast("long").alias("__rank")))
    nodes = places.groupBy(F.col("__stratum").alias("stratum"), F.col("__score").alias("score")).agg(
        F.sum("__flag").alias("t"), F.sum(F.lit(1).cast("long") - F.col("__flag")).alias("c"))
    flows = _flows(nodes, ratio, ranges)

    pairs = flows.repartition("stratum", "t_score", "t_from").select(
        "stratum", "turn", "t_score", "t_from", "c_score", "c_from",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("k"))
    pairs = materialize(pairs.select(
        "stratum", "turn", "t_score", (F.col("t_from") + F.col("k")).alias("t_rank"), "c_score",
        (F.col("c_from") + F.col("k")).alias("c_rank")))
    partner = ["stratum", "t_score", "t_rank"]
    served = pairs.groupBy(*partner).agg(F.count(F.lit(1)).alias("controls"))
    sides = served.withColumns({"flag": F.lit(1).cast("long"), "score": F.col("t_score"), "rank": F.col("t_rank")}).unionByName(
        pairs.join(served, partner).select(*partner, "controls", F.lit(0).cast("long").alias("flag"),
                                           F.col("c_score").alias("score"), F.col("c_rank").alias("rank")))
    sides = sides.withColumnsRenamed({c: f"__m_{c}" for c in sides.columns})
    controls, first = pairs.agg(F.count(F.lit(1)), F.count_if(F.col("turn") == 1)).first()
    scale = F.lit(controls / first if first else None).cast("double")
    joined = places.join(sides, reduce(and_, [F.col(f"__{c}") == F.col(f"__m_{c}") for c in ("stratum", "score", "flag", "rank")]))
    return joined.select(
        *kept, F.col("__score").alias("distance"),
        F.concat("__stratum", F.col("__m_t_score").cast("string"), F.lit("|"), F.col("__m_t_rank").cast("string")).alias("subclass"),
        F.when(F.col("__flag") == 1, F.lit(1.0)).otherwise(scale / F.col("__m_controls")).alias("weights"),
        F.abs(F.col("__score") - F.col("__m_t_score")).alias("gap"))


def _known(score: Column) -> Column:
    return F.when(F.isnan(score), F.raise_error(F.lit("nearest_match: a score is no number"))).otherwise(score)
