"""Nearest matching against a plain greedy over all pairs."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from strataloom.functions.draws import draw32
from strataloom.operators.nearest import closest_first, nearest_match


def greedy(rows, ratio):
    """Rows (unit, stratum, treated, score, draw); returns {control: treated}."""
    out = {}
    for stratum in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == stratum]
        place = {}
        for r in sorted(mine, key=lambda r: (r[4], r[0])):
            same = (r[2], r[3])
            place[r[0]] = sum(1 for u in place if place[u][0] == same), same
            place[r[0]] = (same, place[r[0]][0])
        free = {r[0]: r for r in mine if not r[2]}
        for _ in range(ratio):
            waiting = {r[0]: r for r in mine if r[2]}
            pairs = sorted((abs(t[3] - c[3]), t[3], c[3], place[t[0]][1], place[c[0]][1], t[0], c[0])
                           for t in waiting.values() for c in free.values())
            for *_, t, c in pairs:
                if t in waiting and c in free:
                    out[c] = t
                    del waiting[t], free[c]
    return out


def table(spark, seed, n, levels, scores, share):
    r = random.Random(seed)
    rows = [(f"u{i}", r.choice(levels), int(r.random() < share), scores(r)) for i in range(n)]
    df = spark.createDataFrame(rows, "unit string, stratum string, treated int, score double").repartition(4)
    draws = {x["unit"]: x["d"] for x in df.select("unit", draw32(3, "unit").alias("d")).collect()}
    return df, [(*x, draws[x[0]]) for x in rows]


CASES = {
    "continuous": dict(n=160, levels="aab", scores=lambda r: round(r.random(), 4), share=0.3),
    "equal scores": dict(n=160, levels="ab", scores=lambda r: r.randint(0, 6) / 4, share=0.3),
    "few controls": dict(n=120, levels="aaab", scores=lambda r: round(r.gauss(0, 1), 2), share=0.7),
    "chain": dict(n=90, levels="a", scores=lambda r: 1.0 / (1 + r.randint(0, 400)), share=0.5),
}


def in_ranges(x, t, c, cuts):
    """One turn over ranges between the cuts, with other cuts in each round."""
    flows, r = [], random.Random(1)
    while any(t) and any(c):
        edges, free = [0, *sorted(cuts), len(x)], (list(t), list(c))  # all ranges see the state before the round
        for a, b in zip(edges[:-1], edges[1:]):
            if a < b:
                tt, cc = t[a:b], c[a:b]
                beyond = (*(max((x[k] for k in range(a) if side[k]), default=None) for side in free),
                          *(min((x[k] for k in range(b, len(x)) if side[k]), default=None) for side in free))
                flows += [(i + a, j + a, m) for i, j, m in closest_first(x[a:b], tt, cc, beyond)]
                t[a:b], c[a:b] = tt, cc
        cuts = r.sample(range(len(x)), len(cuts) * 2 // 3)
    return flows


@pytest.mark.parametrize("seed", range(60))
def test_ranges_do_not_change_the_match(seed):
    r = random.Random(seed)
    x = sorted({round(r.random() ** r.choice([1, 4]), r.choice([2, 6])) for _ in range(r.randint(1, 60))})
    t, c = [r.choice([0, 0, 1, 3]) for _ in x], [r.choice([0, 1, 1, 2]) for _ in x]
    whole = closest_first(x, list(t), list(c))
    cut = in_ranges(x, list(t), list(c), r.sample(range(len(x)), min(len(x), r.randint(0, 9))))

    def total(flows):
        out = {}
        for a, b, m in flows:
            out[a, b] = out.get((a, b), 0) + m
        return out

    assert total(whole) == total(cut)


@pytest.mark.parametrize("case, ranges", [("continuous", 4), ("equal scores", None), ("few controls", None), ("chain", 3)])
def test_equals_greedy_over_all_pairs(spark, case, ranges):
    df, rows = table(spark, 5, **CASES[case])
    ratio = 2
    found = nearest_match(df, ["stratum"], "treated", "unit", "score", ratio, 3, ranges=ranges).collect()
    partner = {r["subclass"]: r["unit"] for r in found if r["treated"]}
    assert {r["unit"]: partner[r["subclass"]] for r in found if not r["treated"]} == greedy(rows, ratio)
    score = {r[0]: r[3] for r in rows}
    for r in found:
        assert r["distance"] == score[r["unit"]] and r["gap"] == abs(score[r["unit"]] - score[partner[r["subclass"]]])
    controls = [r for r in found if not r["treated"]]
    assert sum(r["weights"] for r in controls) == pytest.approx(len(controls))
    assert len(partner) == sum(r["treated"] for r in found)


def test_a_range_leaves_pairs_that_others_may_take():
    t, c = [0, 1, 0, 1], [1, 0, 1, 0]
    scores = [0.0, 1.0, 1.4, 5.0]
    assert closest_first(scores, list(t), list(c), (None, 0.8, None, None)) == []  # the treated row at 1.0 may have a nearer control at 0.8
    assert closest_first(scores, list(t), list(c), (None, -9.0, None, None)) == [(1, 2, 1), (3, 0, 1)]
    assert closest_first(scores, list(t), list(c), (None, None, None, 5.1)) == [(1, 2, 1)]


def test_missing_keys_and_scores(spark):
    df = spark.createDataFrame([("a", "s", 1, 1.0), ("b", "s", 0, None)], "unit string, stratum string, treated int, score double")
    with pytest.raises(Exception, match="missing key"):
        nearest_match(df, ["stratum"], "treated", "unit", "score").collect()
    with pytest.raises(Exception, match="no number"):
        nearest_match(df.withColumn("score", F.lit(float("nan"))), ["stratum"], "treated", "unit", "score").collect()
    assert nearest_match(df.where("treated = 1"), ["stratum"], "treated", "unit", "score").count() == 0
    assert nearest_match(df.limit(0), ["stratum"], "treated", "unit", "score").count() == 0


def test_no_table_of_pairs(spark):
    df, _ = table(spark, 6, **CASES["continuous"])
    plan = plan_of(nearest_match(df, ["stratum"], "treated", "unit", "score", 2))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "SinglePartition" not in plan
