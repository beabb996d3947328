"""Densities against direct kernel sums, and balance figures with missing, constant and one-sided covariates."""

import math
import random

import pytest

from strataloom.operators.balance import ecdf_balances, numeric_balances
from strataloom.operators.density import densities, grids


def test_density_agrees_with_direct_sums(spark):
    r = random.Random(7)
    rows = [(i % 2, r.random() + 0.1, r.gauss(i % 2, 1), r.choice([0.0, 1.0, 4.0]) if i % 5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "side int, w double, a double, b double").repartition(3)
    got = densities({"all": (df, None), "weighed": (df, "w")}, ["a", "b"], "side").collect()
    width = {g["covariate"]: g["width"] for g in grids(df, ["a", "b"]).collect()}
    assert len(got) == 2 * 2 * 2 * 128
    for p in got:
        h, k = width[p["covariate"]], "ab".index(p["covariate"]) + 2
        used = [(row[1] if p["stage"] == "weighed" else 1.0, row[k]) for row in rows if row[0] == p["treated"] and row[k] is not None]
        want = sum(w * math.exp(-0.5 * ((p["x"] - x) / h) ** 2) for w, x in used) / (sum(w for w, _ in used) * h * math.sqrt(2 * math.pi))
        assert p["density"] == pytest.approx(want, abs=0.004 / h)
    for stage, c, side in {(p["stage"], p["covariate"], p["treated"]) for p in got}:
        own = sorted((p["x"], p["density"]) for p in got if (p["stage"], p["covariate"], p["treated"]) == (stage, c, side))
        assert sum(d for _, d in own) * (own[1][0] - own[0][0]) == pytest.approx(1, abs=0.01)


def test_density_of_constants_and_nothing(spark):
    df = spark.createDataFrame([(1, 2.0, None), (0, 2.0, None), (0, 2.0, None)], "side int, a double, b double")
    got = densities({"all": (df, None)}, ["a", "b"], "side").collect()
    assert {(p["covariate"], p["treated"]) for p in got} == {("a", 0), ("a", 1)} and len(got) == 256
    assert max(p["density"] for p in got) == pytest.approx(1 / math.sqrt(2 * math.pi), rel=0.01)
    wide = spark.createDataFrame([(1, 200.0)], "side int, a double")
    with pytest.raises(Exception, match="beyond the grid"):
        densities({"all": (df, None), "other": (wide, None)}, ["a"], "side").collect()


def test_numeric_balance_with_missing_constant_and_one_sided_values(spark):
    rows = [(1, 1.0, 10.0, 5.0, 1.0, None), (1, 1.0, 12.0, 5.0, 2.0, None), (0, 1.0, 10.0, 3.0, None, 4.0),
            (0, 1.0, 12.0, 4.0, None, 4.0), (0, 3.0, None, 5.0, None, 4.0)]
    df = spark.createDataFrame(rows, "side int, w double, missing double, flat double, treated_only double, control_only double")
    values = ["missing", "flat", "treated_only", "control_only"]
    got = {r["covariate"]: r for r in numeric_balances(df, values, "side", "w").collect()}
    assert list(got) == values
    a = got["missing"]
    assert (a.treated_mean, a.control_mean, a.std_diff, a.variance_ratio) == (11.0, 11.0, 0.0, 1.0)
    assert got["flat"].treated_mean == 5.0 and got["flat"].std_diff is None and got["flat"].variance_ratio == 0.0
    assert got["treated_only"].control_mean is None and got["treated_only"].std_diff is None
    assert got["control_only"].treated_mean is None and got["control_only"].variance_ratio is None
    far = {r["covariate"]: r for r in ecdf_balances(df, values, "side", "w").collect()}
    assert far["missing"].ecdf_max == 0.0 and far["flat"].ecdf_max == pytest.approx(0.4) and far["treated_only"].ecdf_max is None
    assert numeric_balances(df.limit(0), values, "side").count() == 4 and ecdf_balances(df.limit(0), values, "side").count() == 0
