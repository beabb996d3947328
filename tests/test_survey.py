import math

import pytest
from pyspark.sql import functions as F

from strataloom.operators.survey import SurveyDesign, survey_mean

DESIGN = SurveyDesign("h", "i", "w")
ROWS = [  # stratum, cluster, weight, value, in domain, group
    (1, 1, 2.0, 3.0, True, "a"), (1, 1, 1.0, 4.0, True, "b"), (1, 2, 1.5, 8.0, True, "a"),
    (1, 3, 2.0, 7.0, False, "a"), (2, 1, 1.0, 2.0, True, "b"), (2, 1, 0.0, 99.0, True, "a"),
    (2, 2, 3.0, 6.0, True, "a"), (2, 2, 1.0, 5.0, False, "b"), (3, 1, 1.0, 1.0, False, "b"),
    (3, 2, 2.0, 9.0, True, "b"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "h int, i int, w double, y double, d boolean, g string")


def by_hand(keep):
    """The estimator written out over the full grid of clusters."""
    inside = [r for r in ROWS if keep(r)]
    total = sum(r[2] for r in inside)
    mean = sum(r[2] * r[3] for r in inside) / total
    clusters = sorted({(r[0], r[1]) for r in ROWS})
    z = {c: sum(r[2] * (r[3] - mean) / total for r in inside if (r[0], r[1]) == c) for c in clusters}
    var = 0.0
    for h in {c[0] for c in clusters}:
        zs = [v for c, v in z.items() if c[0] == h]
        var += len(zs) / (len(zs) - 1) * sum((v - sum(zs) / len(zs)) ** 2 for v in zs)
    return mean, math.sqrt(var)


def test_domain_mean(rows):
    got = survey_mean(rows, {"m": "y"}, DESIGN, domain=F.col("d")).first()
    mean, se = by_hand(lambda r: r[4])
    assert (got.m, got.m_se) == pytest.approx((mean, se), rel=1e-12)
    # Six clusters with a positive domain weight in three strata ((1,3) and (3,1) have none): df = 5 - 3.
    assert got.m_upp - got.m == pytest.approx(4.302652729749464 * se, rel=1e-9)


def test_means_by_cut_keep_empty_clusters(rows):
    got = {r.g: r for r in survey_mean(rows, {"m": "y"}, DESIGN, ["g"], F.col("d"), df_t="inf", rse=True).collect()}
    for g in "ab":
        mean, se = by_hand(lambda r: r[4] and r[5] == g)
        assert (got[g].m, got[g].m_se) == pytest.approx((mean, se), rel=1e-12)
        assert got[g].m_low == pytest.approx(mean - 1.959963984540054 * se)
        assert got[g].m_rse == pytest.approx(se / mean)


def test_two_measures_and_missing_values(spark):
    data = [r if k else (*r[:3], None, *r[4:]) for k, r in enumerate(ROWS)]
    df = spark.createDataFrame(data, "h int, i int, w double, y double, d boolean, g string").withColumn(
        "one", F.lit(1.0))
    got = {r.g: r for r in survey_mean(df, {"m": "y", "u": "one"}, DESIGN, ["g"], F.col("d"), df_t=4).collect()}
    assert got["a"].m is None and got["a"].m_low is None and got["b"].m is not None
    assert got["a"].u == 1.0 and got["a"].u_se == pytest.approx(0.0, abs=1e-12)


def test_lonely_cluster(spark, rows):
    lonely = rows.union(spark.createDataFrame([(9, 1, 1.0, 4.0, True, "a")], rows.schema))
    with pytest.raises(Exception, match="one cluster"):
        survey_mean(lonely, {"m": "y"}, DESIGN).collect()
    removed = survey_mean(lonely, {"m": "y"}, DESIGN, lonely_psu="remove", df_t="inf").first()
    adjusted = survey_mean(lonely, {"m": "y"}, DESIGN, lonely_psu="adjust", df_t="inf").first()
    total = sum(r[2] for r in ROWS) + 1
    z = 1.0 * (4.0 - removed.m) / total
    assert adjusted.m_se**2 == pytest.approx(removed.m_se**2 + z * z)
    with pytest.raises(ValueError):
        survey_mean(rows, {"m": "y"}, DESIGN, lonely_psu="guess")


def test_missing_design_is_refused(spark, rows):
    bad = rows.union(spark.createDataFrame([(None, 1, 1.0, 4.0, True, "a")], rows.schema))
    with pytest.raises(Exception, match="missing key"):
        survey_mean(bad, {"m": "y"}, DESIGN).collect()


def test_textbook_simple_random_sample(spark):
    """One stratum, one row per cluster, equal weights: the ordinary standard error of a mean."""
    values = [float(v) for v in (12, 15, 9, 22, 18, 11, 14, 16, 20, 13)]
    df = spark.createDataFrame([(1, k, 3.0, v) for k, v in enumerate(values)], "h int, i int, w double, y double")
    got = survey_mean(df, {"m": "y"}, DESIGN).first()
    n, mean = len(values), sum(values) / len(values)
    se = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1) / n)
    assert (got.m, got.m_se) == pytest.approx((mean, se))
    assert got.m_low == pytest.approx(mean - 2.2621571628540993 * se, rel=1e-9)
