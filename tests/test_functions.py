import datetime as dt
import hashlib
import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from strataloom.functions import dates, draws, nulls, quantiles, recode, text


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_draw_follows_its_definition(spark):
    def expected(*keys):
        joined = "|".join(["9", *["\\N" if k is None else str(k) for k in keys]])
        return int(hashlib.md5(joined.encode()).hexdigest()[:8], 16)

    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    got = rows.select("k", "s", draws.draw32(9, "k", "s").alias("u")).collect()
    assert [r.u for r in got] == [expected(r.k, r.s) for r in got]
    assert draws.draw32(9, "k") is not None


def test_draw_does_not_depend_on_partitions(spark):
    rows = spark.range(500).select("id", draws.draw32(1, "id").alias("u"))
    again = spark.range(500).repartition(13).select("id", draws.draw32(1, "id").alias("u"))
    assert rows.exceptAll(again).count() == 0


def test_missing_condition_stays_missing(spark):
    rows = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    got = rows.select(nulls.if_known(F.col("x") > 2, "big", "small").alias("c")).collect()
    assert [r.c for r in got] == ["small", "big", None]


def test_strict_sum_and_distinct_count(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", None), ("c", None)], "g string, x int")
    got = {r.g: (r.s, r.d) for r in rows.groupBy("g").agg(
        nulls.strict_sum("x").alias("s"), nulls.distinct_count("x").alias("d")).collect()}
    assert got == {"a": (2, 1), "b": (None, 2), "c": (None, 1)}


def test_sentinels(spark):
    rows = spark.createDataFrame([("-15", "-1"), ("E11", "-1"), (None, "x"), ("I10", None)], "code string, c string")
    got = nulls.sentinel_to_null(nulls.drop_sentinel(rows, ["code"], "-15"), ["c"], "-1").collect()
    assert [tuple(r) for r in got] == [("E11", None), ("I10", None)]


@pytest.mark.parametrize("raw, titled", [
    ("NON-HISPANIC WHITE ONLY", "Non-Hispanic White Only"),
    ("NON-HISPANIC OTHER RACE OR MULTIPLE RACE", "Non-Hispanic Other Race Or Multiple Race"),
    ("blue cross-shield", "Blue Cross-Shield"), (None, None),
])
def test_title_case(spark, raw, titled):
    assert one(spark, text.title_case(F.lit(raw).cast("string"))).c0 == titled


def test_labels_of_the_two_jobs_agree(spark):
    from strataloom.sources import lookups as L

    codes = [L.RACE_CODES.get(k, L.OTHER_RACE) for k in (1, 2, 3, 4, 5)]
    rows = spark.createDataFrame([(c,) for c in codes], "c string").select(text.title_case("c").alias("t"))
    assert [r.t for r in rows.collect()] == [L.RACE_LABELS[k] for k in (1, 2, 3, 4, 5)]


def test_text(spark):
    r = one(
        spark, text.squish(F.lit("  a \n\n b\tc ")), text.drop_first_punctuation(F.lit("E11.9-x")),
        text.strip_quotes(F.lit("' '")), text.strip_quotes(F.lit("'A01'")), text.possessive(F.lit("Chris")),
        text.possessive(F.lit("Ada")), text.dollars(F.lit(1234.5)), text.whole_text(F.lit(17.0)),
        text.whole_text(F.lit(17.5)), text.drop_first_punctuation(F.lit("E119")),
    )
    assert list(r) == ["a b c", "E119-x", None, "A01", "Chris'", "Ada's", "$1,234.50", "17", "17.5", "E119"]


def test_wrap(spark):
    words = "the quick brown fox jumps over the lazy dog and then some more words follow"
    wrapped = one(spark, text.wrap(F.lit(words), 20)).c0
    assert all(len(line) <= 20 for line in wrapped.split("\n"))
    assert wrapped.replace("\n", " ") == words


def test_pronouns_and_counts(spark):
    him, his = text.pronouns(F.lit("Male"))
    her, hers = text.pronouns(F.lit("Female"))
    assert list(one(spark, him, his, her, hers)) == ["him", "his", "her", "her"]
    n = spark.range(3).select(text.counted("id", "none", "one", F.concat(F.lit("n="), F.col("id"))).alias("c"))
    assert [r.c for r in n.collect()] == ["none", "one", "n=2"]


@pytest.mark.parametrize("age, half_open, closed", [
    (4.9, "Under 5", "Under 5"), (5.0, "5 - 17", "5 - 17"), (17.0, "5 - 17", "5 - 17"), (17.5, "5 - 17", "17.5"),
    (17.99, "5 - 17", "17.99"), (18.0, "18 - 29", "18 - 29"), (65.0, "60 - 69", "60 - 69"),
    (79.999, "70 - 79", "79.999"), (85.0, "80 and over", "80 and over"), (None, None, None),
])
def test_bands(spark, age, half_open, closed):
    r = one(spark, recode.band(F.lit(age).cast("double")), recode.whole_band(F.lit(age).cast("double")))
    assert (r.c0, r.c1) == (half_open, closed)


def test_recode_and_rules(spark):
    rows = spark.createDataFrame([(1,), (4,), (9,), (None,)], "x int")
    got = rows.select(recode.recode("x", {1: "a", 4: "d"}, "S").alias("r"),
                      recode.first_rule((F.col("x") > 3, "big"), (F.col("x") > 0, "pos"), default="none").alias("f"),
                      recode.top_code("x", 5).alias("t")).collect()
    assert [tuple(r) for r in got] == [("a", "pos", 1), ("d", "big", 4), ("S", "big", 5), ("S", "none", None)]


def test_years_and_spans(spark):
    day = F.lit(dt.date(1951, 12, 31))
    r = one(spark, dates.years_between(day, F.lit(dt.date(2021, 12, 31))),
            dates.span_words(F.lit(2021), F.lit(2021)), dates.span_words(F.lit(2021), F.lit(2018)),
            dates.span_words(F.lit(2021), F.lit(-8)), dates.span_words(F.lit(2021), F.lit(None).cast("int")))
    assert r.c0 == 25568 / 365.25
    assert list(r)[1:] == ["Less than a year", "3 to 4 years", "Unknown", "Unknown"]


def test_drawn_days_are_valid_days(spark):
    rows = spark.range(3000).select(dates.drawn_day(F.lit(2021), F.lit(2), 4, "id").alias("d"))
    days = {r.d.day for r in rows.collect()}
    assert days == set(range(1, 29))


def test_covers_is_closed(spark):
    day = dt.date(2021, 12, 31)
    r = one(spark, dates.covers(F.lit(day), F.lit(day), day),
            dates.covers(F.lit(dt.date(2022, 1, 1)), F.lit(dt.date(2022, 2, 1)), day))
    assert list(r) == [True, False]


def test_normal_quantile(spark):
    p = [1e-12, 1e-6, 0.001, 0.025, 0.1, 0.5, 0.7, 0.975, 0.9999]
    rows = spark.createDataFrame([(x,) for x in [*p, 0.0, 1.0]], "p double")
    got = [r.q for r in rows.select(quantiles.normal_quantile("p").alias("q")).collect()]
    assert got[:-2] == pytest.approx([NormalDist().inv_cdf(x) for x in p], rel=1e-12, abs=1e-14)
    assert got[-2:] == [None, None]


def test_t_quantiles(spark):
    known = {1.0: 12.706204736174694, 2.0: 4.302652729749464, 5.0: 2.5705818356363146, 10.0: 2.2281388519862744,
             30.0: 2.0422724563012378, 120.0: 1.9799304050824413}
    other = [1.01, 1.5, 2.7, 17.25, 64.5, 199.0, 199.5, 200.0, 200.5, 201.0, 1234.5, 1e6]
    rows = spark.createDataFrame([(k,) for k in [*known, *other, 0.0, 0.9, None, 1e9]], "df double")
    for level in (0.5, 0.95, 0.99):
        got = {r.df: r.t for r in rows.select("df", quantiles.t_multiplier(F.col("df"), level).alias("t")).collect()}
        for k in [*known, *other]:
            # The formula on the driver is another one: a continued fraction of the incomplete beta function.
            assert got[k] == pytest.approx(quantiles.t_quantile(level, k), rel=1e-12 if k < 1e4 else 1e-9), (level, k)
        assert got[0.0] is None and got[0.9] is None and got[None] is None
        assert got[1e9] == pytest.approx(NormalDist().inv_cdf((1 + level) / 2), rel=1e-8)
    got = {r.df: r.t for r in rows.select("df", quantiles.t_multiplier(F.col("df")).alias("t")).collect()}
    for k, v in known.items():
        assert got[k] == pytest.approx(v, rel=1e-12)


def test_plotting_position(spark):
    rows = spark.createDataFrame([(1, 10), (1, 11)], "r int, n int")
    got = [r.p for r in rows.select(quantiles.plotting_position(F.col("r"), F.col("n")).alias("p")).collect()]
    assert got == pytest.approx([0.625 / 10.25, 0.5 / 11])
    assert not math.isnan(got[0])
