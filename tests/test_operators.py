import collections
import itertools

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from strataloom.operators import (aggregates, balance, choice, codes, columns, hot, joins, matching, ranks, reshape,
                                  running, sampling)


# ---- columns -----------------------------------------------------------------------------------

def test_relocate_and_types(spark):
    df = spark.createDataFrame([(1, "x", 2.0, True)], "a int, b string, c double, d boolean")
    assert columns.relocate(df, "c").columns == ["c", "a", "b", "d"]
    assert columns.relocate(df, "a", after="c").columns == ["b", "c", "a", "d"]
    assert columns.relocate(df, "d", before="b").columns == ["a", "d", "b", "c"]
    assert columns.numeric_columns(df) == ["a", "c"]


def test_harmonize_year(spark):
    df = spark.createDataFrame([("1", 2, 3, 4, 5)], "DUPERSID string, MARRY21X int, DOBYY int, PERWT21F int, AGE21X int")
    got = columns.harmonize_year(df, 2021, ["DUPERSID", "MARRYYYX", "DOBYY", "PERWTYYF", "AGEYYX"])
    assert got.columns == ["DUPERSID", "MARRYYYX", "DOBYY", "PERWTYYF", "AGEYYX"]
    assert tuple(got.first()) == ("1", 2, 3, 4, 5)
    with pytest.raises(ValueError):
        columns.harmonize_year(df, 2020, ["PERWTYYF"])
    tagged = columns.tag_year(got, 2021, "DUPERSID", "ID", "YEAR").first()
    assert (tagged.ID, tagged.YEAR) == ("12021", 2021)


def test_any_column_and_confident(spark):
    df = spark.createDataFrame(
        [("a", 97.0, 1.0, "white", 90.0), ("b", 50.0, 96.0, "white", 90.0), ("c", 1.0, 99.0, "white", 84.9),
         ("d", 99.0, None, "other", 0.0), ("e", 99.0, 0.0, "white", None)],
        "id string, gender_m double, gender_w double, race string, race_white double")
    sure = columns.confident(columns.any_column(df, "gender_", lambda c: c > 96), "race", {"white": ("race_white", 85)})
    assert [r.id for r in sure.collect()] == ["a", "d", "e"]


def test_pool_is_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert {tuple(r) for r in columns.pool(a, b).collect()} == {(1, "x"), (2, "y")}
    filled = columns.pool(a, b.drop("s"), fill=True).collect()
    assert {tuple(r) for r in filled} == {(1, "x"), (2, None)}


def test_total_row(spark):
    df = spark.createDataFrame([("p", "a", 1, 2.0), ("p", "b", 3, None), ("q", "a", 5, 1.0)],
                               "id string, drug string, n int, cost double")
    got = {(r.id, r.drug): (r.n, r.cost) for r in columns.total_row(df, "drug", by=["id"]).collect()}
    assert got[("p", "Total")] == (4, None) and got[("q", "Total")] == (5, 1.0) and len(got) == 5
    assert columns.total_row(df.drop("id"), "drug").where("drug = 'Total'").first().n == 9


# ---- joins -------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def keyed(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, None)], "id int, k string, m string")
    right = spark.createDataFrame([("a", None, 10), ("a", "x", 20), (None, None, 30), ("b", "x", 40)],
                                  "k string, m string, v int")
    return left, right


def test_natural_join_matches_missing_keys(keyed):
    left, right = keyed
    assert {(r.id, r.v) for r in joins.natural_join(left, right).collect()} == {(1, 10), (2, 20), (3, 30)}
    assert joins.natural_join(left, right).columns == ["id", "k", "m", "v"]
    assert {r.v for r in joins.natural_join(right, left, "left_anti").collect()} == {40}
    assert {r.v for r in joins.not_in(right, left).collect()} == {40}
    with pytest.raises(ValueError):
        joins.natural_join(left.select("id"), right)


def test_null_safe_join_is_an_equi_join(spark, keyed):
    left, right = keyed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joins.natural_join(left, right))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_suffix_join(spark):
    a = spark.createDataFrame([(1, "x", 5)], "k int, name string, only_a int")
    b = spark.createDataFrame([(1, "y")], "key int, name string")
    got = joins.join_keyed(a, b, {"k": "key"})
    assert got.columns == ["k", "name_x", "only_a", "name_y"]
    assert tuple(got.first()) == (1, "x", 5, "y")


def test_require_keys_fails_on_missing(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    with pytest.raises(Exception, match="missing key"):
        joins.require_keys(df, ["a", "b"], "test").collect()


# ---- running totals and hot groups -------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """One group with a third of the rows, one with a tenth, many small ones, and a NULL group."""
    return spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").when(F.col("id") < 1300, "warm").when(F.col("id") < 1350, F.lit(None))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 200).cast("string"))).alias("g"),
        F.col("id"), (F.col("id") % 17).alias("w"),
    )


def test_hot_groups_lists_the_largest(skewed):
    got = {r.g: r["__parts"] for r in hot.hot_groups(skewed, ["g"], 100).collect()}
    assert got == {"hot": 10, "warm": 3}


def test_every_hot_group_is_cut(spark):
    many = spark.range(30_000).select((F.col("id") % 5000).alias("g"), "id")
    assert hot.hot_groups(many, ["g"], 5).count() == 5000


def test_strata_with_the_separator_in_a_key_stay_apart(spark):
    rows = [("a|b", "c", 1, "t1"), ("a|b", "c", 0, "c1"), ("a", "b|c", 1, "t2"), ("a", "b|c", 0, "c2")]
    df = spark.createDataFrame(rows, "x string, y string, treated int, id string")
    pairs = matching.matched_pairs(matching.stratum_match(df, ["x", "y"], "treated", "id"), "treated").collect()
    assert {(r.id_x, r.id_y) for r in pairs} == {("c1", "t1"), ("c2", "t2")}


def test_weights_must_be_whole(spark):
    rows = spark.createDataFrame([(1, "k")], "id int, k string")
    bad = spark.createDataFrame([("k", "A", 0.9), ("k", "B", 1.2)], "k string, code string, w double")
    with pytest.raises(Exception, match="not a whole number"):
        choice.weighted_choice(rows, bad, ["k"], "code", "w", ["id"], 1).collect()


def test_rows_with_a_missing_key_have_no_peers(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, g string")
    means = spark.createDataFrame([("a", 1.0), (None, 2.0)], "g string, m double")
    assert [r.id for r in joins.peers(df, means, ["g"], F.lit("x"), 1).collect()] == [1]


def test_running_totals_agree_with_a_plain_window(spark, skewed):
    from strataloom.functions.draws import draw32

    rows = skewed.withColumn("u", draw32("x", "id"))
    plain = running.running_totals(rows, ["g"], "u", ["id"], {"v": F.col("w")}, None)
    cut = running.running_totals(rows, ["g"], "u", ["id"], {"v": F.col("w")}, 40)
    shown = ["id", "v_before", "v_total"]
    assert cut.count() == 3000
    assert cut.select(*shown).exceptAll(plain.select(*shown)).count() == 0
    # No window partition is larger than its slice: "hot" is spread over many tasks' keys.
    parts = hot.split_hot(rows, ["g"], "u", hot.hot_groups(rows, ["g"], 40))
    assert parts.groupBy("g", hot.PART).count().agg(F.max("count")).first()[0] < 80


# ---- choice ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def codes_and_rows(spark):
    cands = spark.createDataFrame(
        [("A", None, "a1", 1), ("A", None, "a2", 3), ("A", None, "a0", 0), ("B", "x", "b1", 7), ("C", "x", "c1", 0),
         ("D", "x", "d1", 5), ("D", "x", "d2", None)],
        "cat string, sub string, code string, n int")
    rows = spark.range(4000).select(
        F.element_at(F.array(*[F.lit(c) for c in "ABCDE"]), (F.col("id") % 5 + 1).cast("int")).alias("cat"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("x")).alias("sub"), "id")
    return rows, cands


@pytest.mark.parametrize("options", [{}, {"target_rows": 100}, {"cuts": 37}])
def test_choice_picks_one_code_per_row(codes_and_rows, options):
    rows, cands = codes_and_rows
    got = choice.weighted_choice(rows, cands, ["cat", "sub"], "code", "n", ["id"], 5, **options).collect()
    by = collections.Counter(r.code for r in got)
    assert len(got) == len({r.id for r in got}) == 1600  # only A and B have usable candidates
    assert by["b1"] == 800 and by["a0"] == 0
    assert by["a2"] / 800 == pytest.approx(0.75, abs=0.05)


def test_choice_is_the_same_in_every_way(codes_and_rows):
    rows, cands = codes_and_rows
    runs = [{(r.id, r.code) for r in choice.weighted_choice(rows, cands, ["cat", "sub"], "code", "n", ["id"], 5,
                                                             **o).collect()}
            for o in ({}, {"target_rows": 50}, {"target_rows": 7})]
    assert runs[0] == runs[1] == runs[2]


def test_open_rows_can_be_kept(codes_and_rows):
    rows, cands = codes_and_rows
    got = choice.weighted_choice(rows, cands, ["cat", "sub"], "code", "n", ["id"], 5, keep_open=True)
    assert got.count() == 4000 and got.where("code IS NULL").count() == 2400


def test_wide_categories_are_cut(spark):
    cands = spark.range(5000).select(F.lit("only").alias("cat"), F.col("id").alias("code"),
                                     (F.col("id") % 5 + 1).alias("n"))
    rows = spark.range(3000).select(F.lit("only").alias("cat"), F.col("id").alias("row"))
    got, few, many = ({r.row: r.code for r in choice.weighted_choice(rows, cands, ["cat"], "code", "n", ["row"], 1, cuts=cuts).collect()}
                      for cuts in (None, 1, 3000))
    # Brute force over the cumulative weights in the order of the code hash.
    from strataloom.functions.draws import draw32
    order = sorted((r.p, r.code, r.n) for r in cands.select(draw32("order", "code").alias("p"), "code", "n").collect())
    total = sum(n for *_, n in order)
    highs = list(itertools.accumulate(n for *_, n in order))
    draws = {r.row: r.u for r in rows.select("row", draw32(1, "row").alias("u")).collect()}
    import bisect
    want = {row: order[bisect.bisect_right(highs, u * total // 2**32)][1] for row, u in draws.items()}
    assert got == few == many == want


def test_intervals_tile_the_draw_range(codes_and_rows):
    _, cands = codes_and_rows
    got = choice.choice_intervals(cands, ["cat", "sub"], "code", "n").collect()
    for cat in {r.cat for r in got}:
        edges = sorted((r.draw_from, r.draw_to) for r in got if r.cat == cat)
        assert edges[0][0] == 0 and edges[-1][1] == 2**32
        assert all(a[1] == b[0] for a, b in zip(edges, edges[1:]))


def test_rows_are_not_shuffled_for_few_candidates(codes_and_rows):
    rows, cands = codes_and_rows
    plan = plan_of(choice.weighted_choice(rows, cands, ["cat", "sub"], "code", "n", ["id"], 5))
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_fill_settings(spark):
    cands = spark.createDataFrame(
        [("ED", "A", "a1", 5), ("ED", "B", "b1", None), ("IP", "B", "b2", 2), ("IP", "A", "a1", 3), ("OP", "C", "c1", 0)],
        "setting string, cat string, code string, n int")
    got = choice.fill_settings(cands, "setting", ["cat"], ["code"], "n", ["ED", "IP", "OP"], "ANY").collect()
    rows = {(r.setting, r.cat, r.code): (r.n, r["round"]) for r in got}
    assert rows[("ED", "A", "a1")] == (5, 1) and rows[("IP", "A", "a1")] == (3, 1)
    assert rows[("OP", "A", "a1")] == (8, 2) and rows[("ANY", "A", "a1")] == (8, 2)
    # B is unusable in ED, so it is filled there; the missing count makes the filled category unusable too.
    assert rows[("ED", "B", "b1")] == (None, 2) and rows[("IP", "B", "b2")] == (2, 1)


# ---- matching ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def units(spark):
    # Strata with more controls than ratio * treated, with fewer, with none, and without treated.
    rows = [("many", i, int(i < 3)) for i in range(30)] + [("few", 100 + i, int(i < 5)) for i in range(8)]
    rows += [("none", 200 + i, 1) for i in range(4)] + [("ctrl", 300 + i, 0) for i in range(6)]
    rows += [("hot", 1000 + i, int(i % 9 == 0)) for i in range(900)]
    return spark.createDataFrame(rows, "s string, id int, t int")


@pytest.mark.parametrize("target", [1_000_000, 50])
def test_match_properties(units, target):
    got = matching.stratum_match(units, ["s"], "t", "id", 3, 1, target).collect()
    sizes = {s: (sum(r.t for r in units.collect() if r.s == s), sum(1 - r.t for r in units.collect() if r.s == s))
             for s in ("many", "few", "none", "ctrl", "hot")}
    assert len(got) == len({r.id for r in got})
    for s, (t, c) in sizes.items():
        assert sum(1 for r in got if r.s == s and r.t == 0) == min(c, 3 * t)
        assert sum(1 for r in got if r.s == s and r.t == 1) == min(t, c)
    per = collections.defaultdict(list)
    for r in got:
        per[r.subclass].append(r)
    for members in per.values():
        assert sum(m.t for m in members) == 1 and 2 <= len(members) <= 4
        assert len({m.s for m in members}) == 1
    controls = [r for r in got if r.t == 0]
    assert sum(r.weights for r in controls) == pytest.approx(len(controls))
    assert all(r.weights == 1 for r in got if r.t == 1)


def test_match_does_not_depend_on_slices_or_partitions(spark, units):
    runs = []
    for target, parts in ((1_000_000, "4"), (50, "4"), (50, "37")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        runs.append(sorted((r.id, r.subclass) for r in
                           matching.stratum_match(units, ["s"], "t", "id", 3, 1, target).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert runs[0] == runs[1] == runs[2]


def test_match_refuses_missing_keys(spark):
    df = spark.createDataFrame([(None, 1, 1), ("a", 2, 0)], "s string, id int, t int")
    with pytest.raises(Exception, match="missing key"):
        matching.stratum_match(df, ["s"], "t", "id").collect()


def test_pairs_and_first_control(units):
    matched = matching.stratum_match(units, ["s"], "t", "id", 3, 1)
    pairs = matching.matched_pairs(matched, "t").collect()
    assert all(p.t_x == 0 and p.t_y == 1 and p.s_x == p.s_y for p in pairs)
    assert len(pairs) == len({p.id_x for p in pairs}) == matched.where("t = 0").count()
    best = {r.who: r.first for r in matching.first_control(matched, "t", "id", "who", "first").collect()}
    want = {}
    for p in pairs:
        want[p.id_y] = min(want.get(p.id_y, 10**9), p.id_x)
    assert best == want


def test_exact_keys_balance_after_matching(units):
    matched = matching.stratum_match(units, ["s"], "t", "id", 3, 1)
    table = balance.balance(units, matched, ["s"], "t").collect()
    assert all(r.treated_matched == pytest.approx(r.control_matched, abs=1e-12) for r in table)
    assert sum(r.treated_all for r in table) == pytest.approx(1)


def test_scores_are_equal_inside_a_stratum(spark):
    rows = spark.range(600).select(
        (F.col("id") % 3).cast("string").alias("a"), (F.col("id") % 2 == 0).alias("b"), F.lit("same").alias("c"),
        (F.col("id") % 7 < 2 + F.col("id") % 3).cast("int").alias("t"))
    scored = balance.propensity(rows, ["a", "b", "c"], "t")
    spread = scored.groupBy("a", "b").agg((F.max("distance") - F.min("distance")).alias("d"),
                                          F.max("distance").alias("m")).collect()
    assert all(r.d < 1e-12 and 0 < r.m < 1 for r in spread) and len({round(r.m, 9) for r in spread}) > 1
    # The fitted scores of a model with intercept add up to the number of treated rows.
    sums = scored.agg(F.sum("distance").alias("p"), F.sum("t").alias("t")).first()
    assert sums.p == pytest.approx(sums.t, rel=1e-8)


# ---- ranks -------------------------------------------------------------------------------------

def test_percent_rank_with_ties_and_missing(spark):
    values = [5.0, 1.0, None, 3.0, 3.0, 3.0, None, 9.0]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    known = [v for v in values if v is not None]
    want = {i: None if v is None else sum(k < v for k in known) / (len(known) - 1) for i, v in enumerate(values)}
    for parts in ("1", "3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r.i: r.p for r in ranks.percent_rank(df, "v", "p").collect()}
        assert got == want
    assert ranks.percent_rank(df.where("i = 0"), "v", "p").first().p == 0.0
    assert ranks.percent_rank(df.where("v IS NULL"), "v", "p").collect()[0].p is None


def test_percent_rank_of_a_table_dominated_by_one_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 50).alias("v"))
    got = ranks.percent_rank(df, "v", "p")
    values = sorted(r.v for r in df.collect())
    first = {}
    for i, v in enumerate(values):
        first.setdefault(v, i)
    assert all(r.p == first[r.v] / 2999 for r in got.collect())
    # The only single-partition step is over range totals, never over rows or values.
    plan = plan_of(ranks.value_ranks(df, "v"))
    assert plan.count("SinglePartition") == 1


def test_normal_points(spark):
    from statistics import NormalDist

    df = spark.createDataFrame([(x,) for x in (3.0, 1.0, 2.0, 2.0, None)], "v double")
    got = sorted((r.position, r["sample"], r.theoretical) for r in ranks.normal_points(df, "v").collect())
    assert [g[:2] for g in got] == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0)]
    assert [g[2] for g in got] == pytest.approx([NormalDist().inv_cdf((i - 0.375) / 4.25) for i in range(1, 5)])
    blocks = spark.range(1000).select(F.lit(1.0).alias("v"))
    assert ranks.normal_points(blocks, "v", block=64).select("position").distinct().count() == 1000


# ---- codes -------------------------------------------------------------------------------------

def test_prefix_flags(spark):
    rows = spark.createDataFrame(
        [("p", "E1165"), ("p", "E1199"), ("p", "I110"), ("q", "Z00"), ("r", None), ("s", "I4260"), ("s", "I42")],
        "id string, code string")
    classes = {"chf": ["I110", "I426"], "hypc": ["I11"], "dm": ["E11"], "alc": ["I426"]}
    got = {r.id: r.asDict() for r in codes.prefix_flags(rows, "id", "code", classes,
                                                        {"chf": 7, "dm": -2, "alc": 0}).collect()}
    assert [got["p"][c] for c in classes] == [1, 1, 1, 0] and got["p"]["score"] == 5
    assert [got["s"][c] for c in classes] == [1, 0, 0, 1] and got["s"]["score"] == 7
    assert got["q"]["score"] == got["r"]["score"] == 0
    long = codes.long_flags(codes.prefix_flags(rows, "id", "code", classes, {}), "id")
    assert long.count() == 4 * 5


def test_more_classes_than_one_word(spark):
    classes = {f"c{i}": [f"{i:03d}"] for i in range(130)}
    rows = spark.createDataFrame([(1, "0059"), (1, "129"), (2, "061x"), (2, "062")], "id int, code string")
    got = {r.id: r.asDict() for r in codes.prefix_flags(rows, "id", "code", classes, {c: 1 for c in classes}).collect()}
    assert {c for c in classes if got[1][c]} == {"c5", "c129"} and {c for c in classes if got[2][c]} == {"c61", "c62"}
    assert got[1]["score"] == 2


def test_flags_take_one_shuffle(spark):
    rows = spark.createDataFrame([(1, "E119")], "id int, code string")
    plan = plan_of(codes.prefix_flags(rows, "id", "code", {"dm": ["E11", "E100"]}, {"dm": 1}))
    assert plan.count("hashpartitioning") == 1 and "SortMergeJoin" not in plan


# ---- the rest ----------------------------------------------------------------------------------

def test_shares_leave_out_missing_but_count_them(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", None), ("t", "b")], "src string, c string")
    got = {(r.src, r.c): r.share for r in aggregates.shares(df, "c", "src").collect()}
    assert got == {("s", "a"): 2 / 3, ("t", "b"): 1.0}
    assert {r.c: r.share for r in aggregates.shares(df, "c").collect()} == {"a": 0.5, "b": 0.25}


def test_stretch_keeps_the_mean(spark):
    a = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 6)], "v double")
    b = spark.createDataFrame([(float(x),) for x in (10, 40, 90)], "w double")
    got = aggregates.stretch(a, "v", "s", b, "w").agg(F.avg("s").alias("m"), F.stddev_samp("s").alias("d")).first()
    assert got.m == pytest.approx(3.0) and got.d == pytest.approx(b.agg(F.stddev_samp("w")).first()[0])


def test_proportional_truncates(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, pop long")
    assert {r.s: r.n for r in aggregates.proportional(df, "pop", 100, "n").collect()} == {"a": 33, "b": 66}


def test_nest_is_bounded_and_reversible(spark, skewed):
    nested = reshape.nest(skewed, ["g"], ["id", "w"], target_rows=100)
    assert nested.agg(F.max(F.size("data"))).first()[0] < 200
    back = reshape.unnest(nested, ["g"])
    assert back.count() == 3000 and back.exceptAll(skewed.select("g", "id", "w")).count() == 0


def test_samples(spark):
    df = spark.range(1000).select("id", (F.col("id") % 40).alias("who"))
    first = [r.id for r in sampling.sample_rows(df, 50, "id", 3).collect()]
    assert len(set(first)) == 50
    assert first == [r.id for r in sampling.sample_rows(df.repartition(7), 50, "id", 3).collect()]
    ids = sampling.sample_ids(df, 50, "id", "who", 3).orderBy("n").collect()
    assert len(ids) <= 40 and [r.n for r in ids] == list(range(1, len(ids) + 1))
    assert "TakeOrderedAndProject" in plan_of(sampling.sample_rows(df, 50, "id", 3))


def test_equal_rows_are_nested_in_bounded_parts(spark):
    df = spark.range(1000).select(F.lit(1).alias("g"), F.lit("same").alias("v"))
    sizes = [len(r["data"]) for r in reshape.nest(df, ["g"], ["v"], target_rows=10).collect()]
    assert sum(sizes) == 1000 and max(sizes) < 40


def test_ranks_of_large_whole_numbers(spark):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,), (2**53 + 2,)], "v long")
    got = {r.v - 2**53: r.p for r in ranks.percent_rank(df, "v", "p").collect()}
    assert got == {0: 0.0, 1: 0.5, 2: 1.0}


# ---- heavy keys --------------------------------------------------------------------------------

def test_heavy_keys_are_spread_over_tasks(spark):
    n, parts = 60_000, 16
    left = spark.range(n).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 5000).alias("k")).repartition(6)
    right = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).where("k % 7 > 0")
    right = right.unionByName(spark.createDataFrame([(None, -1)], "k long, v long"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = joins.join_heavy(left, right, ["k"], "left")
        rows = sorted(r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        assert len(rows) == parts and rows[-1] <= 2 * rows[parts // 2]
        assert joined.count() == n and joined.where("v IS NULL").count() == left.where("k % 7 = 0").count()
        for how in ("inner", "left_semi", "left_anti"):
            want = joins.null_safe_join(left, right, ["k"], how)
            got = joins.join_heavy(left, right, ["k"], how)
            assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert joins.join_heavy(left.limit(0), right, ["k"]).count() == 0
    with pytest.raises(ValueError):
        joins.join_heavy(left, right, ["k"], "full")


def test_a_match_without_partners_is_empty(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 0, 2)], "g string, t int, id int")
    assert matching.stratum_match(df, ["g"], "t", "id", 2).collect() == []


def test_settings_are_folded_in_many_tasks(spark, monkeypatch):
    rows = [(s, "E", f"E{i}", i + 1) for i in range(60) for s in ("ED", "IP")]
    df = spark.createDataFrame(rows, "setting string, category string, code string, n long").repartition(1)
    monkeypatch.setattr(choice, "TASK_ROWS", 10)
    filled = choice.fill_settings(df, "setting", ["category"], ["code"], "n", ("ED", "IP", "OP"), "ANY")
    assert "REPARTITION_BY_NUM" in plan_of(filled)
    got = {(r.setting, r.code): (r.n, r["round"]) for r in filled.collect()}
    assert len(got) == 240 and got["OP", "E5"] == got["ANY", "E5"] == (12, 2) and got["ED", "E5"] == (6, 1)


def test_parts_number_long_groups_only(spark):
    rows = spark.createDataFrame([("a", i) for i in range(25)] + [("b", 1), (None, 2)] + [(None, i) for i in range(11)], "k string, v long")
    cut = reshape.parts(rows.withColumn("d", F.col("v") * 100_000_000), ["k"], "d", ["v"], 10)
    sizes = collections.Counter((r.k, r.part) for r in cut.collect())
    assert sizes == {("a", 0): 10, ("a", 1): 10, ("a", 2): 5, ("b", 0): 1, (None, 0): 10, (None, 1): 2}
    assert "LeftAnti" in plan_of(cut)
