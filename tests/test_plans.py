"""The plans on small hand-made medical tables."""

import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from strataloom.plans import diagnoses, drugs, people, profiles, risk
from strataloom.session import materialize
from strataloom.sources import lookups as L
from strataloom.sources import schemas

DAY = dt.date(2021, 12, 31)


def table(spark, ddl, rows):
    """Rows given as dicts; columns that are not named are NULL."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def person_file(spark, year, rows):
    yy = f"{year % 100:02d}"
    base = {"DOBMM": 6, "SEX": 1, "RACETHX": 2, f"REGION{yy}": 1, f"INSURC{yy}": 1, f"MARRY{yy}X": 1,
            f"PERWT{yy}F": 100.0, f"TTLP{yy}X": 1000.0}
    return table(spark, schemas.yearly(schemas.PERSON_COLUMNS, year), [{**base, **r} for r in rows])


# ---- people ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def respondents(spark):
    files = {
        2021: person_file(spark, 2021, [
            {"DUPERSID": "a", "AGELAST": 40, "DOBYY": 1981},
            {"DUPERSID": "b", "AGELAST": 17, "DOBYY": 2004},                       # not an adult
            {"DUPERSID": "c", "AGELAST": 40, "DOBYY": 1981, "PERWT21F": 0.0},      # no weight
            {"DUPERSID": "d", "AGELAST": 40, "DOBYY": 1981, "REGION21": -1},       # left the country
            {"DUPERSID": "e", "AGELAST": 70, "DOBYY": 1951, "INSURC21": 4, "TTLP21X": 5000.0, "MARRY21X": 3},
        ]),
        2020: person_file(spark, 2020, [
            {"DUPERSID": "a", "AGELAST": 39, "DOBYY": 1981, "TTLP20X": 1000.0},
            {"DUPERSID": "f", "AGELAST": 30, "DOBYY": 1990, "DOBMM": -8},          # unknown month
            {"DUPERSID": "g", "AGELAST": 30, "DOBYY": 1990, "SEX": 2, "RACETHX": 5, "INSURC20": 9, "TTLP20X": None},
        ]),
    }
    return people.respondent_pool(files)


def test_respondent_pool(respondents):
    got = {(r.DUPERSID, r.MEPS_DATA_YEAR) for r in respondents.collect()}
    assert got == {("a2021", 2021), ("d2021", 2021), ("e2021", 2021), ("a2020", 2020), ("g2020", 2020)}
    assert respondents.columns[:33] == schemas.PERSON_COLUMNS


def test_respondent_input(respondents):
    got = {r.Id: r for r in people.respondent_input(respondents, 1).collect()}
    assert set(got) == {"a2021", "e2021", "a2020", "g2020"}
    assert list(got["a2021"].asDict()) == people.MATCH_COLUMNS
    e, g = got["e2021"], got["g2020"]
    assert (e.MARITAL, e.REGIONYY, e.INSURCYY, e.AGE_GRP_9) == ("D", "Northeast", L.MEDICARE, "70 - 79")
    assert (g.SEX, g.RACETHX, g.INSURCYY, g.INCOME_PCT) == ("F", L.OTHER_RACE, "UNINSURED", None)
    # Two ties below one larger value, after the filters: ranks 0, 0 and 1.
    assert (got["a2021"].INCOME_PCT, got["a2020"].INCOME_PCT, e.INCOME_PCT) == (0.0, 0.0, 1.0)
    assert got["a2021"].BIRTHDATE.year == 1981 and got["a2021"].BIRTHDATE.month == 6
    assert 40 < got["a2021"].AGELAST < 41 and 39 < got["a2020"].AGELAST < 40


@pytest.fixture(scope="module")
def patients(spark):
    def one(i, born, **more):
        return {"Id": i, "BIRTHDATE": born, "RACE": "white", "ETHNICITY": "nonhispanic", "GENDER": "M", "MARITAL": "M",
                "STATE": "Ohio", "INCOME": 100, "FIRST": "James", "LAST": "Doe", "PREFIX": "Mr.", "CITY": "X", **more}

    return table(spark, schemas.PATIENTS, [
        one("p1", dt.date(1980, 1, 1)), one("p2", dt.date(1930, 1, 1), INCOME=900, MARITAL=None),
        one("p3", dt.date(2010, 1, 1), INCOME=0), one("p4", dt.date(1956, 1, 5), ETHNICITY="hispanic", RACE="black"),
        one("p5", dt.date(1956, 12, 31), RACE="native", STATE="Puerto Rico", INCOME=None),
        one("p6", dt.date(1940, 1, 1), INCOME=500, RACE="asian"), one("p7", dt.date(1981, 6, 15), STATE="New York"),
        one("p8", dt.date(1981, 6, 15), STATE="New York", FIRST="Ada", GENDER="F"),
        one("p9", dt.date(1981, 2, 15), STATE="New York"),
    ])


@pytest.fixture(scope="module")
def conformed(spark, patients):
    return people.conform_people(patients, people.region_table(L.state_regions(spark)))


def test_conform_people(conformed):
    got = {r.Id: r for r in conformed.collect()}
    assert "p3" not in got  # a child, but it still counts in the income ranks
    assert (got["p2"].AGELAST, got["p2"].DOBYY, got["p2"].MARITAL) == (85.0, 1936, "S")
    assert (got["p1"].DOBYY, got["p1"].REGIONYY, got["p1"].RACETHX) == (1980, "North Central", L.WHITE)
    assert got["p4"].RACETHX == L.HISPANIC and got["p6"].RACETHX == L.ASIAN and got["p5"].RACETHX == L.OTHER_RACE
    assert got["p5"].REGIONYY is None and got["p5"].INCOME_PCT is None
    assert got["p2"].INCOME_PCT == 1.0 and got["p1"].INCOME_PCT == 1 / 7


@pytest.fixture(scope="module")
def payers_now(spark):
    payers = table(spark, schemas.PAYERS, [
        {"Id": "1", "NAME": "Medicare", "OWNERSHIP": "GOVERNMENT"},
        {"Id": "2", "NAME": "Medicaid", "OWNERSHIP": "GOVERNMENT"},
        {"Id": "3", "NAME": "blue-cross plan", "OWNERSHIP": "PRIVATE"},
        {"Id": "3", "NAME": "blue-cross plan", "OWNERSHIP": "PRIVATE"},
        {"Id": "4", "NAME": "NO_INSURANCE", "OWNERSHIP": "NO_INSURANCE"}])
    start, end = dt.datetime(2021, 3, 1, 5), dt.datetime(2022, 3, 1, 5)
    held = [("p1", "3", None), ("p2", "1", "3"), ("p3", "3", None), ("p4", "2", None), ("p5", "1", None),
            ("p6", "1", "3"), ("p7", "3", None), ("p8", "4", "3"), ("p9", "3", "4")]
    rows = [{"PATIENT": p, "PAYER": a, "SECONDARY_PAYER": b, "START_DATE": start, "END_DATE": end} for p, a, b in held]
    rows.append({"PATIENT": "p1", "PAYER": "4", "START_DATE": dt.datetime(2019, 1, 1), "END_DATE": dt.datetime(2020, 1, 1)})
    return people.payer_on(table(spark, schemas.PAYER_TRANSITIONS, rows), payers)


def test_payer_on(payers_now):
    got = {r.PATIENT: r for r in payers_now.collect()}
    assert len(got) == payers_now.count() == 9
    assert (got["p2"].PRIMARY_PAYER, got["p2"].SECONDARY_PAYER_ORG) == ("Medicare", "PRIVATE")
    assert got["p1"].SECONDARY_PAYER is None


def test_insurance_class(spark):
    cases = [  # age, payer, owner, second owner, income rank, class
        (64.0, "blue", "PRIVATE", None, 0.5, L.PRIVATE_UNDER_65), (65.0, "m", "GOVERNMENT", None, 0.5, L.PUBLIC_UNDER_65),
        (30.0, "NO_INSURANCE", "NO_INSURANCE", None, 0.5, L.NONE_UNDER_65), (30.0, "x", "OTHER", None, 0.5, None),
        (30.0, "x", None, None, 0.5, None), (None, "Medicare", "GOVERNMENT", None, 0.5, None),
        (66.0, "Medicare", "GOVERNMENT", None, 0.5, L.MEDICARE), (66.0, "Medicaid", "GOVERNMENT", None, 0.5, L.MEDICARE_PUBLIC),
        (66.0, "Medicare", "GOVERNMENT", "PRIVATE", 0.71, L.MEDICARE_PRIVATE),
        (66.0, "Medicare", "GOVERNMENT", "PRIVATE", 0.19, L.MEDICARE_PRIVATE),
        (66.0, "Medicare", "GOVERNMENT", "PRIVATE", 0.7, L.MEDICARE), (66.0, "Medicare", "GOVERNMENT", "PRIVATE", 0.2, L.MEDICARE),
        (66.0, "Medicare", "GOVERNMENT", "PRIVATE", None, L.NONE_65), (66.0, "blue", "PRIVATE", None, 0.5, L.NONE_65),
        (66.0, "Medicare", "GOVERNMENT", "GOVERNMENT", 0.5, L.NONE_65),
    ]
    df = spark.createDataFrame(cases, "AGELAST double, PRIMARY_PAYER string, PRIMARY_PAYER_ORG string, "
                                      "SECONDARY_PAYER_ORG string, INCOME_PCT double, want string")
    got = df.withColumn("got", people.insurance_class()).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_person_table_end_to_end(spark, patients, payers_now, respondents, conformed):
    side = people.people_input(conformed, payers_now)
    assert side.columns == people.MATCH_COLUMNS
    gaps = people.unmatchable(side).first()
    assert gaps.REGIONYY == 1 and gaps.SEX == 0
    known = people.respondent_input(respondents, 1)
    shares = people.representativeness(side, known).groupBy("category", "source").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in shares)
    matched = materialize(people.match_people(people.matchable(side), known, 1, score=True))
    # p7 and p9 are the only people in the stratum of respondent a of 2021 (age 40, Northeast, married, private).
    pairs = materialize(people.matchup(matched))
    found = {(r.Synthea_ID, r.MEPS_ID) for r in pairs.collect()}
    assert {p for p, _ in found} == {"p7", "p9"} and {m for _, m in found} == {"a2021"}
    assert matched.agg(F.count_distinct(F.round("distance", 9))).first()[0] == 1

    faces = table(spark, schemas.FACES, [
        {"filename": f"f{i}.png", "age": 38.0 + i, "gender_man": 99.0, "gender_woman": 1.0, "dominant_gender": "Man",
         "dominant_race": "white", "race_white": 86.0} for i in range(5)] + [
        {"filename": "x.png", "age": 40.0, "gender_man": 60.0, "gender_woman": 40.0, "dominant_gender": "Man",
         "dominant_race": "white", "race_white": 99.0},
        {"filename": "y.png", "age": 40.0, "gender_man": 99.0, "gender_woman": 1.0, "dominant_gender": "Man",
         "dominant_race": "white", "race_white": 84.0},
        {"filename": "z.png", "age": 12.0, "gender_man": 99.0, "gender_woman": 1.0, "dominant_gender": "Man",
         "dominant_race": "white", "race_white": 99.0}])
    images = people.usable_images(faces, people.actual_ages(matched))
    assert {r.filename for r in images.collect()} == {f"f{i}.png" for i in range(5)}
    chosen = people.match_images(pairs, images, 1)
    assert {r.Synthea_ID for r in chosen.collect()} == {"p7", "p9"}
    final = people.person_table(chosen, pairs, known, patients, payers_now)
    rows = {r.Synthea_ID: r for r in final.collect()}
    p9 = rows["p9"]
    assert len(final.columns) == 25
    assert (p9.RACETHX, p9.GENDER, p9.MARITAL_STATUS) == ("Non-Hispanic White Only", "Male", "Married")
    assert (p9.PRIMARY_PAYER, p9.PRIMARY_PAYER_ORG, p9.FIRST, p9.STATE) == ("Blue-Cross Plan", "Private", "James", "New York")


def test_state_allocation(spark):
    pop = spark.createDataFrame([("Ohio", 300), ("Utah", 100), ("Puerto Rico", 999)], "state string, pop long")
    got = {r.state: r.simulate for r in people.state_allocation(pop, 1001).collect()}
    assert got == {"Ohio": 750, "Utah": 250}


# ---- diagnoses and risk ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def completed(spark):
    def cond(person, n, code, ccsr2="-1", **flags):
        return {"DUPERSID": person, "CONDN": n, "ICD10CDX": code, "CCSR1X": "X1", "CCSR2X": ccsr2, "CCSR3X": "-1",
                "AGEDIAG": -8 if n == 2 else 44, **flags}

    files = {
        2021: table(spark, schemas.conditions(2021), [
            cond("u", 1, "E11", ERCOND=1, IPCOND=1, OPCOND=1), cond("u", 2, "E11", ERCOND=2, IPCOND=2, OPCOND=2),
            cond("u", 3, "-15", ERCOND=1), cond("v", 1, "I10", ERCOND=2, IPCOND=1), cond("v", 2, "Z21", ERCOND=1),
            cond("v", 3, "E11", ccsr2="X2", ERCOND=1), cond("v", 4, "I10")]),
        2020: table(spark, schemas.conditions(2020), [
            cond("u", 1, "E11", ERNUM=0, IPNUM=0, OPNUM=4), cond("u", 2, "E11", ERNUM=-1, IPNUM=3, OPNUM=0)]),
    }
    freq = [("ED", "E11.9", 5), ("ED", "E11.65", 0), ("IP", "E11.65", 4), ("OP", "E11.65", 3), ("IP", "I10", None),
            ("OP", "I10", 2), ("ED", "Z21", None), ("ED", "E11.22", 9)]
    frequencies = spark.createDataFrame(
        [(s, y, c, n) for s, c, n in freq for y in (2020, 2021)], "setting string, year int, ICDCMCode string, TotalDiag long")
    names = [("E119", "plain", None, "Diabetes"), ("E1165", "high", None, "Diabetes"), ("E1122", "kidney", "X2", "Diabetes"),
             ("I10", "pressure", None, "Heart"), ("Z21", "positive", None, "Virus")]
    crosswalk = spark.createDataFrame(
        [(v, c, d, "X1", c2, None, t, None if c2 is None else "Kidney\n  failure", None)
         for c, d, c2, t in names for v in (2020, 2021)],
        "version int, ICD10CM string, ICD10_DSC string, CCSR1X string, CCSR2X string, CCSR3X string, "
        "CCSR1X_DSC string, CCSR2X_DSC string, CCSR3X_DSC string")
    chronic = spark.createDataFrame([("E119", "C"), ("E1122", "B"), ("I10", "?")], "ICD10CM string, CHRONIC_IND string")
    return diagnoses.diagnoses(files, frequencies, crosswalk, chronic, 3)


def test_completion(completed):
    done, _ = completed
    got = {(r.year, r.DUPERSID, r.CONDN): (r.setting, r.ICD10CM, r["round"]) for r in done.collect()}
    assert len(got) == done.count() == 8  # the suppressed code is gone
    assert got[(2021, "u", 1)] == ("ED", "E119", 1)             # the zero count is never drawn
    assert got[(2021, "v", 3)] == ("ED", "E1122", 1)            # categories tell the codes apart
    assert got[(2020, "u", 1)] == ("OP", "E1165", 1)
    assert got[(2020, "u", 2)][0] == "ANY" and got[(2020, "u", 2)][2] == 2   # a negative count ends the search
    assert got[(2021, "u", 2)][0] == "ANY" and got[(2021, "u", 2)][1] in ("E119", "E1165")
    # Missing counts leave the category open in the second round too.
    assert got[(2021, "v", 1)] == ("IP", None, None) and got[(2021, "v", 2)] == ("ED", None, None)
    counts = diagnoses.coverage(done).agg(F.sum("conditions")).first()[0]
    assert counts == 8


def test_diagnosis_detail(completed):
    _, detail = completed
    got = {(r.DUPERSID, r.ICD10CM): r for r in detail.collect()}
    assert detail.columns == ["DUPERSID", "ICD10CM_Pretty", "ICD10CM", "ICD10_DSC", "CCSR_DSC", "CHRONIC_IND", "Age_Diag"]
    v = got[("v2021", "E1122")]
    assert (v.ICD10CM_Pretty, v.CCSR_DSC, v.CHRONIC_IND, v.Age_Diag) == ("E11.22", "Diabetes Kidney failure", "Both", "44")
    u = got[("u2020", "E1165")]
    assert (u.CCSR_DSC, u.CHRONIC_IND) == ("Diabetes", "N/A")
    assert any(r.Age_Diag == "Unknown" for r in got.values())


def test_code_lists_are_not_copied_to_every_task(spark):
    frequencies = spark.createDataFrame([("ED", 2021, "E11.9", 3)], "setting string, year int, ICDCMCode string, TotalDiag long")
    crosswalk = spark.createDataFrame(
        [(2021, "E119", "plain", "X1", None, None, "Diabetes", None, None)],
        "version int, ICD10CM string, ICD10_DSC string, CCSR1X string, CCSR2X string, CCSR3X string, "
        "CCSR1X_DSC string, CCSR2X_DSC string, CCSR3X_DSC string")
    done = spark.createDataFrame(
        [("u", 2021, 44, "E119", "E11.9", "plain", "X1", None, None)],
        "DUPERSID string, year int, AGEDIAG int, ICD10CM string, ICDCMCode string, ICD10_DSC string, CCSR1X string, CCSR2X string, CCSR3X string")
    chronic = spark.createDataFrame([("E119", "Chronic")], "ICD10CM string, CHRONIC_IND string")
    candidates = diagnoses.candidate_codes(frequencies, crosswalk)
    detail = diagnoses.diagnosis_detail(done, crosswalk, chronic)
    for table in (candidates, detail):
        assert table.count() == 1 and "Broadcast" not in plan_of(table)


def test_comorbidities(spark):
    dx = spark.createDataFrame(
        [("p", "E1165"), ("p", "I10"), ("p", "I110"), ("q", "Z00"), ("r", "I426"), ("r", "C50911"), ("r", "C7800")],
        "DUPERSID string, ICD10CM string")
    long = risk.comorbidity_detail(dx)
    assert long.count() == 3 * 32
    rows = {(r.DUPERSID, r.Field_Name): r for r in long.collect()}
    held = {p: {f for (q, f), r in rows.items() if q == p and f != "score" and r.Field_Value} for p in "pqr"}
    assert held == {"p": {"diabc", "hypunc", "chf", "hypc"}, "q": set(), "r": {"chf", "alcohol", "solidtum", "metacanc"}}
    assert [rows[(p, "score")].Field_Value for p in "pqr"] == [7, 0, 7 + 0 + 4 + 12]
    assert rows[("p", "chf")].vw_weights == 7 and rows[("p", "score")].vw_weights is None


# ---- drugs and profiles ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def drug_people(spark):
    files, links = {}, []
    for year in (2021, 2020):
        yy = f"{year % 100}"
        rows = []
        for k in range(40):
            rows.append({"DUPERSID": f"d{k}", "PANEL": 24, f"RXTOT{yy}": k % 5, f"RXEXP{yy}": 10.0 * k, f"RXSLF{yy}": 1.0 * k,
                         f"PERWT{yy}F": 30.0 + k, "RACETHX": 1 + k % 6, f"AGE{yy}X": 10 + 2 * k, "SEX": 1 + k % 2})
        files[year] = table(spark, schemas.yearly(schemas.PERSON_DRUG_COLUMNS, year), rows)
    links = [{"DUPERSID": f"d{k}", "PANEL": 24, "STRA9621": 1 + k % 2, "PSU9621": 1 + k % 3} for k in range(40)]
    return drugs.person_drugs(files, table(spark, schemas.LINKAGE, links))


def test_person_drugs(drug_people):
    assert drug_people.count() == 80
    r = drug_people.where("ID = 'd52020'").first()
    assert (r.POOLWTYY, r.AGE_GRP_9, r.RACETHX_DSC, r.SEX_DSC) == (17.5, "18 - 29", "6", "Female")
    assert len(drug_people.columns) == 15


def test_drug_means(drug_people):
    everyone = drugs.drug_means(drug_people, "all").first()
    assert set(everyone.asDict()) == {f"{m}{s}" for m in drugs.MEASURES for s in ("", "_low", "_upp")}
    assert everyone.mean_tot_spend == pytest.approx(10 * everyone.mean_oop_spend)
    by_race = drugs.drug_means(drug_people, "age_race")
    assert {"mean_util_se", "mean_util_rse"} <= set(by_race.columns)
    assert by_race.where("AGE_GRP_9 = '5 - 17'").count() == 0  # children are no part of the domain
    sizes = drugs.cut_sizes(drug_people, "age_gender")
    assert sizes.where("large_enough").count() == 0 and sizes.agg(F.sum("count")).first()[0] == 72


@pytest.fixture(scope="module")
def purchases(spark):
    def fill(person, name, year, begin, rec, oop, tot, ndc="1"):
        return {"DUPERSID": person, "RXNAME": name, "RXBEGYRX": begin, "RXRECIDX": rec, "RXNDC": ndc,
                f"RXSF{year % 100}X": oop, f"RXXP{year % 100}X": tot}

    files = {
        2021: table(spark, schemas.yearly(schemas.FILL_COLUMNS, 2021), [
            fill("d1", "A", 2021, 2021, "r1", 5.0, 20.0), fill("d1", "A", 2021, 2021, "r2", 5.0, 20.0, "2"),
            fill("d1", "B", 2021, 2018, "r3", None, 9.0), fill("d1", "-15", 2021, 2018, "r4", 1.0, 9.0),
            fill("d1", "C", 2021, -8, "r5", 1.0, 4.0, "-15"), fill("d2", "A", 2021, -8, "r6", 1.0, 4.0)]),
        2020: table(spark, schemas.yearly(schemas.FILL_COLUMNS, 2020), [fill("d1", "A", 2020, 2019, "r1", 2.0, 3.0)]),
    }
    return drugs.fills(files)


def test_drug_detail(purchases):
    got = {(r.ID, r.RXNAME): r for r in drugs.drug_detail(purchases).collect()}
    assert set(got) == {("d12021", "A"), ("d12021", "B"), ("d22021", "A"), ("d12020", "A")}
    a = got[("d12021", "A")]
    assert (a.count_unique, a.cost_oop, a.cost_tot, a.cost_plan, a.yrs_on_rx) == (2, 10.0, 40.0, 30.0, "Less than a year")
    b = got[("d12021", "B")]
    assert (b.cost_oop, b.cost_plan, b.yrs_on_rx) == (None, None, "3 to 4 years")
    assert got[("d22021", "A")].yrs_on_rx == "Unknown"
    counts = {(r.ID, r.RXNDC): r["count"] for r in drugs.code_counts(purchases).collect()}
    assert counts[("d12021", "1")] == 2 and counts[("d12021", "2")] == 1


def test_profiles(spark, drug_people, purchases, completed):
    persons = spark.createDataFrame(
        [("d12021", "s1", "f1.png", "Chris", "Female", "Non-Hispanic White Only", 44.9, "40 - 49"),
         ("u2021", "s2", "f2.png", "Ada", "Male", "Hispanic", 31.0, "30 - 39"),
         ("x2021", "s3", "f3.png", "Bo", "Male", "Hispanic", 99.0, "80 and over")],
        "MEPS_ID string, Synthea_ID string, filename string, FIRST string, GENDER string, RACETHX string, "
        "AGELAST double, AGE_GRP_9 string",
    ).selectExpr("*", "'Dr.' AS PREFIX", "'Who' AS LAST", "DATE '1977-02-03' AS BIRTHDATE", "'Single' AS MARITAL_STATUS",
                 "'Rome' AS CITY", "'Ohio' AS STATE", "'Medicare' AS PRIMARY_PAYER", "'Government' AS PRIMARY_PAYER_ORG")
    _, dx = completed
    detail = drugs.drug_detail(purchases)
    means = {cut: drugs.drug_means(drug_people, cut) for cut in drugs.CUTS}
    tables = (dx, detail, drug_people, means, risk.comorbidity_detail(dx))
    out = {name: df.collect() for name, df in profiles.sections(persons, *tables).items()}
    head = {r.Synthea_ID: r for r in out["header"]}["s1"]
    assert (head.name, head.possessive_name, head.obj_pronoun, head.pos_pronoun, head.age) == (
        "Dr. Chris Who", "Chris'", "her", "her", 44)
    assert (head.location, head.health_plan, head.image) == ("Rome, Ohio", "Medicare (Government)", "./etc/faces/f1.png")
    said = {k: {r.Synthea_ID: r.sentence for r in out[k]} for k in out if k.endswith("_text")}
    assert said["drugs_text"]["s1"] == "Chris took 2 unique prescribed drugs in 2021."
    assert said["drugs_text"]["s3"] == "Bo did not take any prescribed drugs in 2021."
    assert said["conditions_text"]["s2"] == "Ada received a diagnosis for 2 unique medical conditions in 2021."
    assert said["conditions_text"]["s3"] == "Bo did not receive a diagnosis for any medical conditions in 2021."
    assert said["comorbidities_text"]["s3"].endswith("that maps to any Elixhauser Comorbidity categories.")
    lines = {r["Drug Name"]: r for r in out["drugs"]}
    assert set(lines) == {"A", "B", "Total"} and lines["Total"]["Total cost"] == 49.0
    assert lines["Total"]["Length of time taking the drug"] is None
    use = [r for r in out["use"] if r.Synthea_ID == "s1"]
    assert sorted(r.position for r in use) == [1, 2, 3] and all(r.own_value == 1 for r in use)
    assert all(len(line) <= 50 for r in use for line in r.breakout.split("\n"))
    assert next(r for r in use if r.position == 3).mean_util == pytest.approx(means["all"].first().mean_util)
    risks = [r for r in out["comorbidities"] if r.MEPS_ID == "u2021"]
    assert [r.position for r in sorted(risks, key=lambda r: r.position)][-1] == 1
    # The documents hold the same rows; with parts of one row a list goes on in further rows.
    whole = {r.Synthea_ID: r for r in profiles.profiles(persons, *tables, 200, 1).collect()}
    assert sorted(r.n for r in whole.values()) == [1, 2, 3] and all(r.part == 0 for r in whole.values())
    assert [x["Drug Name"] for x in whole["s1"].drugs] == ["A", "B", "Total"] and whole["s3"].drugs == []
    assert whole["s1"].drugs_text == said["drugs_text"]["s1"] and whole["s1"].name == head.name
    assert {tuple(x) for x in whole["s2"].conditions} == {tuple(r)[1:] for r in out["conditions"] if r.MEPS_ID == "u2021"}
    assert [x.position for x in whole["s1"].use] == [1, 2, 3] and whole["s1"].use[2].own_value == 1
    assert whole["s2"].comorbidities[-1].position == 1
    cut = profiles.documents(persons, *tables, part_rows=1).where("Synthea_ID = 's1'").orderBy("part").collect()
    assert [r.part for r in cut] == [0, 1, 2] and [r.name is None for r in cut] == [False, True, True]
    assert sorted(x["Drug Name"] for r in cut for x in r.drugs) == ["A", "B", "Total"] and all(len(r.drugs) == 1 for r in cut)
    assert cut[0].n_drugs == 2 and cut[0].drugs_text == said["drugs_text"]["s1"]
