import datetime as dt

import pytest
from conftest import plan_of

from strataloom.sources import lookups as L
from strataloom.sources import readers, schemas, writers


def test_csv_with_explicit_schema(spark, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text("Id,BIRTHDATE,INCOME,MARITAL,LAT\np1,1950-03-01,1200,M,41.5\np2,2001-12-31,NA,,x\n")
    got = readers.read_csv(spark, str(path), "LAT double, Id string, INCOME int, MARITAL string, BIRTHDATE date")
    assert got.dtypes == [("LAT", "double"), ("Id", "string"), ("INCOME", "int"), ("MARITAL", "string"),
                          ("BIRTHDATE", "date")]
    assert [tuple(r) for r in got.orderBy("Id").collect()] == [
        (41.5, "p1", 1200, "M", dt.date(1950, 3, 1)), (None, "p2", None, None, dt.date(2001, 12, 31))]


def test_quoted_csv(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text(
        "'ICD-10-CM CODE','ICD-10-CM CODE DESCRIPTION','CCSR CATEGORY 1'\n"
        "'E119','Type 2 diabetes, plain','END002'\n'Z21','HIV',' '\n")
    names = ["ICD-10-CM CODE", "ICD-10-CM CODE DESCRIPTION", "CCSR CATEGORY 1"]
    # A comma inside single quotes splits the line, so such files come with double quotes as well.
    path.write_text(path.read_text().replace("'Type 2 diabetes, plain'", "\"'Type 2 diabetes, plain'\""))
    got = readers.read_quoted_csv(spark, str(path), {names[0]: "ICD10CM", names[2]: "CCSR1X", names[1]: "D"}, names)
    assert [tuple(r) for r in got.orderBy("ICD10CM").collect()] == [
        ("E119", "END002", "Type 2 diabetes, plain"), ("Z21", None, "HIV")]


def test_preamble_is_skipped(spark, tmp_path):
    path = tmp_path / "chronic.csv"
    path.write_text("Chronic Condition Indicator,,\nVersion 2021,,\n'ICD-10-CM CODE','TEXT','CHRONIC INDICATOR'\n"
                    "'E119','Diabetes','C'\n'J00','Cold','A'\n,'no code','B'\n'Z99',,\n")
    names = ["ICD-10-CM CODE", "TEXT", "CHRONIC INDICATOR"]
    got = readers.read_quoted_csv(spark, str(path), {names[0]: "code", names[2]: "ind"}, names,
                                  ["Chronic Condition Indicator", "Version 2021"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("E119", "C"), ("J00", "A"), ("Z99", None), (None, "B")]


def test_partitioned_source_prunes(spark, tmp_path):
    base = str(tmp_path / "survey")
    for kind, year in (("FYC", 2020), ("FYC", 2021), ("RX", 2021)):
        df = spark.createDataFrame([(f"{kind}{year}",)], "DUPERSID string").selectExpr(
            "DUPERSID", f"'{kind}' AS type", f"{year} AS year")
        df.write.mode("append").partitionBy("type", "year").parquet(base)
    got = readers.read_partition(spark, base, "DUPERSID string", type="FYC", year=2021)
    assert [r.DUPERSID for r in got.collect()] == ["FYC2021"] and got.columns == ["DUPERSID"]
    assert "PartitionFilters: [isnotnull(type" in plan_of(got)


def test_write_append_and_export(spark, tmp_path):
    a, b = spark.range(3), spark.range(3, 5)
    path = str(tmp_path / "t")
    writers.write_batches([a, b], path)
    assert spark.read.parquet(path).count() == 5
    writers.write_batches([b], path)
    assert spark.read.parquet(path).count() == 2
    back = writers.write_table(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "c"), csv=True)
    assert [tuple(r) for r in back.collect()] == [(1, None)]
    writers.export_subset({"x": a, "y": b}, ["y"], str(tmp_path / "out"))
    assert not (tmp_path / "out" / "x").exists() and (tmp_path / "out" / "y").exists()


def test_lookups(spark):
    regions = {r.state: r.region for r in L.state_regions(spark).collect()}
    assert len(regions) == 51 and regions["District of Columbia"] == "South" and regions["Ohio"] == "North Central"
    assert sorted(set(regions.values())) == sorted(L.REGION_CODES.values())
    names = L.comorbidity_descriptions(spark).collect()
    assert len(names) == 32 and names[-1].vw_weights is None
    prefixes = L.comorbidity_prefixes()
    assert list(prefixes) == list(L.COMORBIDITIES)
    assert {len(p) for ps in prefixes.values() for p in ps} == {3, 4}
    assert L.expand_prefixes("I05-I08 Q230-Q233 C97") == ["I05", "I06", "I07", "I08", "Q230", "Q231", "Q232", "Q233",
                                                         "C97"]


def test_schemas_follow_the_year():
    text = schemas.yearly(schemas.PERSON_COLUMNS, 2020)
    for name in ("MARRY20X int", "PERWT20F double", "DOBYY int", "FAMID20 string", "REGION20 int"):
        assert name in text
    assert "`ERNUM` int" in schemas.conditions(2019) and "`ERCOND` int" in schemas.conditions(2021)


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path), "x int, y int").collect()


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n')
    got = readers.read_csv(spark, str(tmp_path), "x int, y string", multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, "a\nb")]


def test_written_tables_are_released(spark):
    import os

    from strataloom.session import materialize, own_folder, release

    materialize(spark.range(3))
    assert os.listdir(own_folder(spark))
    release(spark)
    assert not os.path.exists(own_folder(spark))


def test_a_job_removes_its_tables(spark):
    import os

    from strataloom.session import job, materialize, own_folder

    def tables():
        return set(os.listdir(folder)) if os.path.exists(folder) else set()

    folder = own_folder(spark).removeprefix("file://")
    before = tables()
    with job(spark):
        assert materialize(spark.range(3)).count() == 3 and len(tables() - before) == 1
        with job(spark):
            materialize(spark.range(2))
    assert tables() == before
    with pytest.raises(RuntimeError), job(spark):
        materialize(spark.range(3))
        raise RuntimeError
    assert tables() == before


def test_tables_are_written_without_a_preset_folder(tmp_path):
    """A session with an empty configuration, in a process of its own."""
    import os
    import subprocess
    import sys

    code = ("from pyspark.sql import SparkSession; from strataloom.session import materialize, release\n"
            "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "assert materialize(s.range(5)).count() == materialize(s.range(5)).count() == 5; release(s); s.stop()")
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_CONF", "PYSPARK_SUBMIT"))}
    env |= {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.pathsep.join(sys.path)}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


@pytest.mark.parametrize("split", ["128m", "40", "7"])
def test_first_lines_are_skipped_in_split_files(spark, tmp_path, split):
    for k in range(4):
        (tmp_path / f"f{k}.csv").write_text("".join(f"'title {k}, line {j}'\n" for j in range(2)) + "'A B','C'\n"
                                            + "".join(f"'{k}','title {k}, line {j}'\n".replace(", ", "-") for j in range(50 * k)))
    (tmp_path / "short.csv").write_text("only one\n")
    (tmp_path / "empty.csv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = readers.read_lines(spark, str(tmp_path), 2)
        assert lines.count() == 4 + 300
        got = readers.read_quoted_csv(spark, str(tmp_path), {"A B": "a", "C": "c"}, ["A B", "C"], skip=2)
        assert sorted(tuple(r) for r in got.collect()) == sorted((str(k), f"title {k}-line {j}") for k in range(4) for j in range(50 * k))
        assert readers.read_lines(spark, str(tmp_path), 10**6).count() == 0
        assert readers.read_lines(spark, str(tmp_path)).count() == 313
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
