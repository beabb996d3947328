"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "strataloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and benches. On a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_own: dict[str, str] = {}  # folders of applications on one machine that set none
_jobs: list[str] = []  # folders of the open jobs, innermost last


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate tables: `spark.checkpoint.dir` of the session.

    Only an application on one machine that sets none gets a fresh folder there, which ends with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master, app = spark.sparkContext.master, spark.sparkContext.applicationId
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="strataloom-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        folder = _own[app]
    return folder.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/strataloom-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back.

    For a result that several later steps use: the work before it is done once, survives the loss
    of executors, and later steps prune its columns and know its size. The end of a `job`, or
    `release`, removes the tables.
    """
    path = f"{_jobs[-1] if _jobs else own_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """The owner of the tables that are written inside: they are removed at its end.

    Write or collect results before that; what is still lazy can't be read afterwards.
    """
    folder = f"{own_folder(spark)}/job-{uuid.uuid4().hex}"
    _jobs.append(folder)
    try:
        yield
    finally:
        _jobs.remove(folder)
        _delete(spark, folder)


def release(spark: SparkSession) -> None:
    """Remove all tables that this application has written in between; results built on them end with them."""
    _delete(spark, own_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)  # Spark's Python interface can't remove files
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
