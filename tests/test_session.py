"""The shared folder and the coverage of the registered queries."""

import time
from pathlib import Path
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tableflow.queries import REGISTRY
from tableflow.session import materialise, release, shared_folder
from tableflow.sources.tables import Tables


def session(setting, master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting),
                           sparkContext=SimpleNamespace(master=master, applicationId="a-1"))


def test_shared_folder():
    assert shared_folder(session("hdfs:///scratch/", "yarn")) == "hdfs:///scratch"
    assert shared_folder(session("/shared", "local[2]")) == "/shared"
    local = shared_folder(session(None, "local[2]"))
    assert shared_folder(session(None, "local[2]")) == local
    with pytest.raises(RuntimeError):
        shared_folder(session(None, "spark://host:7077"))


def test_materialise_cuts_the_plan(spark):
    once = materialise(spark.range(10).selectExpr("id % 3 AS x").distinct())
    assert "Aggregate" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.x for r in once.collect()) == [0, 1, 2]


def test_shuffle_files_go_with_the_step(spark):
    tracker = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files():
        return sum("shuffle" in str(x) for x in tracker.getAllFiles().mkString(",").split(","))

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name), files()
    step = materialise(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("x")).count())
    for _ in range(50):  # they are deleted in the background
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(name) == setting
    assert step.count() == 7


def test_released_rows_are_gone_from_the_disk(spark):
    kept, gone = materialise(spark.range(1000)), materialise(spark.range(1000))
    folder = Path(urlparse(gone.inputFiles()[0]).path).parent
    before = sum(f.stat().st_size for f in folder.glob("*.parquet"))
    release(gone)
    assert sum(f.stat().st_size for f in folder.glob("*.parquet")) < before / 2
    assert spark.read.parquet(str(folder)).count() == 0 and kept.count() == 1000
    release(materialise(spark.range(0)))


def test_tables_are_opened_by_name(spark):
    tables = Tables(spark, "/root/testdata/sf0.001/")
    assert len(tables) == 7 and tables["region"].count() == 5
    with pytest.raises(KeyError):
        tables["unknown"]


def test_every_survey_row_has_a_query():
    numbers = {"S": 8, "P": 15, "J": 22, "A": 12, "O": 5, "U": 1, "F": 9, "M": 10, "C": 11, "R": 9,
               "L": 6}
    wanted = {f"{letter}{i}" for letter, last in numbers.items() for i in range(1, last + 1)}
    assert {row for query in REGISTRY.values() for row in query.covers} == wanted
