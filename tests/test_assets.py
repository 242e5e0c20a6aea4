"""The store of asset files: which files a retrieval opens, and that it loses nothing."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyloom.operators.observations import Retrieval
from skyloom.sources import assets as A

CODES = {"wind": 1, "rain": 2}
SCHEMA = (
    "observation_id long, report_timestamp timestamp_ntz, primary_station_id string, observed_variable_code int, "
    "latitude double, longitude double"
)


def some_rows(seed, n, first):
    rng = random.Random(seed)
    start = datetime(2020, 1, 1)
    return [
        (first + i, start + timedelta(hours=rng.randint(0, 24 * 60)), f"st{rng.randint(0, 400)}", rng.choice([1, 2]), rng.uniform(-80, 80), rng.uniform(-170, 170))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('assets')}/store"
    rows = some_rows(1, 3000, 0)
    A.append_assets(spark.createDataFrame(rows, SCHEMA), path, ["observed_variable_code"], 24)
    return path, rows


def plain(rows, wanted):
    def fits(r):
        return (
            (wanted.time is None or wanted.time[0] <= r[1] < wanted.time[1])
            and (wanted.stations is None or r[2] in wanted.stations)
            and (wanted.variables is None or r[3] in {CODES.get(v) for v in wanted.variables})
            and (wanted.latitude is None or wanted.latitude[0] <= r[4] < wanted.latitude[1])
        )

    return {r[0] for r in rows if fits(r)}


DAYS = (datetime(2020, 1, 20), datetime(2020, 1, 23))
WANTED = [
    Retrieval(),
    Retrieval(time=DAYS),
    Retrieval(time=DAYS, variables=["rain"], latitude=(-10.0, 20.0)),
    Retrieval(variables=["wind", "unheard of"]),
    Retrieval(stations=["st7", "st1000"]),
    Retrieval(time=(datetime(2030, 1, 1), datetime(2031, 1, 1))),
]


@pytest.mark.parametrize("wanted", WANTED)
def test_pruning_loses_nothing(spark, store, wanted):
    path, rows = store
    got = {r.observation_id for r in A.read_pruned(spark, path, wanted, CODES).select("observation_id").collect()}
    assert got == plain(rows, wanted)


def test_few_files_are_opened(spark, store):
    path, _ = store
    every = spark.read.schema(A.EXTENTS).parquet(f"{path}/manifest").count()
    days = A.read_pruned(spark, path, Retrieval(time=DAYS), CODES)
    one = A.read_pruned(spark, path, Retrieval(time=DAYS, variables=["rain"]), CODES)
    assert every > 20
    assert len(days.inputFiles()) <= every / 4
    assert 0 < len(one.inputFiles()) < len(days.inputFiles())
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_new_files_and_columns_are_seen(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    A.append_assets(spark.createDataFrame(some_rows(2, 200, 0), SCHEMA), path, ["observed_variable_code"], 4)
    later = spark.createDataFrame(some_rows(3, 100, 1000), SCHEMA).withColumn("quality", F.lit(3))
    A.append_assets(later, path, ["observed_variable_code"], 4)
    found = A.read_pruned(spark, path, Retrieval(), CODES)
    counts = {r.quality: r.n for r in found.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {None: 200, 3: 100}


def test_rows_without_a_manifest_are_not_seen(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    A.append_assets(spark.createDataFrame(some_rows(4, 50, 0), SCHEMA), path, ["observed_variable_code"], 2)
    spark.createDataFrame(some_rows(5, 50, 100), SCHEMA).write.parquet(f"{path}/rows/unfinished")
    assert A.read_pruned(spark, path, Retrieval(), CODES).count() == 50
