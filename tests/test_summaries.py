"""Summaries by group, and a merge that a query would miss if it did nothing."""

import datetime as dt

from compare import compare, duck

from skyloom.operators import cubes, observations
from skyloom.plans.suite import ORACLES, QUERIES


def test_summary_by_station(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(days=i), f"s{i % 2}", float(i), float(-i)) for i in range(6)]
    names = ["observation_id", "report_timestamp", "station", "latitude", "longitude"]
    found = observations.extract_summary(spark.createDataFrame(rows, names), by=["station"]).orderBy("station").collect()
    assert [tuple(r) for r in found] == [
        ("s0", 0.0, 4.0, -4.0, 0.0, "20240101", "20240105"),
        ("s1", 1.0, 5.0, -5.0, -1.0, "20240102", "20240106"),
    ]


def test_a_merge_that_does_nothing_is_seen(spark, folder, monkeypatch):
    name = "h5_merge_counts_cubes"
    assert compare(spark, duck(folder), folder, name, QUERIES[name], ORACLES[name])[0]

    def alone(fields, keys, scope=(), barred=()):
        return fields.select(*scope, *keys)

    monkeypatch.setattr(cubes, "merge", alone)
    assert not compare(spark, duck(folder), folder, name, QUERIES[name], ORACLES[name])[0]


def test_the_station_query_runs_the_operator(spark, folder, monkeypatch):
    calls = []
    real = observations.extract_summary
    monkeypatch.setattr(observations, "extract_summary", lambda *a, **b: calls.append(b) or real(*a, **b))
    QUERIES["a14_extract_summary_by_station"](spark, folder)
    assert calls == [{"by": ["primary_station_id"]}]
