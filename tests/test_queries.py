"""Every registered query against its SQL, and rules that hold for all plans."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry_points
from skyloom.plans.suite import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, folder, name):
    ok, note, _ = compare(spark, con, folder, name, QUERIES[name], ORACLES.get(name))
    assert ok, note


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_join_lists_all_pairs(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_points(spark):
    assert entry_points.entry(spark).columns == ["variable", "latitude", "longitude", "day", "value"]
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_survey_ids_are_covered():
    wanted = {
        "s": 9, "k": 7, "p": 20, "f": 21, "j": 10, "h": 13, "a": 16, "w": 7, "t": 4, "d": 10, "g": 5, "v": 17, "x": 2, "u": 4,
    }
    have = {name.split("_")[0] for name in QUERIES}
    missing = [f"{k}{i}" for k, n in wanted.items() for i in range(1, n + 1) if f"{k}{i}" not in have]
    assert missing == []


def test_time_filter_reaches_the_scan(spark, folder):
    plan = QUERIES["f2_half_open_coverages"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_unused_columns_are_not_read(spark, folder):
    plan = QUERIES["a1_daily_mean"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[1]


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", list(ORACLES))
def test_types_agree_with_sql(spark, con, folder, name):
    got = {f.name: TYPES[f.dataType.simpleString()] for f in QUERIES[name](spark, folder).schema}
    assert got == {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLES[name]).fetchall()}
