import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyloom.errors import ConfigurationError, NoData
from skyloom.operators import observations as O
from skyloom.plans.retrieval import unite_sources, unite_written
from skyloom.plans.suite_observations import CODES, with_units
from skyloom.plans.views import v_field, v_grid, v_obs, v_stored
from skyloom.sinks import files
from skyloom.sources import assets, gridstore, service_errors


def test_grid_store_is_pruned(spark, folder, tmp_path):
    path = str(tmp_path / "store")
    gridstore.write_store(v_grid(spark, folder), path)
    store = gridstore.open_store(spark, path)
    found = gridstore.scan(store, ["view"], "2024-01-05", "2024-01-06", box=(45, 30, -45, 210))
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "variable" in filters and "valid_date" in filters
    direct = gridstore.scan(v_grid(spark, folder), ["view"], "2024-01-05", "2024-01-06", box=(45, 30, -45, 210))
    assert found.count() == direct.count() > 0


def test_nan_becomes_null_in_the_store(spark, tmp_path):
    cells = spark.createDataFrame([("t", "2020-01-01 00:00:00", 1.0, 2.0, float("nan"))], "variable string, valid_time string, latitude double, longitude double, value double")
    gridstore.write_store(cells.withColumn("valid_time", F.col("valid_time").cast("timestamp_ntz")), str(tmp_path / "s"))
    assert gridstore.open_store(spark, str(tmp_path / "s")).first()["value"] is None


def test_assets_with_different_columns(spark, folder, tmp_path):
    obs = v_obs(spark, folder)
    paths = [str(tmp_path / "a"), str(tmp_path / "b")]
    obs.where("processing_level = 0").drop("processing_level").write.parquet(paths[0])
    obs.where("processing_level = 1").write.parquet(paths[1])
    both = assets.read_assets(spark, paths)
    assert both.where("processing_level IS NULL").count() == obs.where("processing_level = 0").count()
    wanted = O.predicate(both.columns, O.Retrieval(stations=["1", "2"], days=[3]), CODES)
    assert both.where(wanted).count() == obs.where("processing_level <= 1").where(wanted).count()


def test_unknown_filter_column(spark, folder):
    with pytest.raises(ConfigurationError):
        O.predicate(v_obs(spark, folder).columns, O.Retrieval(extra={"nothing": 1}), CODES)


def test_no_observations(spark, folder):
    with pytest.raises(NoData):
        O.require_rows(v_obs(spark, folder).where("false"))


def test_csv_with_header(spark, folder, tmp_path):
    obs = with_units(spark, folder).drop("observed_variable_code").withMetadata("observation_value", {"long_name": "x"})
    path = str(tmp_path / "csv")
    files.write_csv(obs, path, "stations", "network", ["CC-BY", "other"])
    (text,) = [f.read_text() for f in Path(path, "header").glob("part-*")]
    lines = text.strip().split("\n")
    assert lines[0] == lines[-1] == "#" * 88
    assert "# CC-BY" in lines and "# view [K]" in lines and "# signup [m s-1]" in lines
    assert any(line.startswith("# Time extent: 20240101 - 202401") for line in lines)
    assert "# No uncertainty columns available for this dataset." in lines
    body = spark.read.option("header", True).csv(f"{path}/body")
    assert body.count() == obs.count() and body.columns == obs.columns


def test_cubes_by_tag(spark, folder, tmp_path):
    path = str(tmp_path / "cubes")
    files.write_cubes(v_grid(spark, folder).withColumn("tag", F.concat("variable", F.lit("_x"))), path)
    assert {p.name for p in Path(path).glob("tag=*")} == {f"tag={v}_x" for v in ("view", "click", "purchase", "signup", "error")}
    assert spark.read.parquet(path).count() == v_grid(spark, folder).count()


def test_long_table(spark, folder, tmp_path):
    cells = v_grid(spark, folder).withColumnRenamed("valid_time", "time")
    files.write_long_table(cells, str(tmp_path / "t"))
    assert "valid_time" in spark.read.option("header", True).csv(str(tmp_path / "t")).columns


def test_field_folders(spark, folder, tmp_path):
    fields = v_field(spark, folder).select("param", "type", "d").distinct()
    tiered = files.tier_of(fields, v_stored(spark, folder), ["param", "type", "d"])
    named = tiered.select("tier", F.trunc("d", "year").alias("date"), "type", "param", F.lit(None).cast("double").alias("north"))
    cut = named.limit(1).withColumn("north", F.lit(1.0))
    files.write_fields(named.unionByName(cut), str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).count() == fields.count()
    assert {p.name for p in (tmp_path / "f").glob("tier=*")} == {"tier=permanent", "tier=temporary"}


def test_field_path_order(spark):
    df = spark.createDataFrame([("2020-01-01", "24", "m", "o3", "0", "1.5")], "date string, step string, model string, variable string, level string, north string")
    path = files.field_path(df.columns, F.lit("permanent"), suffix="_trial")
    assert df.select(path).first()[0] == "permanent_trial/2020-01-01/model=m_variable=o3_level=0_step=24_north=1.5"


def test_request_order(spark):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("o"))
    assert [r["o"] for r in files.in_request_order(df, ["o"]).collect()] == list(range(100))


def test_columns_and_attributes(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 2.0, 3.0, 4.0, "K")],
        "observation_id int, `latitude|observations_table` double, `latitude|header_table` double, `longitude|header_table` double, `longitude|station_configuration` double, units string",
    )
    renamed = O.plain_coordinates(df)
    assert renamed.columns[1:5] == ["latitude", "latitude|header_table", "longitude|header_table", "longitude|station_configuration"]
    assert O.filter_column(df.columns, "latitude") == "latitude|header_table"
    described = O.with_attributes(renamed, {"units": {"long_name": "unit"}})
    assert described.schema["latitude"].metadata == {"standard_name": "latitude", "units": "degrees_north"}
    assert described.schema["units"].metadata == {"long_name": "unit"}
    assert O.append_history(O.append_history(None, "a"), "b") == "a\nb"


def test_all_sources_failing(spark):
    def broken():
        raise NoData("nothing")

    with pytest.raises(NoData):
        unite_sources({"a": broken, "b": broken})


def test_service_errors(spark):
    rows = [
        (1, "Process error: Failed to execute WPS process [x]: Error: Incorrect dates\n\n now"),
        (2, "unknown string FORMAT"), (2, "unknown string format"),
        (3, "boom"),
    ]
    log = spark.createDataFrame(rows, "request_id int, text string")
    got = {r["request_id"]: (r["verdict"], r["shown"]) for r in service_errors.classify_errors(log, ["request_id"], "text").collect()}
    assert got == {1: ("no data", "Error: Incorrect dates; now"), 2: ("retry", ""), 3: ("retry", "")}


def test_manifest_uses_half_open_coverages(spark, folder):
    extent = assets.manifest(v_obs(spark, folder), ["observed_variable"])
    test = assets.can_hold((dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1)), (-90.0, 90.0), (-180.0, 180.0))
    assert extent.where(test).count() == 0


def test_partial_dates_prune_the_store_too(spark, folder, tmp_path):
    path = str(tmp_path / "store")
    gridstore.write_store(v_grid(spark, folder), path)
    found = gridstore.scan(gridstore.open_store(spark, path), ["click"], "2024-01-30", "2024-01", box=(75, 30, -75, 330))
    assert {r[0].day for r in found.select("valid_date").distinct().collect()} == {30}
    whole = gridstore.scan(gridstore.open_store(spark, path), ["click"], "2024", "2024-01-10", box=(75, 30, -75, 330))
    assert whole.agg(F.max("valid_time")).first()[0] < dt.datetime(2024, 1, 11)


def test_requests_prune_the_folders_of_the_store(spark, folder, tmp_path):
    from skyloom.operators.bulk import answer_from_grid
    from skyloom.plans.suite_bulk import asked

    path, asks = str(tmp_path / "store"), str(tmp_path / "requests")
    gridstore.write_store(v_grid(spark, folder), path)
    asked(spark, folder).write.parquet(asks)
    some = spark.read.parquet(asks).where("request_id < 40")
    answers = answer_from_grid(gridstore.open_store(spark, path), some)
    assert "dynamicpruning" in answers._jdf.queryExecution().executedPlan().toString()
    direct = answer_from_grid(v_grid(spark, folder), some)
    assert answers.count() == direct.count() > 0


def test_coordinates_lie_beside_the_cells(spark, folder, tmp_path):
    from skyloom.operators.grid import select_area

    path = str(tmp_path / "store")
    gridstore.write_store(v_grid(spark, folder), path)
    store, axes = gridstore.open_store(spark, path), gridstore.open_axes(spark, path)
    assert store.count() == v_grid(spark, folder).count() and axes.count() == 12
    known, read = select_area(store, 50, -60, -50, 100, axes), select_area(store, 50, -60, -50, 100)
    assert known.count() == read.count() > 0
    point = spark.createDataFrame([(10.0, 100.0)], "latitude double, longitude double")
    found = gridstore.scan(store, ["view"], "2024", "2024", points=point, axes=axes)
    assert {(r["latitude"], r["longitude"]) for r in found.select("latitude", "longitude").distinct().collect()} == {(15.0, 90.0)}


def test_source_with_a_broken_file_is_left_out_whole(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    spark.range(5).write.parquet(good)
    spark.range(100, 200, numPartitions=3).write.parquet(str(bad))
    file = sorted(bad.glob("part-*.parquet"))[1]
    body = file.read_bytes()
    file.write_bytes(body[:40] + bytes(len(body) - 80) + body[-40:])
    schema = spark.read.parquet(good).schema
    read = lambda path: lambda: spark.read.schema(schema).parquet(path)
    rows, outcomes = unite_written(spark, {"good": read(good), "bad": read(str(bad)), "gone": read(str(tmp_path / "gone"))})
    assert sorted((r["source"], r["id"]) for r in rows.collect()) == [("good", i) for i in range(5)]
    got = {r["source"]: (r["answered"], r["fault"] is None) for r in outcomes.collect()}
    assert got == {"good": (True, True), "bad": (False, False), "gone": (False, False)}
    with pytest.raises(NoData):
        unite_written(spark, {"bad": read(str(bad))})


def test_source_without_rows_answers(spark):
    rows, outcomes = unite_written(spark, {"empty": lambda: spark.range(0), "some": lambda: spark.range(2)})
    assert rows.count() == 2 and outcomes.where("answered").count() == 2
