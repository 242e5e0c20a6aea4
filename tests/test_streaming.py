import datetime as dt

from pyspark.sql import functions as F
import pytest

from skyloom.errors import ConfigurationError
from skyloom.streaming import daily
from skyloom.streaming.embargo import MovingEmbargo, run
from skyloom.tables import table


def test_stream_equals_batch_on_closed_days(spark, folder, tmp_path):
    events = table(spark, folder, "events")
    source = str(tmp_path / "in")
    for part in range(3):  # arrives in three files, in order of time
        first, last = 10 * part + 1, 10 * part + (10 if part < 2 else 31)
        events.where(F.dayofmonth("ts").between(first, last)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    how = ["mean", "min", "max", "std", "sum"]
    days = daily.daily_windows(stream, how, ["event_type"], shift_hours=2)
    daily.write_closed_days(days, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    (still_open,) = events.agg(daily.closed_before(F.col("ts") + F.make_dt_interval(hours=F.lit(2)))).first()
    want = daily.daily_windows(events, how, ["event_type"], shift_hours=2).where(F.col("day") < F.lit(still_open))
    rounded = {h: F.round(h, 6) for h in how}
    as_set = lambda df: {tuple(r) for r in df.withColumns(rounded).collect()}
    assert as_set(got) == as_set(want)
    assert got.count() > 100


def test_median_is_left_to_the_batch_form(spark, folder):
    with pytest.raises(ConfigurationError):
        daily.daily_windows(table(spark, folder, "events"), ["median"], ["event_type"])


def test_moving_embargo_releases_what_it_held(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "name string, d date"
    arrivals = [[("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 8))], [("c", dt.date(2024, 1, 20))], [("d", dt.date(2024, 1, 2))]]
    for rows in arrivals:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    embargo = MovingEmbargo(str(tmp_path / "store"), 5, lambda batch: dt.datetime(2024, 1, 10) + dt.timedelta(days=10 * batch))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    run(stream, embargo, str(tmp_path / "check")).awaitTermination(120)
    released = spark.read.parquet(str(tmp_path / "store" / "released"))
    assert sorted(r["name"] for r in released.collect()) == ["a", "b", "c", "d"]
    assert released.where("d = date'2024-01-08'").first()["batch"] >= 1
    last = embargo.held_after(spark, 2)
    assert last is not None and last.isEmpty()


def test_embargo_batch_can_run_again(spark, tmp_path):
    embargo = MovingEmbargo(str(tmp_path / "store"), 5, lambda batch: dt.datetime(2024, 1, 10))
    arrived = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 8))], "name string, d date")
    embargo(arrived, 0)
    embargo(arrived, 0)
    assert spark.read.parquet(str(tmp_path / "store" / "released")).count() == 1


def test_embargo_that_holds_nothing(spark, tmp_path):
    embargo = MovingEmbargo(str(tmp_path / "store"), 5, lambda batch: dt.datetime(2024, 3, 1))
    arrived = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "name string, d date")
    embargo(arrived, 0)
    embargo(arrived.where("false"), 1)
    assert embargo.held_after(spark, 1).isEmpty()
    assert spark.read.parquet(str(tmp_path / "store" / "released")).count() == 1


def test_embargo_releases_a_field_once(spark, tmp_path):
    embargo = MovingEmbargo(str(tmp_path / "store"), 0, lambda batch: dt.datetime(2024, 1, 1) + dt.timedelta(days=10 * batch))
    schema = "name string, d date"
    for batch in range(4):
        rows = [(f"{batch}-{k}", dt.date(2024, 1, 1) + dt.timedelta(days=7 * k)) for k in range(5)] if batch < 2 else []
        embargo(spark.createDataFrame(rows, schema), batch)
    released = [r["name"] for r in spark.read.parquet(str(tmp_path / "store" / "released")).collect()]
    assert len(released) == len(set(released)) == 10 - embargo.held_after(spark, 3).count()


def test_embargo_lists_only_the_days_it_gives_out(spark, tmp_path, monkeypatch):
    embargo = MovingEmbargo(str(tmp_path / "store"), 2, lambda batch: dt.datetime(2024, 1, 1) + dt.timedelta(days=batch))
    asked, held = [], MovingEmbargo._held
    monkeypatch.setattr(MovingEmbargo, "_held", lambda self, spark, days: asked.append(len(days)) or held(self, spark, days))
    arrivals = []
    for batch in range(9):
        first = dt.date(2024, 1, 1) + dt.timedelta(days=batch)
        rows = [(f"{batch}-{k}", first + dt.timedelta(days=k)) for k in range(-3, 4)]
        arrivals += rows
        embargo(spark.createDataFrame(rows, "name string, d date"), batch)
    assert asked == [1, 2, 3, 4, 5, 5, 5, 5]
    assert spark.read.parquet(str(tmp_path / "store" / "days" / "batch=8")).count() == 15
    released = [r["name"] for r in spark.read.parquet(str(tmp_path / "store" / "released")).collect()]
    still = [r["name"] for r in embargo.held_after(spark, 8).collect()]
    assert sorted(released + still) == sorted(name for name, _ in arrivals)
    limit = dt.date(2024, 1, 7)
    assert sorted(still) == sorted(name for name, day in arrivals if day > limit)


def test_embargo_goes_on_with_a_new_object_and_runs_a_batch_again(spark, tmp_path):
    clock = lambda batch: dt.datetime(2024, 1, 10) + dt.timedelta(days=5 * batch)
    first = spark.createDataFrame([("a", dt.date(2024, 1, 8)), ("b", dt.date(2024, 1, 30)), ("none", None)], "name string, d date")
    nothing = first.where("false")
    MovingEmbargo(str(tmp_path / "store"), 5, clock)(first, 0)
    assert {r["name"] for r in MovingEmbargo(str(tmp_path / "store"), 5, clock).held_after(spark, 0).collect()} == {"a", "b"}
    for _ in range(2):
        MovingEmbargo(str(tmp_path / "store"), 5, clock)(nothing, 1)
    released = spark.read.parquet(str(tmp_path / "store" / "released")).collect()
    assert [(r["name"], r["batch"]) for r in released] == [("a", 1)]
