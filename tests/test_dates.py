import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyloom.functions import dates as D
from skyloom.functions import text as X
from skyloom.operators import requests as R
from skyloom.operators import windows as W

DAY = dt.date


def values(spark, texts, make, type_="string"):
    df = spark.createDataFrame([(t,) for t in texts], f"x {type_}")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_clock_text(spark):
    texts = ["12:00", "1200", "6", "06", "6:30", "23:59:59", "235959", "24", "12:60", "1:2", "abc"]
    want = [43200, 43200, 21600, 21600, 23400, 86399, 86399, None, None, None, None]
    assert values(spark, texts, D.clock_seconds) == want


def test_date_parsing(spark):
    texts = ["2020-02-29", "20200229", "2021-02-29", "2020-2-9", "20210230", "x"]
    assert values(spark, texts, D.parse_date) == [DAY(2020, 2, 29), DAY(2020, 2, 29), None, DAY(2020, 2, 9), None, None]


def test_ranges(spark):
    got = values(spark, ["2020-01-05/2020-01-07", "20200105;20200107", "2020-01-05", "2020-01-07/2020-01-05"], D.range_struct)
    assert [None if r is None else (r["start"].day, r["end"].day) for r in got] == [(5, 7), (5, 7), (5, 5), None]


def test_empty_range_when_start_is_after_end(spark):
    row = spark.range(1).select(
        D.date_range(F.lit("2020-01-03").cast("date"), F.lit("2020-01-01").cast("date")).alias("a"),
        D.date_range(F.lit("2011-01-01").cast("date"), F.lit("2011-01-05").cast("date"), 2).alias("b"),
    ).first()
    assert row["a"] == []
    assert row["b"] == [DAY(2011, 1, 1), DAY(2011, 1, 3), DAY(2011, 1, 5)]


def test_julian_days(spark):
    row = spark.range(1).select(
        D.julian_day(F.lit("2000-01-01").cast("date")), D.date_from_julian_day(F.lit(2451545)),
        D.rolled_over_date(F.lit(20210230)), D.date_from_compact_integer(F.lit(20210230)),
    ).first()
    assert tuple(row) == (2451545, DAY(2000, 1, 1), DAY(2021, 3, 2), None)


def test_relative_dates(spark):
    as_of = F.lit("2024-03-10 13:00:00").cast("timestamp_ntz")
    got = values(spark, ["current", "current-30", "current+0.5", " current-0.6", "2020-01-01"], lambda c: D.current_date_text(c, as_of))
    assert got == [DAY(2024, 3, 10), DAY(2024, 2, 9), DAY(2024, 3, 11), DAY(2024, 3, 9), None]
    low, high = D.relative_range("current-30/current", as_of)
    assert tuple(spark.range(1).select(low, high).first()) == (DAY(2024, 2, 9), DAY(2024, 3, 10))


def test_months_back(spark):
    dates = [DAY(2024, 3, 31), DAY(2023, 3, 31), DAY(2024, 1, 15)]
    assert values(spark, dates, lambda c: D.months_back_in_days(c, 1), "date") == [31, 31, 31]
    assert values(spark, dates[:1], lambda c: D.months_back_in_days(c, 12), "date") == [366]
    with pytest.raises(ValueError):
        D.months_back_in_days(F.col("x"), 13)


def test_utc_offsets_and_hours(spark):
    assert values(spark, ["UTC+05:30", "utc-03:00", "+00:00"], D.utc_offset_hours) == [5, -3, 0]
    assert D.sampling_hours(5, 3) == [2, 5, 8, 11, 14, 17, 20, 23]
    assert D.sampling_hours(-1, 6) == [5, 11, 17, 23]
    assert D.sampling_hours(2, 5) == [2, 7, 12, 17, 22]


def test_partial_dates(spark):
    times = ["2000-01-01 00:00:00", "2000-12-31 23:59:59", "2001-01-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz"))
    for start, end, n in [("2000", "2000", 2), ("2000-12", "2000-12-31", 1), ("2000-01-02", "2001-01", 2)]:
        low, after = D.partial_date_bounds(start, end)
        assert df.where((F.col("t") >= low) & (F.col("t") < after)).count() == n


def test_dates_from_parts(spark):
    df = spark.createDataFrame([(1, [2021], [2, 3], [28, 29, 30, 31])], "request_id int, year array<int>, month array<int>, day array<int>")
    got = sorted(r["d"] for r in R.dates_from_parts(df, ["request_id"]).collect())
    assert got == [DAY(2021, 2, 28)] + [DAY(2021, 3, d) for d in (28, 29, 30, 31)]


def test_reformat(spark):
    assert values(spark, ["20200105/2020-01-07", "current-1/2020-01-07"], lambda c: D.reformat_date(c, "yyyyMMdd")) == [
        "20200105/20200107", "current-1/20200107",
    ]
    assert values(spark, ["2020-01-05", "2020-01-05/2020-01-06"], D.to_interval) == ["2020-01-05/2020-01-05", "2020-01-05/2020-01-06"]


def test_text_checks(spark):
    texts = ["1", "-1.5e3", "x", "", "1_000", "nan", "inf"]
    assert values(spark, texts, X.is_numeric) == [True, True, False, False, True, True, True]
    assert values(spark, texts, X.is_positive_numeric) == [True, False, False, False, True, False, True]
    ranges = ["2020-01-01", "2020-01-01/2020-01-02", "2020-01-02/2020-01-01", "2020-01-01/", "20200101"]
    assert values(spark, ranges, X.is_date_or_range) == [True, True, False, False, False]
    assert values(spark, ["Yes", "OFF", "2"], X.truth) == [True, False, None]
    assert values(spark, ["a/b.nc", "a.d/b", "x.tar.gz"], X.extension) == ["nc", "unknown", "gz"]


def test_consecutive_in_order(spark):
    lists = [[DAY(2020, 1, 1), DAY(2020, 1, 2)], [DAY(2020, 1, 2), DAY(2020, 1, 1)], [DAY(2020, 1, 1)]]
    assert values(spark, lists, W.consecutive_in_order, "array<date>") == [True, False, True]


def test_embargo(spark):
    df = spark.createDataFrame(
        [
            (1, [DAY(2025, 3, 1), DAY(2025, 3, 2)], ["00:00", "12:00"]),
            (2, [DAY(2025, 3, 1)], ["00:00"]),
            (3, [DAY(2025, 3, 3)], ["00:00"]),
        ],
        "request_id int, d array<date>, time array<string>",
    )
    as_of = F.lit("2025-03-02 16:00:00").cast("timestamp_ntz")
    got = sorted(tuple(r) for r in R.embargo(df, as_of, hours=6).select("request_id", "piece", "d", "time", "cacheable").collect())
    assert got == [
        (1, "before", [DAY(2025, 3, 1)], ["00:00", "12:00"], False),
        (1, "limit", [DAY(2025, 3, 2)], ["00:00"], False),
        (2, "before", [DAY(2025, 3, 1)], ["00:00"], True),
    ]
    whole = sorted(tuple(r) for r in R.embargo(df, as_of, hours=6, filter_times=False).select("request_id", "d", "cacheable").collect())
    assert whole == [(1, [DAY(2025, 3, 1), DAY(2025, 3, 2)], True), (2, [DAY(2025, 3, 1)], True)]


def test_range_embargo(spark):
    df = spark.createDataFrame(
        [(1, DAY(2020, 1, 1), DAY(2020, 3, 1)), (2, DAY(2020, 3, 1), DAY(2020, 3, 2)), (3, DAY(2020, 1, 5), None)],
        "request_id int, start date, end date",
    )
    got = R.clip_range_to_embargo(df, "start", "end", F.lit("2020-02-01").cast("date")).orderBy("request_id").collect()
    assert [(r["end"], r["clipped"], r["rejected"]) for r in got] == [
        (DAY(2020, 2, 1), True, False), (DAY(2020, 3, 2), False, True), (DAY(2020, 1, 5), False, False),
    ]


def test_days_do_not_depend_on_the_session_zone(spark):
    from skyloom.streaming.daily import daily_windows

    times = ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 23:59:59", "2024-03-11 00:00:00"]
    rows = spark.createDataFrame([(t, 1.0) for t in times], "t string, value double")
    rows = rows.select(F.col("t").cast("timestamp_ntz").alias("ts"), "value", F.lit("a").alias("k"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = []
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            days = daily_windows(rows, ["sum"], ["k"])
            axis = W.validity_axis(rows.withColumn("step", F.lit(1)), ["k"], "ts", "step")
            hours = sorted(r["reference_hours"] for r in axis.collect())
            found.append((sorted((r["day"], r["sum"]) for r in days.collect()), hours))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == ([(DAY(2024, 3, 10), 3.0), (DAY(2024, 3, 11), 1.0)], [0, 1, 22, 22])
    assert found[1] == found[0] and found[2] == found[0]
