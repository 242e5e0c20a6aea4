"""Queries on gridded data: scans, selections, reductions and axes."""

import numpy as np
from pyspark.sql import functions as F

from skyloom.operators import grid as G
from skyloom.plans.registry import near, query
from skyloom.plans.views import v_area, v_grid, v_site
from skyloom.sources.gridstore import scan
from skyloom.tables import table

DAY = "yyyy-MM-dd HH:mm"


def shown(df, *extra):
    return df.select(
        "variable",
        F.date_format("valid_time", DAY).alias("valid_time"),
        "latitude",
        "longitude",
        near(F.col("value")).alias("value"),
        *extra,
    )


SHOWN = """variable, strftime(valid_time, '%Y-%m-%d %H:%M') AS valid_time, latitude, longitude, round(value + 1e-9, 6) AS value"""


@query(
    "flagship_daily_mean_in_box",
    """
SELECT variable, latitude, longitude, CAST(valid_time + INTERVAL 5 HOUR AS DATE) AS day, round(avg(value) + 1e-9, 6) AS value
FROM v_grid WHERE variable = 'view' AND latitude BETWEEN -20 AND 50 AND longitude BETWEEN 30 AND 210
 AND valid_time >= TIMESTAMP '2024-01-09' AND valid_time < TIMESTAMP '2024-01-14'
GROUP BY 1, 2, 3, 4 HAVING day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' ORDER BY 1, 2, 3, 4""",
)
def flagship(spark, d):
    cells = G.slice_box(G.slice_time(v_grid(spark, d), "2024-01-09", "2024-01-13"), 50, 30, -20, 210)
    daily = G.daily_reduce(cells.where("variable = 'view'"), "mean", shift_hours=5)
    kept = G.keep_dates(daily, ["2024-01-10", "2024-01-11", "2024-01-12"])
    return kept.withColumn("value", near(F.col("value"))).orderBy("variable", "latitude", "longitude", "day")


@query(
    "s1_grid_store_scan",
    f"""SELECT {SHOWN} FROM v_grid WHERE variable IN ('click', 'view')
 AND valid_time >= TIMESTAMP '2024-01-05' AND valid_time < TIMESTAMP '2024-01-13'
 AND latitude BETWEEN -45 AND 45 AND longitude BETWEEN 30 AND 210""",
)
def s1(spark, d):
    return shown(scan(v_grid(spark, d), ["view", "click"], "2024-01-05", "2024-01-12", box=(45, 30, -45, 210)))


@query(
    "f7_time_slice_partial_dates",
    f"""SELECT {SHOWN} FROM v_grid WHERE valid_time >= TIMESTAMP '2024-01-01' AND valid_time < TIMESTAMP '2024-01-21'""",
)
def f7(spark, d):
    return shown(G.slice_time(v_grid(spark, d), "2024", "2024-01-20"))


@query(
    "f8_box_slice_closed",
    f"SELECT {SHOWN} FROM v_grid WHERE latitude BETWEEN -45 AND 45 AND longitude BETWEEN 90 AND 270",
)
def f8(spark, d):
    return shown(G.slice_box(v_grid(spark, d), 45, 90, -45, 270))


@query(
    "f9_box_with_longitude_wrap",
    f"""SELECT {SHOWN}, CASE WHEN longitude BETWEEN 300 AND 360 THEN 0 ELSE 1 END AS part FROM v_grid
 WHERE latitude BETWEEN -50 AND 50 AND (longitude BETWEEN 300 AND 360 OR longitude BETWEEN 0 AND 100)""",
)
def f9(spark, d):
    return shown(G.select_area(v_grid(spark, d), 50, -60, -50, 100), "part")


@query(
    "f10_upside_down_box",
    f"SELECT {SHOWN} FROM v_grid WHERE latitude BETWEEN -30 AND 60 AND longitude BETWEEN 60 AND 200",
)
def f10(spark, d):
    return shown(G.select_area(v_grid(spark, d), -30, 60, 60, 200))


@query(
    "f11_area_over_many_datasets",
    f"""SELECT {SHOWN}, variable <> 'error' AS cut FROM v_grid
 WHERE variable = 'error' OR (latitude BETWEEN -45 AND 15 AND longitude BETWEEN 90 AND 210)""",
)
def f11(spark, d):
    return shown(G.select_area_of_many(v_grid(spark, d), F.col("variable") != "error", 15, 90, -45, 210), "cut")


@query(
    "f12_exact_box_in_microdegrees",
    """SELECT variable, strftime(valid_time, '%Y-%m-%d %H:%M') AS valid_time, lat_micro, lon_micro, round(value + 1e-9, 6) AS value
FROM (SELECT *, CAST(latitude * 1000000 AS BIGINT) AS lat_micro,
 CASE WHEN longitude >= 180 THEN CAST((longitude - 360) * 1000000 AS BIGINT) ELSE CAST(longitude * 1000000 AS BIGINT) END AS lon_micro
 FROM v_grid) WHERE lat_micro BETWEEN -45000000 AND 45000000 AND lon_micro BETWEEN -90000000 AND 90000000""",
)
def f12(spark, d):
    cells = G.select_box_exactly(v_grid(spark, d), 45, 270, -45, 90)
    return shown(cells, "lat_micro", "lon_micro").drop("latitude", "longitude")


@query(
    "f12_box_completeness",
    """SELECT variable, strftime(valid_time, '%Y-%m-%d %H:%M') AS valid_time, count(*) AS n_cells,
 count(DISTINCT latitude) * count(DISTINCT longitude) AS n_expected,
 count(*) = count(DISTINCT latitude) * count(DISTINCT longitude) AS complete
FROM v_grid WHERE latitude BETWEEN -45 AND 45 AND (longitude <= 90 OR longitude >= 270) GROUP BY 1, 2""",
)
def f12_complete(spark, d):
    cells = G.select_box_exactly(v_grid(spark, d), 45, 270, -45, 90)
    return G.box_completeness(cells, ["variable", "valid_time"]).withColumn(
        "valid_time", F.date_format("valid_time", DAY)
    )


@query(
    "f13_drop_partial_periods",
    """SELECT variable, latitude, longitude, CAST(valid_time AS DATE) AS day, round(max(value) + 1e-9, 6) AS value FROM v_grid
WHERE CAST(valid_time AS DATE) IN (DATE '2024-01-03', DATE '2024-01-05', DATE '2024-01-20') GROUP BY 1, 2, 3, 4""",
)
def f13(spark, d):
    daily = G.daily_reduce(v_grid(spark, d), "max")
    return G.keep_dates(daily, ["2024-01-03", "2024-01-05", "2024-01-20"]).withColumn("value", near(F.col("value")))


@query(
    "j3_nearest_points",
    """
WITH lat AS (SELECT DISTINCT latitude AS x FROM v_grid), lon AS (SELECT DISTINCT longitude AS x FROM v_grid),
near AS (SELECT site_id, (SELECT x FROM lat ORDER BY abs(x - s.latitude), x DESC LIMIT 1) AS latitude,
 (SELECT x FROM lon ORDER BY abs(x - s.longitude), x DESC LIMIT 1) AS longitude FROM v_site s)
SELECT site_id, latitude, longitude, variable, count(*) AS n_times, round(sum(value), 4) AS total
FROM near JOIN v_grid USING (latitude, longitude) GROUP BY 1, 2, 3, 4""",
)
def j3(spark, d):
    points = v_site(spark, d).select("site_id", "latitude", "longitude")
    found = G.select_nearest(v_grid(spark, d), points)
    return found.groupBy("site_id", "latitude", "longitude", "variable").agg(
        F.count(F.lit(1)).alias("n_times"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    "j3_nearest_area_centre",
    """
WITH centre AS (SELECT request_id, (north + south) / 2 AS lat, (west + east) / 2 AS lon FROM v_area),
ax AS (SELECT DISTINCT latitude AS x FROM v_grid)
SELECT request_id, round(lat + 1e-9, 6) AS latitude, (SELECT x FROM ax ORDER BY abs(x - lat), x DESC LIMIT 1) AS near_lat FROM centre""",
)
def j3_areas(spark, d):
    centre = v_area(spark, d).select("request_id", ((F.col("north") + F.col("south")) / 2).alias("latitude"))
    located = G.nearest_points(v_grid(spark, d), centre, "latitude", "near_lat")
    return located.select("request_id", near(F.col("latitude")).alias("latitude"), "near_lat")


@query(
    "j3_nearest_on_fine_axis",
    """
WITH axis AS (SELECT DISTINCT CAST(o_orderkey * 37 % 36000 AS DOUBLE) / 100 - 180 AS x FROM orders),
p AS (SELECT l_orderkey, CAST((l_partkey * 7919 + l_suppkey * 31 + l_linenumber) % 370000 AS DOUBLE) / 1000 - 185 AS longitude FROM lineitem),
near AS (SELECT l_orderkey, longitude, low.x AS low, high.x AS high FROM p ASOF LEFT JOIN axis low ON p.longitude >= low.x
 ASOF LEFT JOIN axis high ON p.longitude <= high.x)
SELECT CASE WHEN low IS NULL OR longitude >= (low + high) / 2 THEN high ELSE low END AS near_lon, count(*) AS n_points,
 CAST(sum(l_orderkey) AS BIGINT) AS orders, min(longitude) AS first_lon, max(longitude) AS last_lon FROM near GROUP BY 1""",
)
def j3_fine(spark, d):
    def degrees(number, per_degree, first):
        return number.cast("double") / per_degree - first

    cells = table(spark, d, "orders").select(degrees(F.col("o_orderkey") * 37 % 36000, 100, 180).alias("longitude"))
    place = (F.col("l_partkey") * 7919 + F.col("l_suppkey") * 31 + F.col("l_linenumber")) % 370000
    points = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", degrees(place, 1000, 185).alias("longitude"))
    located = G.nearest_points(cells, points, "longitude", "near_lon")
    return located.groupBy("near_lon").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.sum("l_orderkey").alias("orders"),
        F.min("longitude").alias("first_lon"),
        F.max("longitude").alias("last_lon"),
    )


@query(
    "j10_fields_to_model_grids",
    """
WITH grids(name, s, e) AS (VALUES ('coarse', DATE '1990-01-01', DATE '1997-12-31'), ('middle', DATE '1998-01-01', DATE '1999-06-30'),
 ('fine', DATE '1999-07-01', DATE '2030-12-31')),
hit AS (SELECT request_id, d, name FROM v_field JOIN grids ON d BETWEEN s AND e)
SELECT request_id, name AS grid, count(DISTINCT d) AS n_days,
 (SELECT count(DISTINCT h.name) FROM hit h WHERE h.request_id = hit.request_id) > 1 AS too_many_grids
FROM hit GROUP BY request_id, name""",
)
def j10(spark, d):
    from skyloom.plans.views import v_field

    grids = [
        {"name": "coarse", "start": "1990-01-01", "end": "1997-12-31"},
        {"name": "middle", "start": "1998-01-01", "end": "1999-06-30"},
        {"name": "fine", "start": "1999-07-01", "end": "2030-12-31"},
    ]
    days = v_field(spark, d).select("request_id", "d").distinct()
    hits = days.withColumn("grid", F.explode(G.grids_at(F.col("d"), grids)))
    per_grid = hits.groupBy("request_id", "grid").agg(F.count(F.lit(1)).alias("n_days"))
    n_grids = per_grid.groupBy("request_id").agg((F.count(F.lit(1)) > 1).alias("too_many_grids"))
    return per_grid.join(n_grids, "request_id")


def _reduced(spark, d, how, period):
    reduce = G.daily_reduce if period == "day" else G.monthly_reduce
    data = table(spark, d, "events")
    return reduce(data, how, by=["event_type"], time="ts").withColumn("value", near(F.col("value")))


SQL_HOW = {"mean": "avg", "median": "median", "min": "min", "max": "max", "std": "stddev_pop", "sum": "sum"}

for _how, _fn in SQL_HOW.items():
    query(
        f"a1_daily_{_how}",
        f"SELECT event_type, CAST(ts AS DATE) AS day, round({_fn}(value) + 1e-9, 6) AS value FROM events GROUP BY 1, 2",
    )(lambda spark, d, how=_how: _reduced(spark, d, how, "day"))
    if _how != "sum":
        query(
            f"a2_monthly_{_how}",
            f"SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS month, round({_fn}(value) + 1e-9, 6) AS value FROM events GROUP BY 1, 2",
        )(lambda spark, d, how=_how: _reduced(spark, d, how, "month"))


@query(
    "a1_daily_median_ranked",
    "SELECT variable, latitude, CAST(valid_time AS DATE) AS day, round(median(value) + 1e-9, 6) AS value FROM v_grid GROUP BY 1, 2, 3",
)
def a1_ranked(spark, d):
    cells = v_grid(spark, d).withColumn("day", F.to_date("valid_time"))
    return G.exact_median(cells, ["variable", "latitude", "day"], "value").withColumn("value", near(F.col("value")))


@query(
    "a1_daily_median_mostly_zero",
    """SELECT variable, CAST(valid_time AS DATE) AS day, round(median(CASE WHEN longitude = 150 THEN value ELSE 0 END) + 1e-9, 6) AS value
FROM v_grid GROUP BY 1, 2""",
)
def a1_mostly_zero(spark, d):
    rain = v_grid(spark, d).withColumn("value", F.when(F.col("longitude") == 150, F.col("value")).otherwise(0.0))
    return G.daily_reduce(rain, "median", ["variable"]).withColumn("value", near(F.col("value"))).select("variable", "day", "value")


@query(
    "a1_daily_mean_per_cell_shifted",
    """SELECT variable, latitude, longitude, CAST(valid_time - INTERVAL 3 HOUR AS DATE) AS day, round(avg(value) + 1e-9, 6) AS value
FROM v_grid GROUP BY 1, 2, 3, 4""",
)
def a1_shifted(spark, d):
    return G.daily_reduce(v_grid(spark, d), "mean", shift_hours=-3).withColumn("value", near(F.col("value")))


@query(
    "a3_daily_statistics_for_utc_offset",
    """
WITH shifted AS (SELECT variable, value, valid_time, CASE WHEN variable IN ('purchase', 'signup') THEN 2 ELSE 5 END AS shift FROM v_grid
 WHERE valid_time >= TIMESTAMP '2024-01-04' AND valid_time < TIMESTAMP '2024-01-22')
SELECT variable, CAST(valid_time + to_hours(shift) AS DATE) AS day, round(avg(value) + 1e-9, 6) AS value
FROM shifted WHERE (hour(valid_time) - shift % 3 + 24) % 3 = 0 GROUP BY 1, 2
HAVING day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)
def a3(spark, d):
    return G.daily_statistics(
        v_grid(spark, d),
        "daily_mean",
        [f"2024-01-{k:02d}" for k in range(5, 21)],
        utc_offset=5,
        every_hours=3,
        accumulation_hours=3,
        accumulated=["purchase"],
        mean_rates=["signup"],
        by=["variable"],
    ).withColumn("value", near(F.col("value")))


@query(
    "f15_variable_statistic_compatibility",
    """SELECT observed_variable, CASE WHEN observed_variable = 'purchase' THEN 'accumulated' WHEN observed_variable = 'signup' THEN 'mean'
 ELSE 'instant' END AS kind, CASE WHEN observed_variable = 'purchase' THEN '' ELSE 'daily sum is not available for this variable' END AS skipped,
 count(*) AS n FROM v_obs GROUP BY 1""",
)
def f15(spark, d):
    from skyloom.plans.views import v_obs

    kind = G.variable_class(F.col("observed_variable"), ["purchase"], ["signup"])
    obs = v_obs(spark, d).withColumn("kind", kind)
    reason = F.coalesce(G.incompatible_statistic(F.col("kind"), "daily_sum"), F.lit(""))
    return obs.groupBy("observed_variable", "kind", reason.alias("skipped")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "w7_axis_spacing",
    """
WITH axes AS (SELECT DISTINCT 'latitude' AS dimension, latitude AS x FROM v_grid UNION SELECT DISTINCT 'longitude', longitude FROM v_grid),
steps AS (SELECT dimension, x, x - lag(x) OVER (PARTITION BY dimension ORDER BY x) AS step FROM axes)
SELECT dimension, min(x) AS first, max(x) AS last, arg_min(step, x) FILTER (step IS NOT NULL) AS step,
 min(x) - 0.5 * (arg_min(step, x) FILTER (step IS NOT NULL)) AS padded_first,
 max(x) + 0.5 * (arg_min(step, x) FILTER (step IS NOT NULL)) AS padded_last, count(DISTINCT step) AS n_steps
FROM steps GROUP BY dimension""",
)
def w7(spark, d):
    cells = v_grid(spark, d)
    return G.axis_spacing(cells, "latitude").withColumn("dimension", F.lit("latitude")).unionByName(
        G.axis_spacing(cells, "longitude").withColumn("dimension", F.lit("longitude"))
    )


@query(
    "p8_scalar_coordinate_to_dimension",
    f"SELECT {SHOWN}, 0 AS number, 'surface' AS level FROM v_grid",
)
def p8(spark, d):
    from skyloom.operators.requests import expand_dimensions

    wide = expand_dimensions(v_grid(spark, d), {"number": 0, "level": "surface"}, ["variable", "number", "level", "valid_time"])
    return shown(wide, "number", "level")


ROOT_MEAN_SQUARE = G.DecomposableReducer(
    names=("squares", "count"),
    piece=lambda s: {"squares": float((s * s).sum()), "count": float(len(s))},
    merge=lambda f: {"squares": f["squares"].sum(), "count": f["count"].sum()},
    finish=lambda f: np.sqrt(f["squares"] / f["count"]),
)


@query(
    "u1_custom_reducer",
    """SELECT event_type, CAST(ts AS DATE) AS day, round(sqrt(sum(value * value) / count(*)), 4) AS value
FROM events WHERE NOT isnan(value) GROUP BY 1, 2""",
)
def u1(spark, d):
    data = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return G.custom_reduce(data, ROOT_MEAN_SQUARE, ["event_type", "day"]).withColumn("value", F.round("value", 4))
