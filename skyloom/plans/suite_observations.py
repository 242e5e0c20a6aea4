"""Queries on point observations: filters, columns, codes, summaries and assets."""

from datetime import datetime

from pyspark.sql import functions as F

from skyloom.functions import dates as D
from skyloom.operators import observations as O
from skyloom.operators import windows as W
from skyloom.plans.registry import near, query
from skyloom.plans.views import VARIABLE_CODES, v_obs
from skyloom.sources import assets as A
from skyloom.tables import table

MOMENT = "yyyy-MM-dd HH:mm:ss"
CODES = {**VARIABLE_CODES, "error": 5}
ROW = """observation_id, strftime(report_timestamp, '%Y-%m-%d %H:%M:%S') AS report_timestamp, primary_station_id,
 observed_variable, observation_value, latitude, longitude"""


def row(df, *more):
    return df.select(
        "observation_id",
        F.date_format("report_timestamp", MOMENT).alias("report_timestamp"),
        "primary_station_id",
        "observed_variable",
        "observation_value",
        "latitude",
        "longitude",
        *more,
    )


def filtered(spark, d, **wanted):
    obs = v_obs(spark, d)
    return row(obs.where(O.predicate(obs.columns, O.Retrieval(**wanted), CODES)))


@query(
    "s2_scan_many_assets",
    f"""SELECT {ROW}, CASE WHEN observed_variable IN ('view', 'click') THEN -1 ELSE processing_level END AS processing_level FROM v_obs
WHERE primary_station_id IN ('3', '8', '21', '46') AND report_timestamp >= TIMESTAMP '2024-01-05'
 AND report_timestamp < TIMESTAMP '2024-01-25' AND latitude >= -60 AND latitude < 60""",
)
def s2(spark, d):
    obs = v_obs(spark, d)
    old = obs.where("observed_variable IN ('view', 'click')").drop("processing_level")
    new = obs.where("observed_variable NOT IN ('view', 'click')")
    wanted = O.Retrieval(
        stations=["3", "8", "21", "46"], time=(datetime(2024, 1, 5), datetime(2024, 1, 25)), latitude=(-60.0, 60.0)
    )
    found = O.retrieve([old, new], wanted, CODES)
    level = F.coalesce("processing_level", F.lit(-1)).alias("processing_level")
    return row(found.withColumn("_level", level), F.col("_level").alias("processing_level"))


@query(
    "s3_prune_assets",
    """SELECT observed_variable, CAST(report_timestamp AS DATE) AS day, count(*) AS n_rows FROM v_obs GROUP BY 1, 2
HAVING min(report_timestamp) < TIMESTAMP '2024-01-12 06:00:00' AND max(report_timestamp) >= TIMESTAMP '2024-01-04 12:00:00'
 AND min(latitude) < 0 AND max(latitude) >= -30 AND min(longitude) < 60 AND max(longitude) >= -60""",
)
def s3(spark, d):
    assets = A.manifest(v_obs(spark, d).withColumn("day", F.to_date("report_timestamp")), ["observed_variable", "day"])
    test = A.can_hold((datetime(2024, 1, 4, 12), datetime(2024, 1, 12, 6)), (-30.0, 0.0), (-60.0, 60.0))
    return assets.where(test).select("observed_variable", "day", "n_rows")


def stored_assets(spark, d):
    """A store of two kinds of assets, of which the older ones have no processing level."""
    from skyloom.session import scratch

    obs, store = v_obs(spark, d), scratch(spark, "assets")
    old = obs.where("observed_variable IN ('view', 'click')").drop("processing_level")
    new = obs.where("observed_variable NOT IN ('view', 'click')")
    for part in (old, new):
        A.append_assets(part, store, ["observed_variable"], 16)
    return store


@query(
    "s2_one_scan_of_many_assets",
    f"""SELECT {ROW}, CASE WHEN observed_variable IN ('view', 'click') THEN -1 ELSE processing_level END AS processing_level FROM v_obs
WHERE primary_station_id IN ('3', '8', '21', '46') AND latitude >= -60 AND latitude < 60""",
)
def s2_store(spark, d):
    wanted = O.Retrieval(stations=["3", "8", "21", "46"], latitude=(-60.0, 60.0))
    found = A.read_pruned(spark, stored_assets(spark, d), wanted, CODES)
    level = F.coalesce("processing_level", F.lit(-1)).alias("processing_level")
    return row(found.withColumn("_level", level), F.col("_level").alias("processing_level"))


@query(
    "s3_pruned_read",
    f"""SELECT {ROW} FROM v_obs WHERE observed_variable IN ('click', 'purchase') AND report_timestamp >= TIMESTAMP '2024-01-05'
 AND report_timestamp < TIMESTAMP '2024-01-08' AND longitude >= -100 AND longitude < 98""",
)
def s3_read(spark, d):
    wanted = O.Retrieval(
        variables=["click", "purchase"], time=(datetime(2024, 1, 5), datetime(2024, 1, 8)), longitude=(-100.0, 98.0)
    )
    return row(A.read_pruned(spark, stored_assets(spark, d), wanted, CODES))


@query("f1_station_membership", f"SELECT {ROW} FROM v_obs WHERE primary_station_id IN ('3', '8', '21', '46', '130')")
def f1(spark, d):
    return filtered(spark, d, stations=["3", "8", "21", "46", "130"])


@query(
    "f2_half_open_coverages",
    f"""SELECT {ROW} FROM v_obs WHERE report_timestamp >= TIMESTAMP '2024-01-03' AND report_timestamp < TIMESTAMP '2024-01-17 12:00:00'
 AND longitude >= -100 AND longitude < 98 AND latitude >= -69 AND latitude < 43""",
)
def f2(spark, d):
    return filtered(
        spark, d, time=(datetime(2024, 1, 3), datetime(2024, 1, 17, 12)), longitude=(-100.0, 98.0), latitude=(-69.0, 43.0)
    )


@query("f3_day_of_month", f"SELECT {ROW} FROM v_obs WHERE day(report_timestamp) IN (1, 7, 15, 29)")
def f3(spark, d):
    return filtered(spark, d, days=[1, 7, 15, 29])


@query("f4_variables_by_label", f"SELECT {ROW} FROM v_obs WHERE observed_variable IN ('click', 'signup')")
def f4(spark, d):
    return filtered(spark, d, variables=["click", "signup", "no_such_variable"])


@query("f5_extra_filters", f"SELECT {ROW} FROM v_obs WHERE processing_level IN (0, 2) AND observed_variable = 'view'")
def f5(spark, d):
    return filtered(spark, d, extra={"processing_level": [0, 2], "observed_variable": "view"})


@query(
    "f6_all_filters_together",
    f"""SELECT {ROW} FROM v_obs WHERE CAST(primary_station_id AS INTEGER) BETWEEN 0 AND 79
 AND report_timestamp >= TIMESTAMP '2024-01-02' AND report_timestamp < TIMESTAMP '2024-01-28'
 AND longitude >= -150 AND longitude < 150 AND day(report_timestamp) IN (3, 4, 5, 10, 20) AND observed_variable IN ('click', 'view')
 AND processing_level = 1""",
)
def f6(spark, d):
    return filtered(
        spark,
        d,
        stations=[str(i) for i in range(80)],
        time=(datetime(2024, 1, 2), datetime(2024, 1, 28)),
        longitude=(-150.0, 150.0),
        days=[3, 4, 5, 10, 20],
        variables=["click", "view"],
        extra={"processing_level": 1},
    )


def with_tables(spark, d):
    """Coordinates as they come from several tables of the data model."""
    obs = v_obs(spark, d)
    return obs.select(
        "observation_id",
        "report_timestamp",
        "observation_value",
        F.lit("K").alias("units"),
        "processing_level",
        F.when(F.col("processing_level") == 0, F.col("latitude")).alias("latitude|observations_table"),
        F.when(F.col("processing_level") <= 1, F.col("latitude") + 0.5).alias("latitude|header_table"),
        (F.col("latitude") + 1.0).alias("latitude|station_configuration"),
        F.col("longitude").alias("longitude|header_table"),
    )


@query(
    "p10_lite_columns",
    """SELECT observation_id, observation_value, coalesce(CASE WHEN processing_level = 0 THEN latitude END, -999) AS lat_obs,
 coalesce(CASE WHEN processing_level <= 1 THEN latitude + 0.5 END, -999) AS lat_header, latitude + 1.0 AS lat_station FROM v_obs""",
)
def p10(spark, d):
    lite = O.lite_columns(
        with_tables(spark, d), ["observation_id", "observation_value", "units"], ["latitude"], disabled=["units"]
    )
    names = ["observation_id", "observation_value", "lat_obs", "lat_header", "lat_station"]
    return lite.toDF(*names).na.fill(-999.0, ["lat_obs", "lat_header"])


@query(
    "p11_coordinate_source",
    """SELECT observation_id, coalesce(CASE WHEN processing_level = 0 THEN latitude END, -999) AS latitude, longitude,
 CASE processing_level WHEN 0 THEN latitude WHEN 1 THEN latitude + 0.5 ELSE latitude + 1.0 END AS best_latitude FROM v_obs""",
)
def p11(spark, d):
    full = with_tables(spark, d)
    best = O.first_known("latitude|observations_table", "latitude|header_table", "latitude|station_configuration")
    renamed = O.plain_coordinates(full.withColumn("best_latitude", best))
    return renamed.select(
        "observation_id", F.coalesce("latitude", F.lit(-999.0)).alias("latitude"), "longitude", "best_latitude"
    )


@query(
    "p12_decode_variable_codes",
    """SELECT observation_id, observed_variable_code, CASE observed_variable_code WHEN 1 THEN 'air_temperature' WHEN 2 THEN 'wind_speed'
 WHEN 3 THEN 'ozone' ELSE 'unknown' END AS label FROM v_obs""",
)
def p12(spark, d):
    obs = v_obs(spark, d)
    labels = {1: "air_temperature", 2: "wind_speed", 3: "ozone"}
    label = F.coalesce(O.decode(obs, "observed_variable_code", labels), F.lit("unknown"))
    return obs.select("observation_id", "observed_variable_code", label.alias("label"))


@query(
    "p12_decode_by_code_table",
    """SELECT observed_variable_code, r_name AS label, count(*) AS n FROM v_obs JOIN region ON r_regionkey + 1 = observed_variable_code GROUP BY 1, 2""",
)
def p12_table(spark, d):
    codes = table(spark, d, "region").select((F.col("r_regionkey") + 1).alias("code"), F.col("r_name").alias("label"))
    decoded = O.decode_by_table(v_obs(spark, d), "observed_variable_code", codes)
    return decoded.groupBy("observed_variable_code", "label").agg(F.count(F.lit(1)).alias("n"))


UNITS = "CASE WHEN observed_variable IN ('view', 'click') THEN 'K' ELSE 'm s-1' END"


def with_units(spark, d):
    return v_obs(spark, d).withColumn("units", F.expr(UNITS))


@query(
    "k1_csv_header",
    f"""SELECT min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon,
 strftime(arg_min(report_timestamp, observation_id), '%Y%m%d') AS time_start,
 strftime(arg_max(report_timestamp, observation_id), '%Y%m%d') AS time_end FROM v_obs""",
)
def k1(spark, d):
    return O.extract_summary(v_obs(spark, d))


@query(
    "a14_extract_summary_by_station",
    """SELECT primary_station_id, min(latitude) AS min_lat, max(longitude) AS max_lon,
 strftime(arg_min(report_timestamp, observation_id), '%Y%m%d') AS time_start,
 strftime(arg_max(report_timestamp, observation_id), '%Y%m%d') AS time_end FROM v_obs GROUP BY 1""",
)
def a14(spark, d):
    summary = O.extract_summary(v_obs(spark, d), by=["primary_station_id"])
    return summary.select("primary_station_id", "min_lat", "max_lon", "time_start", "time_end")


@query("a14_variables_and_units", f"SELECT DISTINCT observed_variable, {UNITS} AS units FROM v_obs")
def a14_units(spark, d):
    return O.variables_and_units(with_units(spark, d))


@query(
    "a15_text_widths",
    """SELECT 'c_name' AS "column", max(strlen(c_name)) AS width FROM customer
UNION ALL SELECT 'c_mktsegment', max(strlen(c_mktsegment)) FROM customer""",
)
def a15(spark, d):
    return O.text_widths(table(spark, d, "customer"), ["c_name", "c_mktsegment"])


@query(
    "h13_union_of_sources",
    """SELECT observation_id, 'first' AS source, processing_level FROM v_obs WHERE observed_variable_code <= 2
UNION ALL SELECT observation_id, 'second', -1 FROM v_obs WHERE observed_variable_code BETWEEN 2 AND 4""",
)
def h13(spark, d):
    from skyloom.plans.retrieval import unite_sources

    obs = v_obs(spark, d).select("observation_id", "observed_variable_code", "processing_level")

    def broken():
        return obs.select("no_such_column")

    union, failed = unite_sources(
        {
            "first": lambda: obs.where("observed_variable_code <= 2"),
            "second": lambda: obs.where("observed_variable_code BETWEEN 2 AND 4").drop("processing_level"),
            "third": broken,
        }
    )
    assert list(failed) == ["third"]
    return union.select("observation_id", "source", F.coalesce("processing_level", F.lit(-1)).alias("processing_level"))


@query(
    "h13_outcomes",
    """
WITH u AS (SELECT 'first' AS source, observation_id FROM v_obs WHERE observed_variable_code <= 2
 UNION ALL SELECT 'second', observation_id FROM v_obs WHERE observed_variable_code BETWEEN 2 AND 4)
SELECT s.source, answered, count(observation_id) AS n_rows, CAST(sum(observation_id) AS BIGINT) AS ids
FROM (VALUES ('first', true), ('second', true), ('while_read', false), ('no_column', false)) s(source, answered) LEFT JOIN u USING (source)
GROUP BY 1, 2""",
)
def h13_outcomes(spark, d):
    from skyloom.plans.retrieval import unite_written

    obs = v_obs(spark, d).select("observation_id", "observed_variable_code")
    unreadable = F.when(F.col("observation_id") > 0, F.raise_error(F.lit("unreadable"))).otherwise(F.col("observation_id"))
    rows, outcomes = unite_written(
        spark,
        {
            "first": lambda: obs.where("observed_variable_code <= 2"),
            "second": lambda: obs.where("observed_variable_code BETWEEN 2 AND 4"),
            "while_read": lambda: obs.withColumn("observation_id", unreadable.cast("bigint")),
            "no_column": lambda: obs.select("no_such_column"),
        },
    )
    given = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("observation_id").alias("ids"))
    joined = outcomes.join(given, "source", "left")
    return joined.select("source", "answered", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "ids")


@query(
    "w2_clumps_of_mask",
    """
WITH m AS (SELECT event_id, value > 20 AS hit, event_id - row_number() OVER (PARTITION BY value > 20 ORDER BY event_id) AS run FROM events)
SELECT min(event_id) AS "start", max(event_id) + 1 AS stop FROM m WHERE hit GROUP BY run""",
)
def w2(spark, d):
    return W.clumps(table(spark, d, "events"), [], "event_id", F.col("value") > 20, block=4096)


@query(
    "p13_observation_request_shape",
    """SELECT request_id, CAST(trunc(request_id / 10) AS INTEGER) % 12 + 1 AS month, south, north, west, east FROM v_area""",
)
def p13(spark, d):
    from skyloom.operators.requests import adapt_parameters
    from skyloom.plans.views import v_area

    month = F.format_string("%02d", F.floor(F.col("request_id") / 10) % 12 + 1)
    raw = v_area(spark, d).select(
        "request_id",
        F.array(month).alias("month"),
        F.array(*[F.col(c).cast("string") for c in ("north", "west", "south", "east")]).alias("area"),
    )
    shaped = adapt_parameters(raw)
    return shaped.select(
        "request_id",
        F.col("month")[0].alias("month"),
        F.col("latitude_coverage")[0].alias("south"),
        F.col("latitude_coverage")[1].alias("north"),
        F.col("longitude_coverage")[0].alias("west"),
        F.col("longitude_coverage")[1].alias("east"),
    )


@query("p15_columns_with_attributes", "SELECT observation_id, latitude, longitude FROM v_obs")
def p15(spark, d):
    obs = v_obs(spark, d).select("observation_id", "latitude", "longitude")
    return O.with_attributes(obs, {"latitude": {"comment": "of the report"}})


@query(
    "k2_long_table_export",
    """SELECT variable, strftime(valid_time, '%Y-%m-%d %H:%M:%S') AS valid_time, latitude, longitude, round(value + 1e-9, 6) AS value
FROM v_grid WHERE latitude BETWEEN -45 AND 45""",
)
def k2(spark, d):
    from skyloom.plans.views import v_grid
    from skyloom.sinks.files import long_table

    cells = v_grid(spark, d).where("latitude BETWEEN -45 AND 45").withColumnRenamed("valid_time", "time")
    return long_table(cells).withColumn("valid_time", F.date_format("valid_time", MOMENT)).withColumn(
        "value", near(F.col("value"))
    )


@query(
    "k3_cubes_by_tag",
    """SELECT variable || '_daily-mean' AS tag, CAST(valid_time AS DATE) AS day, latitude, longitude, round(avg(value) + 1e-9, 6) AS value
FROM v_grid GROUP BY 1, 2, 3, 4""",
)
def k3(spark, d):
    from skyloom.plans.steps import run_steps
    from skyloom.plans.views import v_grid

    cubes = run_steps(v_grid(spark, d).withColumn("tag", F.col("variable")), [{"method": "daily_mean"}, {"method": "unknown"}])
    return cubes.select("tag", "day", "latitude", "longitude", near(F.col("value")).alias("value"))


@query(
    "p18_named_steps",
    """SELECT variable || '_monthly-max' AS tag, CAST(date_trunc('month', valid_time) AS DATE) AS month, latitude, longitude, round(max(value) + 1e-9, 6) AS value
FROM v_grid GROUP BY 1, 2, 3, 4""",
)
def p18(spark, d):
    from skyloom.plans.steps import run_steps
    from skyloom.plans.views import v_grid

    cubes = run_steps(v_grid(spark, d).withColumn("tag", F.col("variable")), [{"method": "monthly_max"}])
    return cubes.select("tag", "month", "latitude", "longitude", near(F.col("value")).alias("value"))


@query(
    "u2_user_step",
    """SELECT variable || '_scaled_daily-max' AS tag, CAST(valid_time AS DATE) AS day, round(max(value) * 10, 4) AS value FROM v_grid GROUP BY 1, 2""",
)
def u2(spark, d):
    from skyloom.plans.steps import Steps
    from skyloom.plans.views import v_grid

    steps = Steps()
    steps.register("scale", lambda df, factor: df.withColumn("value", F.col("value") * factor).withColumn("tag", F.concat("tag", F.lit("_scaled"))))
    cubes = steps.run(
        v_grid(spark, d).withColumn("tag", F.col("variable")),
        [{"method": "scale", "factor": 10}, {"method": "daily_max", "by": ["variable"]}],
    )
    return cubes.select("tag", "day", F.round("value", 4).alias("value"))


@query(
    "u4_dataset_by_configuration",
    f"""SELECT primary_station_id, observed_variable, count(*) AS n, round(avg(observation_value) + 1e-9, 6) AS mean_value FROM v_obs
WHERE day(report_timestamp) IN (2, 3) AND observed_variable_code IN (1, 3) GROUP BY 1, 2""",
)
def u4(spark, d):
    from skyloom.plans.retrieval import Dataset

    dataset = Dataset(
        name="stations",
        mapping={"remap": {"variable": {"looks": "view", "sales": "purchase"}}, "rename": {"variable": "variables"}},
        read=lambda request: v_obs(spark, d).where(
            O.predicate(v_obs(spark, d).columns, O.Retrieval(days=[int(x) for x in request["day"]], variables=request["variables"]), CODES)
        ),
        steps=[
            lambda df: df.groupBy("primary_station_id", "observed_variable").agg(
                F.count(F.lit(1)).alias("n"), near(F.avg("observation_value")).alias("mean_value")
            )
        ],
    )
    return dataset.retrieve({"variable": ["looks", "sales"], "day": ["2", "3"]})
