"""Queries that translate tables of requests: values, names, formats, dates, delays and boxes."""

from pyspark.sql import functions as F

from skyloom.functions import dates as D
from skyloom.functions import space as S
from skyloom.functions import text as X
from skyloom.operators import cubes as C
from skyloom.operators import requests as R
from skyloom.plans.registry import query
from skyloom.plans.views import v_area, v_con, v_field, v_req, v_sel
from skyloom.tables import table

REMAP = {"1-URGENT": "10u", "2-HIGH": "10v", "5-LOW": "2t"}
REMAP_SQL = "CASE param WHEN '1-URGENT' THEN '10u' WHEN '2-HIGH' THEN '10v' WHEN '5-LOW' THEN '2t' ELSE param END"


def joined(column):
    return F.array_join(column, ",")


@query(
    "p1_defaults",
    """SELECT request_id, array_to_string(coalesce(type, ['O', 'F']), ',') AS types, '00:00' AS times FROM v_sel""",
)
def p1(spark, d):
    filled = R.set_defaults(v_sel(spark, d), {"type": ["O", "F"], "time": ["00:00"]})
    return filled.select("request_id", joined("type").alias("types"), joined("time").alias("times"))


@query("p2_force_values", """SELECT request_id, array_to_string(param, ',') AS params, 'X' AS types FROM v_req""")
def p2(spark, d):
    forced = R.force_values(v_req(spark, d), {"type": ["X"]})
    return forced.select("request_id", joined("param").alias("params"), joined("type").alias("types"))


@query("p3_remap_values", f"SELECT request_id, {REMAP_SQL} AS param, type, d FROM v_field")
def p3(spark, d):
    return v_field(spark, d).select("request_id", R.remap_scalar(F.col("param"), REMAP).alias("param"), "type", "d")


@query(
    "p3_remap_lists",
    f"""SELECT request_id, string_agg({REMAP_SQL}, ',' ORDER BY param) AS params FROM
 (SELECT request_id, unnest(param) AS param FROM v_req) GROUP BY 1""",
)
def p3_lists(spark, d):
    return v_req(spark, d).select("request_id", joined(R.remap_list(F.col("param"), REMAP)).alias("params"))


@query(
    "p3_remap_by_large_table",
    """WITH renamed AS (SELECT DISTINCT o_orderpriority AS old, 'as ' || lower(o_orderpriority) AS new FROM orders WHERE o_orderstatus = 'P')
SELECT request_id, coalesce(new, param) AS param, d FROM v_field LEFT JOIN renamed ON old = param""",
)
def p3_table(spark, d):
    late = table(spark, d, "orders").where("o_orderstatus = 'P'")
    old = F.col("o_orderpriority")
    names = late.select(old.alias("old"), F.concat(F.lit("as "), F.lower(old)).alias("new")).distinct()
    return R.remap_by_table(v_field(spark, d), "param", names).select("request_id", "param", "d")


@query("p4_rename_keys", "SELECT request_id, param AS variable, type AS product_type, d AS date FROM v_field")
def p4(spark, d):
    names = {"param": "variable", "type": "product_type", "d": "date"}
    return R.rename_keys(v_field(spark, d).drop("dataset"), names)


@query(
    "p5_patches",
    "SELECT request_id, param, CASE param WHEN '1-URGENT' THEN 'sfc' WHEN '2-HIGH' THEN 'sfc' ELSE param END AS levtype, d, type FROM v_field",
)
def p5(spark, d):
    patched = R.add_patch(v_field(spark, d), "param", "levtype", {"1-URGENT": "sfc", "2-HIGH": "sfc"})
    return patched.drop("dataset")


@query("p6_scalars_as_lists", "SELECT request_id, param || '|1' AS param, type, d FROM v_field")
def p6(spark, d):
    listed = v_field(spark, d).withColumn("param", R.as_list(F.col("param")))
    shown = F.concat_ws("|", F.array_join("param", ","), F.size("param").cast("string"))
    return listed.select("request_id", shown.alias("param"), "type", "d")


@query("p7_safe_rename", "SELECT o_orderkey, o_custkey AS o_orderstatus, o_orderstatus AS o_custkey, o_totalprice AS price FROM orders")
def p7(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    swapped = R.safe_rename(orders, {"o_custkey": "key"})
    swapped = R.safe_rename(swapped, {"o_orderstatus": "o_custkey", "o_totalprice": "price"})
    return R.safe_rename(swapped, {"key": "o_orderstatus"})


@query(
    "plan_full_mapping",
    f"""SELECT request_id, string_agg({REMAP_SQL}, ',' ORDER BY param) AS variables, 'A' AS types, '00:00' AS times FROM
 (SELECT request_id, unnest(param) AS param FROM v_req) GROUP BY 1""",
)
def p_full(spark, d):
    mapping = {
        "defaults": {"time": ["00:00"]},
        "remap": {"param": REMAP},
        "patches": [{"from": "param", "to": "levtype", "mapping": {"10u": "sfc"}}],
        "rename": {"param": "variable"},
        "force": {"type": ["A"]},
    }
    mapped = R.apply_mapping(v_req(spark, d), mapping)
    return mapped.select("request_id", joined("variable").alias("variables"), joined("type").alias("types"), joined("time").alias("times"))


FORMAT_SQL = """CASE l_returnflag WHEN 'A' THEN CASE l_linestatus WHEN 'F' THEN 'nc' ELSE 'netcdf4.zip' END WHEN 'N' THEN 'netcdf' ELSE
 CASE l_linestatus WHEN 'F' THEN 'grb2' ELSE 'grib' END END"""


@query(
    "p9_one_data_format",
    f"""WITH f AS (SELECT l_orderkey, {FORMAT_SQL} AS raw, CASE WHEN l_returnflag = 'R' THEN 'grib' ELSE 'netcdf' END AS fmt FROM lineitem)
SELECT l_orderkey AS job, min(fmt) AS data_format, count(DISTINCT fmt) = 1 AS valid, bool_or(raw = 'netcdf4.zip') AS zipped FROM f GROUP BY 1""",
)
def p9(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("job"), F.expr(FORMAT_SQL.replace("\n", " ")).alias("raw")
    )
    return R.one_data_format(lines, "job", "raw")


@query(
    "p9_download_format",
    """SELECT l_shipdate::DATE AS d, count(*) FILTER (WHERE l_linestatus = 'F') AS n_zip, count(*) FILTER (WHERE l_linestatus <> 'F') AS n_as_source FROM lineitem GROUP BY 1""",
)
def p9_download(spark, d):
    lines = table(spark, d, "lineitem").withColumn("asked", F.when(F.col("l_linestatus") == "F", "rar").otherwise("as_source"))
    fmt = R.download_format(F.col("asked"))
    return lines.groupBy(F.to_date("l_shipdate").alias("d")).agg(
        F.count_if(fmt == "zip").alias("n_zip"), F.count_if(fmt == "as_source").alias("n_as_source")
    )


WIDGET_SQL = """CASE p_type WHEN 'SMALL' THEN 'StringListWidget' WHEN 'PROMO' THEN 'StringChoiceWidget' WHEN 'MEDIUM' THEN 'StringListArrayWidget'
 WHEN 'ECONOMY' THEN 'DateRangeWidget' WHEN 'STANDARD' THEN 'GeographicExtentWidget' ELSE 'StringListWidget' END"""


def widgets(spark, d):
    part = table(spark, d, "part").withColumn("type", F.expr(WIDGET_SQL.replace("\n", " ")))
    brand = F.col("p_brand")
    size = F.format_string("2020-01-%02d", F.col("p_size") % 28 + 1)
    return part.groupBy(F.col("p_type").alias("name"), "type").agg(
        F.collect_set(brand).alias("values"),
        F.array(
            F.collect_set(F.when(F.col("p_size") <= 25, brand)), F.collect_set(F.when(F.col("p_size") > 25, brand))
        ).alias("groups"),
        F.min(size).alias("min_start"),
        F.max(size).alias("max_end"),
    )


@query(
    "p14_form_values",
    f"""WITH w AS (SELECT *, {WIDGET_SQL} AS type FROM part)
SELECT DISTINCT p_type AS name, p_brand AS value FROM w WHERE type IN ('StringListWidget', 'StringChoiceWidget', 'StringListArrayWidget')
UNION SELECT p_type, printf('2020-01-%02d/2020-01-%02d', min(p_size % 28 + 1), max(p_size % 28 + 1)) FROM w WHERE type = 'DateRangeWidget' GROUP BY 1""",
)
def p14(spark, d):
    return R.form_values(widgets(spark, d))


@query("p14_unsupported_widgets", f"SELECT DISTINCT p_type AS name, {WIDGET_SQL} AS type FROM part WHERE p_type = 'STANDARD'")
def p14_unsupported(spark, d):
    return R.unsupported_widgets(widgets(spark, d)).select("name", "type")


@query(
    "p19_flatten_separated_text",
    """SELECT DISTINCT request_id, unnest(string_split(p, '-')) AS item FROM (SELECT request_id, unnest(param) AS p FROM v_req)""",
)
def p19(spark, d):
    items = X.split_all(F.col("param"), "-")
    return v_req(spark, d).select("request_id", F.explode(F.array_distinct(items)).alias("item"))


@query(
    "p20_separate_processing_keys",
    """SELECT request_id, array_to_string(param, ',') AS params, coalesce(type[1], 'daily_mean') AS daily_statistic, 'UTC+00:00' AS time_zone,
 CASE WHEN len(type) > 1 THEN 'Multiple daily_statistic values in a single request is not supported.' ELSE '' END AS errors FROM v_sel""",
)
def p20(spark, d):
    raw = v_sel(spark, d).select(
        "request_id", "param", F.col("type").alias("daily_statistic"), F.lit(None).cast("array<string>").alias("time_zone")
    )
    selection, parameters = R.separate_processing(raw, {"daily_statistic": "daily_mean", "time_zone": "UTC+00:00"})
    return selection.join(parameters, "request_id").select(
        "request_id", joined("param").alias("params"), "daily_statistic", "time_zone", joined("errors").alias("errors")
    )


# --- filters on requests ---------------------------------------------------------


@query(
    "f14_first_valid_date",
    """SELECT request_id, d FROM (SELECT DISTINCT request_id, dataset, d FROM v_field)
WHERE d >= CASE WHEN dataset // 10000 > 12 THEN DATE '1997-03-02' ELSE DATE '1997-03-01' END""",
)
def f14(spark, d):
    days = v_field(spark, d).select("request_id", "dataset", "d").distinct()
    ahead = F.floor(F.col("dataset") / 10000) > 12
    return R.drop_before_first_valid(days, "1997-03-01", ahead).select("request_id", "d")


EMBARGO = """
WITH r AS (SELECT request_id, d, TIMESTAMP '1998-06-14 15:30:00' AS lim FROM v_req),
p AS (SELECT request_id, 'before' AS piece, [x for x in d if x < CAST(lim AS DATE)] AS d, '0000/0600/1200,18:00' AS times, d AS all_days, lim FROM r
 UNION ALL SELECT request_id, 'limit', [x for x in d if x = CAST(lim AS DATE)], '0000,0600,1200', d, lim FROM r)
SELECT request_id, piece, len(d) AS n_days, d[1] AS first_day, times, all_days[-1] < CAST(lim AS DATE) AS cacheable
FROM p WHERE len(d) > 0"""


@query("f16_embargo", EMBARGO)
def f16(spark, d):
    timed = v_req(spark, d).withColumn("time", F.array(F.lit("0000/0600/1200"), F.lit("18:00")))
    as_of = F.lit("1998-07-20 03:30:00").cast("timestamp_ntz")
    cut = R.embargo(timed.drop("dataset", "param", "type"), as_of, days=5, hours=12, months=1)
    return cut.select(
        "request_id",
        "piece",
        F.size("d").cast("bigint").alias("n_days"),
        F.col("d")[0].alias("first_day"),
        joined("time").alias("times"),
        "cacheable",
    )


@query(
    "f16_nothing_available",
    "SELECT request_id FROM v_field GROUP BY 1 HAVING min(d) >= DATE '1998-06-15' UNION SELECT request_id FROM v_field WHERE false",
)
def f16_nothing(spark, d):
    timed = v_req(spark, d).withColumn("time", F.array(F.lit("00:00")))
    as_of = F.lit("1998-07-20 03:30:00").cast("timestamp_ntz")
    cut = R.embargo(timed, as_of, days=5, hours=12, months=1)
    return timed.join(cut.select("request_id").distinct(), "request_id", "left_anti").select("request_id")


@query(
    "f17_clip_range_to_embargo",
    """SELECT request_id, s AS "start", CASE WHEN s <= DATE '1999-03-31' AND e > DATE '1999-03-31' THEN DATE '1999-03-31' ELSE e END AS "end",
 s <= DATE '1999-03-31' AND e > DATE '1999-03-31' AS clipped, s > DATE '1999-03-31' AS rejected
FROM (SELECT request_id, min(d) AS s, max(d) AS e FROM v_field GROUP BY 1)""",
)
def f17(spark, d):
    spans = v_field(spark, d).groupBy("request_id").agg(F.max("d").alias("start"), F.min("d").alias("end"))
    return R.clip_range_to_embargo(spans, "start", "end", F.lit("1999-03-31").cast("date"))


@query(
    "f18_requests_for_sources",
    """
WITH s(source, params, types) AS (VALUES ('first', ['1-URGENT', '2-HIGH'], ['F', 'O', 'P']), ('second', ['3-MEDIUM', '5-LOW'], ['P']))
SELECT request_id, source, array_to_string([x for x in r.param if list_contains(params, x)], ',') AS params,
 array_to_string([x for x in r.type if list_contains(types, x)], ',') AS types
FROM v_req r, s WHERE list_has_any(r.param, params)""",
)
def f18(spark, d):
    sources = [
        {"source": "first", "values": {"param": ["1-URGENT", "2-HIGH"], "type": ["F", "O", "P"]}, "required": ["param"]},
        {"source": "second", "values": {"param": ["3-MEDIUM", "5-LOW"], "type": ["P"]}, "required": ["param"]},
    ]
    parts = R.requests_for_sources(v_req(spark, d), sources, ["param", "type"])
    types = F.coalesce(joined("type"), F.lit(""))
    return parts.select("request_id", "source", joined("param").alias("params"), types.alias("types"))


@query(
    "f20_keys_constraints_ignore",
    "SELECT request_id, 'param' AS key, unnest(param) AS value FROM v_req",
)
def f20(spark, d):
    keys = ["param", "location_x"]
    selections = v_req(spark, d).withColumn("location_x", F.array(F.lit("12.5")))
    long = selections.select("request_id", F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), F.col(k).alias("values")) for k in keys
    ])).alias("s")).select("request_id", "s.key", F.explode("s.values").alias("value"))
    return R.clean_selection(long)


@query(
    "f21_box_extent_rules",
    """SELECT request_id, CASE WHEN request_id % 10 = 0 THEN 'either a box or a point is required, and not both'
 WHEN north - south > 9.5 THEN 'latitude exceeds the maximum extent allowed'
 WHEN abs(west - east) > 19.556 THEN 'longitude exceeds the maximum extent allowed' ELSE '' END AS problem FROM v_area""",
)
def f21(spark, d):
    box = [F.col(c) for c in ("north", "west", "south", "east")]
    problem = R.box_problems(*box, max_lat=9.5, max_lon=19.556, has_point=F.col("request_id") % 10 == 0)
    return v_area(spark, d).select("request_id", F.coalesce(problem, F.lit("")).alias("problem"))


# --- dates -------------------------------------------------------------------------


@query(
    "d1_date_range_with_step",
    """SELECT request_id, CAST(unnest(generate_series(s, e, INTERVAL 3 DAY)) AS DATE) AS day
FROM (SELECT request_id, min(d) AS s, max(d) AS e FROM v_field GROUP BY 1)""",
)
def d1(spark, d):
    spans = v_field(spark, d).groupBy("request_id").agg(F.min("d").alias("s"), F.max("d").alias("e"))
    both = spans.unionByName(spans.select("request_id", F.date_add("e", 1).alias("s"), F.col("s").alias("e")))
    return both.select("request_id", F.explode(D.date_range(F.col("s"), F.col("e"), 3)).alias("day"))


@query(
    "d2_year_month_day_to_dates",
    """
WITH p AS (SELECT DISTINCT request_id, year(d) AS y, month(d) AS m FROM v_field), k AS (SELECT unnest([1, 29, 30, 31]) AS dd)
SELECT request_id, make_date(y, m, dd) AS d FROM p, k WHERE dd <= day(last_day(make_date(y, m, 1)))""",
)
def d2(spark, d):
    parts = v_field(spark, d).groupBy("request_id").agg(
        F.collect_set(F.year("d")).alias("year"), F.collect_set(F.month("d")).alias("month")
    )
    parts = parts.withColumn("day", F.array(F.lit(1), F.lit(29), F.lit(30), F.lit(31)))
    return R.dates_from_parts(parts, ["request_id"])


@query(
    "d3_julian_day_numbers",
    """SELECT o_orderkey, CAST(julian(CAST(o_orderdate AS DATE)) AS BIGINT) AS julian_day, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS ymd,
 CAST(o_orderdate AS DATE) AS back, (year(o_orderdate) % 4 = 0 OR o_orderkey % 2 = 0) AS feb_valid FROM orders""",
)
def d3(spark, d):
    day = F.to_date("o_orderdate")
    february = F.year("o_orderdate") * 10000 + 228 + F.col("o_orderkey") % 2
    return table(spark, d, "orders").select(
        "o_orderkey",
        D.julian_day(day).cast("bigint").alias("julian_day"),
        D.compact_integer(day).cast("bigint").alias("ymd"),
        D.date_from_julian_day(D.julian_day(day)).alias("back"),
        D.date_from_compact_integer(february).isNotNull().alias("feb_valid"),
    )


@query(
    "d3_rolled_over_dates",
    """SELECT o_orderkey, make_date(year(o_orderdate), 2, 1) + CAST(29 + o_orderkey % 3 AS INTEGER) - 1 AS day FROM orders""",
)
def d3_rolled(spark, d):
    value = F.year("o_orderdate") * 10000 + 229 + F.col("o_orderkey") % 3
    return table(spark, d, "orders").select("o_orderkey", D.rolled_over_date(value).alias("day"))


@query(
    "d4_since_epoch",
    """SELECT o_orderkey, date_diff('day', DATE '1900-01-01', CAST(o_orderdate AS DATE)) AS days,
 CAST(date_diff('day', DATE '1900-01-01', CAST(o_orderdate AS DATE)) * 86400 + 43200 AS VARCHAR) AS seconds FROM orders""",
)
def d4(spark, d):
    day, epoch = F.to_date("o_orderdate"), F.lit("1900-01-01").cast("date")
    return table(spark, d, "orders").select(
        "o_orderkey", D.days_since(day, epoch).alias("days"), D.seconds_since(day, epoch, 12).alias("seconds")
    )


@query(
    "d5_relative_dates",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-03-10' WHEN c_custkey % 3 = 1 THEN DATE '2024-03-10' - CAST(c_custkey % 40 AS INTEGER)
 ELSE CAST(TIMESTAMP '2024-03-10 13:00:00' + to_hours(CAST((c_custkey % 40) * 24 + 12 AS BIGINT)) AS DATE) END AS day FROM customer""",
)
def d5(spark, d):
    key = F.col("c_custkey")
    days = (key % 40).cast("string")
    text = (
        F.when(key % 3 == 0, F.lit("current"))
        .when(key % 3 == 1, F.concat(F.lit("current-"), days))
        .otherwise(F.concat(F.lit("current+"), days, F.lit(".5")))
    )
    as_of = F.lit("2024-03-10 13:00:00").cast("timestamp_ntz")
    return table(spark, d, "customer").select("c_custkey", D.current_date_text(text, as_of).alias("day"))


@query(
    "d6_guess_and_reformat",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'yyyy-MM-dd' ELSE 'yyyyMMdd' END AS date_format,
 strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y%m%d') || '/' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') AS compact,
 CASE WHEN o_orderkey % 2 = 0 THEN 'HH:mm' ELSE 'HHmm' END AS time_format FROM orders""",
)
def d6(spark, d):
    even = F.col("o_orderkey") % 2 == 0
    text = F.when(even, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    following = F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd")
    clock = F.when(even, F.lit("06:30")).otherwise(F.lit("0630"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        D.date_format_of(text).alias("date_format"),
        D.reformat_date(text).alias("iso"),
        D.reformat_date(F.concat_ws("/", text, following), "yyyyMMdd").alias("compact"),
        D.time_format_of(clock).alias("time_format"),
    )


@query(
    "d7_clock_text_to_seconds",
    """WITH t AS (SELECT o_orderkey, CAST(o_orderkey % 27 AS BIGINT) AS h, CAST(o_orderkey % 64 AS BIGINT) AS m, o_orderkey % 4 AS kind FROM orders)
SELECT o_orderkey, CASE WHEN h > 23 OR (kind < 3 AND m > 59) THEN -1 WHEN kind = 3 THEN h * 3600 WHEN kind = 2 THEN h * 3600 + m * 60 + 7
 ELSE h * 3600 + m * 60 END AS seconds FROM t""",
)
def d7(spark, d):
    h, m, kind = F.col("o_orderkey") % 27, F.col("o_orderkey") % 64, F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.format_string("%02d:%02d", h, m))
        .when(kind == 1, F.format_string("%02d%02d", h, m))
        .when(kind == 2, F.format_string("%d:%02d:07", h, m))
        .otherwise(h.cast("string"))
    )
    return table(spark, d, "orders").select(
        "o_orderkey", F.coalesce(D.clock_seconds(text), F.lit(-1)).cast("bigint").alias("seconds")
    )


@query(
    "d8_months_back_in_days",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate - INTERVAL 5 MONTH AS DATE), CAST(o_orderdate AS DATE)) AS days FROM orders""",
)
def d8(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", D.months_back_in_days(F.to_date("o_orderdate"), 5).cast("bigint").alias("days")
    )


@query(
    "d9_utc_offset_and_sampling",
    """WITH z AS (SELECT c_custkey, CAST(c_nationkey AS INTEGER) - 12 AS h FROM customer)
SELECT c_custkey, h AS offset_hours, array_to_string(list_sort(list_distinct([(i + ((h % 6) + 6) % 6) % 24 for i in [0, 6, 12, 18]])), ',') AS hours FROM z""",
)
def d9(spark, d):
    hour = F.col("c_nationkey").cast("int") - 12
    sign = F.when(hour < 0, "-").otherwise("+")
    text = F.concat(F.lit("UTC"), sign, F.lpad(F.abs(hour).cast("string"), 2, "0"), F.lit(":00"))
    offset = D.utc_offset_hours(text)
    hours = D.sampled_hours(offset, F.lit(6))
    return table(spark, d, "customer").select(
        "c_custkey", offset.alias("offset_hours"), joined(F.transform(hours, lambda x: x.cast("string"))).alias("hours")
    )


@query(
    "d10_date_to_interval",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || '/' || strftime(o_orderdate, '%Y-%m-%d')
 ELSE strftime(o_orderdate, '%Y-%m-%d') || '/2030-01-01' END AS span FROM orders""",
)
def d10(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(F.concat(day, F.lit("/2030-01-01")))
    return table(spark, d, "orders").select("o_orderkey", D.to_interval(text).alias("span"))


# --- space -----------------------------------------------------------------------------

EDGES = ("north", "west", "south", "east")


@query(
    "g1_snap_box_inwards",
    """SELECT request_id, round(floor(round(north / 0.25, 9)) * 0.25, 9) AS north, round(ceil(round((west - 0.1) / 0.5, 9)) * 0.5 + 0.1, 9) AS west,
 round(ceil(round(south / 0.25, 9)) * 0.25, 9) AS south, round(floor(round((east - 0.1) / 0.5, 9)) * 0.5 + 0.1, 9) AS east, true AS has_points FROM v_area""",
)
def g1(spark, d):
    grid = S.RegularGrid(delta_lat=0.25, delta_lon=0.5, lon0=0.1)
    snapped = S.snap_inwards(*[F.col(e) for e in EDGES], grid)
    return v_area(spark, d).select("request_id", *[v.alias(k) for k, v in snapped.items()])


@query(
    "g1_simulate_preinterpolation",
    """
SELECT request_id, CASE WHEN request_id % 4 = 0 THEN '1.0/1.0' ELSE '0.5/0.25' END AS grid,
 CASE WHEN request_id % 4 = 0 THEN round(north, 3) ELSE floor(round(north / 0.25, 9)) * 0.25 END AS north,
 CASE WHEN request_id % 4 = 0 THEN round(west, 3) ELSE ceil(round(west / 0.5, 9)) * 0.5 END AS west FROM v_area""",
)
def g1_preinterpolation(spark, d):
    box = F.array(*[F.round(F.col(e), 3).cast("string") for e in EDGES])
    area = F.create_map(F.lit(" AreaX"), box)
    given = F.map_concat(area, F.create_map(F.lit("GRID"), F.array(F.lit("1.0"), F.lit("1.0"))))
    keys = F.when(F.col("request_id") % 4 == 0, given).otherwise(area)
    raw = v_area(spark, d).select("request_id", keys.alias("keys"))
    ready = R.simulate_preinterpolation(raw, S.RegularGrid(delta_lat=0.25, delta_lon=0.5)).where("problem IS NULL")
    spacing = F.coalesce(F.try_element_at("keys", F.lit("grid")), F.try_element_at("keys", F.lit("GRID")))
    place = F.try_element_at("keys", F.lit(" AreaX"))
    return ready.select(
        "request_id",
        F.array_join(spacing, "/").alias("grid"),
        place[0].cast("double").alias("north"),
        place[1].cast("double").alias("west"),
    )


@query(
    "g1_upside_down_boxes_keep_order",
    """SELECT request_id, round(ceil(round(south, 9)), 9) AS north, round(floor(round(north, 9)), 9) AS south FROM v_area""",
)
def g1_upside(spark, d):
    grid = S.RegularGrid(1.0, 1.0)
    snapped = S.snap_inwards(F.col("south"), F.col("west"), F.col("north"), F.col("east"), grid)
    return v_area(spark, d).select("request_id", snapped["north"].alias("north"), snapped["south"].alias("south"))


@query(
    "g2_snap_to_regional_cells",
    """
WITH s AS (SELECT request_id, north, south, west, east, round(floor((north + 14.95) / 0.1) * 0.1 - 14.95, 2) AS n, round(ceil((south + 14.95) / 0.1) * 0.1 - 14.95, 2) AS so,
 round(ceil((west + 99.95) / 0.1) * 0.1 - 99.95, 2) AS w, round(floor((east + 99.95) / 0.1) * 0.1 - 99.95, 2) AS e FROM v_area)
SELECT request_id, n AS north, so AS south, w AS west, e AS east,
 CASE WHEN n > 74.95 THEN 'north outside the grid' WHEN so < -14.95 THEN 'south outside the grid' WHEN e > 139.95 THEN 'east outside the grid'
  WHEN w < -99.95 THEN 'west outside the grid' ELSE '' END AS problem FROM s""",
)
def g2(spark, d):
    grid = S.RegionalGrid(north=75.0, west=-100.0, south=-15.0, east=140.0, dlat=0.1, dlon=0.1)
    snapped = S.snap_to_cells(*[F.col(e) for e in EDGES], grid)
    return v_area(spark, d).select(
        "request_id", *[snapped[e].alias(e) for e in EDGES], F.coalesce(snapped["problem"], F.lit("")).alias("problem")
    )


@query(
    "g3_shift_longitudes",
    """SELECT request_id, round(CASE WHEN west < 0 THEN west + 360 ELSE west END, 6) AS west_0_360,
 round(CASE WHEN east * 3 >= 180 THEN east * 3 - 360 WHEN east * 3 < -180 THEN east * 3 + 360 ELSE east * 3 END, 6) AS east_half FROM v_area""",
)
def g3(spark, d):
    return v_area(spark, d).select(
        "request_id",
        F.round(S.shift_longitude(F.col("west"), 0.0), 6).alias("west_0_360"),
        F.round(S.shift_longitude(F.col("east") * 3, -180.0), 6).alias("east_half"),
    )


@query(
    "g4_box_around_point",
    """SELECT request_id, round(west - 0.75, 6) AS west, round(north - 0.75, 6) AS south, round(west + 0.75, 6) AS east, round(north + 0.75, 6) AS north FROM v_area""",
)
def g4(spark, d):
    box = S.box_around(F.col("north"), F.col("west"), 1.5)
    return v_area(spark, d).select("request_id", *[F.round(v, 6).alias(k) for k, v in box.items()])


@query(
    "g5_key_by_prefix",
    """
WITH k AS (SELECT p_partkey, unnest([CASE p_partkey % 3 WHEN 0 THEN ' ArEa' WHEN 1 THEN 'areaXYZ' ELSE 'grid' END, p_type,
 CASE WHEN p_partkey % 5 = 0 THEN 'AREA' ELSE 'zone' END]) AS key FROM part)
SELECT p_partkey AS request_id, min(key) AS matched, count(*) AS n_matches, count(*) > 1 AS ambiguous FROM k WHERE lower(trim(key)) LIKE 'area%' GROUP BY 1""",
)
def g5(spark, d):
    key = F.col("p_partkey")
    first = F.when(key % 3 == 0, F.lit(" ArEa")).when(key % 3 == 1, F.lit("areaXYZ")).otherwise(F.lit("grid"))
    last = F.when(key % 5 == 0, F.lit("AREA")).otherwise(F.lit("zone"))
    keys = table(spark, d, "part").select(
        key.alias("request_id"), F.explode(F.array(first, F.col("p_type"), last)).alias("key")
    )
    return R.key_matches(keys, "area", ["request_id"])


@query(
    "f16_unreadable_times",
    """SELECT request_id, 'noon' AS unreadable FROM v_req WHERE list_contains(type, 'P')""",
)
def f16_unreadable(spark, d):
    clock = F.transform("type", lambda t: F.when(t == "P", "noon").when(t == "O", "12:00").otherwise("06"))
    asked = v_req(spark, d).select("request_id", "d", clock.alias("time"))
    as_of = F.date_add(F.element_at("d", -1), 1).cast("timestamp")  # the limit is the last day that each request asks for
    found = R.unreadable_times(asked, as_of, days=1)
    return found.select("request_id", F.array_join("unreadable", ",").alias("unreadable"))


@query(
    "g1_bad_areas",
    """SELECT c_custkey AS request_id, CASE WHEN c_acctbal < 0 THEN 'area must have four items' WHEN c_mktsegment = 'BUILDING' THEN 'area must hold numbers'
 WHEN north + 30 > 90 THEN 'area latitude must be from -90 to 90' ELSE 'fine' END AS problem FROM customer JOIN v_area ON c_custkey = request_id""",
)
def g1_bad(spark, d):
    box = [(F.col("north") + 30).cast("string"), *[F.col(e).cast("string") for e in ("west", "south", "east")]]
    words = [box[0], F.lit("west"), *box[2:]]
    area = F.when(F.col("c_acctbal") < 0, F.array(*box, F.lit("0"))).when(F.col("c_mktsegment") == "BUILDING", F.array(*words)).otherwise(F.array(*box))
    asked = v_area(spark, d).join(table(spark, d, "customer"), F.col("request_id") == F.col("c_custkey"))
    raw = asked.select("request_id", F.create_map(F.lit("area"), area).alias("keys"))
    judged = R.simulate_preinterpolation(raw, S.RegularGrid(delta_lat=0.25, delta_lon=0.5))
    return judged.select("request_id", F.coalesce("problem", F.lit("fine")).alias("problem"))


PARTS_SQL = """parts AS (SELECT request_id, list_sort(list_distinct(list_transform(d, lambda x: year(x)))) AS y,
 list_sort(list_distinct(list_transform(d, lambda x: month(x)))) AS m, list_sort(list_distinct(list_transform(d, lambda x: day(x)))) AS n FROM v_req),
made AS (SELECT request_id, TRY_CAST(printf('%04d-%02d-%02d', y, m, n) AS DATE) AS day FROM
 (SELECT request_id, y, m, unnest(n) AS n FROM (SELECT request_id, y, unnest(m) AS m, n FROM (SELECT request_id, unnest(y) AS y, m, n FROM parts))))"""


@query(
    "plan_full_mapping_with_dates",
    f"""WITH {PARTS_SQL}
SELECT request_id, string_agg(strftime(day, '%Y%m%d'), ',' ORDER BY day) AS hdates, 0 AS left_over, '' AS problem FROM made WHERE day IS NOT NULL GROUP BY 1""",
)
def full_mapping_with_dates(spark, d):
    def numbers(part):
        return F.array_sort(F.array_distinct(F.transform("d", lambda x: part(x)))).cast("array<string>")

    raw = v_req(spark, d).select("request_id", numbers(F.year).alias("years"), numbers(F.month).alias("hmonth"), numbers(F.dayofmonth).alias("hday"))
    mapping = {"rename": {"years": "hyear"}, "options": {"wants_dates": True, "hdate_format": "%Y%m%d"}}
    mapped = R.apply_mapping(raw, mapping)
    return mapped.select(
        "request_id",
        joined("hdate").alias("hdates"),
        (F.coalesce(F.size("hyear"), F.lit(0)) + F.coalesce(F.size("hday"), F.lit(0))).alias("left_over"),
        F.coalesce("mapping_problem", F.lit("")).alias("problem"),
    )


@query(
    "p1_mapping_of_ranges_to_seconds",
    """SELECT request_id, list_aggregate(list_transform(range(CAST(d_end - d_start AS BIGINT) + 1), lambda i: CAST((d_start - DATE '1990-01-01' + i) * 86400 + 10800 AS VARCHAR)), 'string_agg', ',') AS seconds
FROM (SELECT constraint_id AS request_id, d_start, d_end FROM v_con)""",
)
def mapping_to_seconds(spark, d):
    span = F.concat_ws(" / ", F.col("d_start").cast("string"), F.col("d_end").cast("string"))
    raw = v_con(spark, d).select(F.col("constraint_id").alias("request_id"), span.alias("date"))
    options = {"wants_lists": ["date"], "wants_dates": True, "seconds_since_epoch": "1990-01-01", "add_hours_to_date": 3}
    return R.apply_mapping(raw, {"options": options}).select("request_id", joined("date").alias("seconds"))
