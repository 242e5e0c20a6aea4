"""The driver's tables seen as requests, constraints, fields, cells and observations.

Each view exists as a DataFrame and as SQL.  All of them use every row of the
tables they read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.tables import table

VARIABLE_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4}

SQL_VIEWS = {
    "v_obs": """
SELECT event_id AS observation_id, ts AS report_timestamp, CAST(user_id AS VARCHAR) AS primary_station_id,
 CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS observed_variable_code,
 event_type AS observed_variable, value AS observation_value,
 CAST((user_id * 7) % 181 AS DOUBLE) - 90.0 AS latitude, CAST((user_id * 13) % 360 AS DOUBLE) - 180.0 AS longitude,
 CAST(event_id % 3 AS INTEGER) AS processing_level FROM events""",
    "v_grid": """
SELECT event_type AS variable, date_trunc('hour', ts) AS valid_time, CAST(user_id % 6 AS DOUBLE) * 30 - 75 AS latitude,
 CAST(event_id % 6 AS DOUBLE) * 60 + 30 AS longitude, avg(value) AS value FROM events GROUP BY 1, 2, 3, 4""",
    "v_field": """
SELECT DISTINCT CAST(c_nationkey * 10000 + year(o_orderdate) AS BIGINT) AS dataset,
 CAST(o_custkey * 10000 + year(o_orderdate) AS BIGINT) AS request_id,
 o_orderpriority AS param, o_orderstatus AS type, CAST(o_orderdate AS DATE) AS d
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_req": """
SELECT dataset, request_id, list_sort(list(DISTINCT param)) AS param, list_sort(list(DISTINCT type)) AS type,
 list_sort(list(DISTINCT d)) AS d FROM v_field GROUP BY dataset, request_id""",
    "v_cube": """
SELECT dataset, request_id, u.param AS param, u.type AS type, u.d AS d
FROM (SELECT dataset, request_id, param, type, unnest(d) AS d FROM
 (SELECT dataset, request_id, param, unnest(type) AS type, d FROM
 (SELECT dataset, request_id, unnest(param) AS param, type, d FROM v_req))) u""",
    "v_con": """
SELECT CAST(c_nationkey * 10000 + year(o_orderdate) AS BIGINT) AS dataset,
 CAST(c_nationkey * 1000000 + year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS constraint_id,
 list_sort(list(DISTINCT o_orderpriority)) AS param,
 CASE WHEN month(o_orderdate) % 2 = 0 THEN NULL ELSE list_sort(list(DISTINCT o_orderstatus)) END AS type,
 CAST(min(o_orderdate) AS DATE) AS d_start, CAST(max(o_orderdate) AS DATE) AS d_end
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_nationkey, year(o_orderdate), month(o_orderdate)""",
    "v_sel": """
SELECT dataset, request_id, param, CASE WHEN request_id % 3 = 0 THEN NULL ELSE type END AS type FROM v_req""",
    "v_stored": """
SELECT DISTINCT o_orderpriority AS param, o_orderstatus AS type, CAST(o_orderdate AS DATE) AS d
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""",
    "v_area": """
SELECT c_custkey AS request_id, CAST((c_custkey * 7) % 80 AS DOUBLE) + 0.123 AS north,
 CAST((c_custkey * 13) % 300 AS DOUBLE) - 170.345 AS west, CAST((c_custkey * 7) % 80 AS DOUBLE) - 9.456 AS south,
 CAST((c_custkey * 13) % 300 AS DOUBLE) - 150.789 AS east FROM customer""",
    "v_site": """
SELECT s_suppkey AS site_id, CAST((s_suppkey * 11) % 90 AS DOUBLE) - 9.0 AS latitude,
 CAST((s_suppkey * 29) % 320 AS DOUBLE) - 170.0 AS longitude, s_name AS tag FROM supplier""",
    "v_header": """
SELECT l_orderkey AS file_id, l_linenumber AS message_id, l_returnflag AS flag, l_linestatus AS status,
 CAST(l_quantity AS BIGINT) AS forecast_time, CAST(l_shipdate AS DATE) AS data_date, l_partkey AS parameter,
 l_suppkey AS grid_header FROM lineitem""",
    "v_fetch": """
SELECT page_id AS fetch_id, page_id // 5 AS request_id, url,
 CASE page_id % 11 WHEN 0 THEN 404 WHEN 3 THEN 503 ELSE 200 END AS status,
 CASE page_id % 13 WHEN 0 THEN 'ftp_550' WHEN 5 THEN 'read_timeout' ELSE '' END AS failure FROM pages""",
}


def v_obs(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    code = F.lit(5)
    for name, number in VARIABLE_CODES.items():
        code = F.when(kind == name, number).otherwise(code)
    return table(spark, folder, "events").select(
        F.col("event_id").alias("observation_id"),
        F.col("ts").alias("report_timestamp"),
        F.col("user_id").cast("string").alias("primary_station_id"),
        code.alias("observed_variable_code"),
        kind.alias("observed_variable"),
        F.col("value").alias("observation_value"),
        (((F.col("user_id") * 7) % 181).cast("double") - 90.0).alias("latitude"),
        (((F.col("user_id") * 13) % 360).cast("double") - 180.0).alias("longitude"),
        (F.col("event_id") % 3).cast("int").alias("processing_level"),
    )


def v_grid(spark: SparkSession, folder: str) -> DataFrame:
    cell = table(spark, folder, "events").select(
        F.col("event_type").alias("variable"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("valid_time"),
        ((F.col("user_id") % 6).cast("double") * 30 - 75).alias("latitude"),
        ((F.col("event_id") % 6).cast("double") * 60 + 30).alias("longitude"),
        "value",
    )
    return cell.groupBy("variable", "valid_time", "latitude", "longitude").agg(F.avg("value").alias("value"))


def _orders_with_nation(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def _dataset() -> Column:
    return (F.col("c_nationkey") * 10000 + F.year("o_orderdate")).cast("bigint")


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_with_nation(spark, folder).select(
        _dataset().alias("dataset"),
        (F.col("o_custkey") * 10000 + F.year("o_orderdate")).cast("bigint").alias("request_id"),
        F.col("o_orderpriority").alias("param"),
        F.col("o_orderstatus").alias("type"),
        F.to_date("o_orderdate").alias("d"),
    )


def v_field(spark: SparkSession, folder: str) -> DataFrame:
    return _asked(spark, folder).distinct()


def v_req(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as cubes: one sorted array of distinct values per key."""
    return (
        _asked(spark, folder)
        .groupBy("dataset", "request_id")
        .agg(*[F.array_sort(F.collect_set(k)).alias(k) for k in ("param", "type", "d")])
    )


def v_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Every field of the request cubes."""
    return (
        v_req(spark, folder)
        .withColumn("param", F.explode("param"))
        .withColumn("type", F.explode("type"))
        .withColumn("d", F.explode("d"))
    )


def v_con(spark: SparkSession, folder: str) -> DataFrame:
    month = F.month("o_orderdate")
    return (
        _orders_with_nation(spark, folder)
        .groupBy(
            _dataset().alias("dataset"),
            (F.col("c_nationkey") * 1000000 + F.year("o_orderdate") * 100 + month)
            .cast("bigint")
            .alias("constraint_id"),
        )
        .agg(
            F.array_sort(F.collect_set("o_orderpriority")).alias("param"),
            F.array_sort(F.collect_set("o_orderstatus")).alias("type"),
            F.to_date(F.min("o_orderdate")).alias("d_start"),
            F.to_date(F.max("o_orderdate")).alias("d_end"),
        )
        .withColumn("type", F.when(F.col("constraint_id") % 2 == 1, F.col("type")))
    )


def v_sel(spark: SparkSession, folder: str) -> DataFrame:
    """Selections: some leave a key open."""
    return v_req(spark, folder).select(
        "dataset", "request_id", "param", F.when(F.col("request_id") % 3 != 0, F.col("type")).alias("type")
    )


def v_stored(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return (
        orders.join(returned, orders.o_orderkey == returned.l_orderkey, "left_semi")
        .select(
            F.col("o_orderpriority").alias("param"),
            F.col("o_orderstatus").alias("type"),
            F.to_date("o_orderdate").alias("d"),
        )
        .distinct()
    )


def v_area(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    lat = ((key * 7) % 80).cast("double")
    lon = ((key * 13) % 300).cast("double")
    return table(spark, folder, "customer").select(
        key.alias("request_id"),
        (lat + 0.123).alias("north"),
        (lon - 170.345).alias("west"),
        (lat - 9.456).alias("south"),
        (lon - 150.789).alias("east"),
    )


def v_site(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("site_id"),
        (((key * 11) % 90).cast("double") - 9.0).alias("latitude"),
        (((key * 29) % 320).cast("double") - 170.0).alias("longitude"),
        F.col("s_name").alias("tag"),
    )


def v_header(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("file_id"),
        F.col("l_linenumber").alias("message_id"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("bigint").alias("forecast_time"),
        F.to_date("l_shipdate").alias("data_date"),
        F.col("l_partkey").alias("parameter"),
        F.col("l_suppkey").alias("grid_header"),
    )


def v_fetch(spark: SparkSession, folder: str) -> DataFrame:
    page = F.col("page_id")
    return table(spark, folder, "pages").select(
        page.alias("fetch_id"),
        F.floor(page / 5).cast("bigint").alias("request_id"),
        "url",
        F.when(page % 11 == 0, 404).when(page % 11 == 3, 503).otherwise(200).alias("status"),
        F.when(page % 13 == 0, "ftp_550").when(page % 13 == 5, "read_timeout").otherwise("").alias("failure"),
    )
