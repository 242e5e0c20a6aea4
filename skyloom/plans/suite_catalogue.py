"""Queries that match requests with catalogues, files, links and logs."""

from pyspark.sql import functions as F

from skyloom.functions.space import box_around
from skyloom.operators import catalogue as K
from skyloom.operators import windows as W
from skyloom.plans.registry import query
from skyloom.plans.views import v_area, v_cube, v_fetch, v_field, v_header, v_req, v_site, v_stored
from skyloom.sinks import files
from skyloom.sources import headers as H
from skyloom.sources import links as L
from skyloom.sources import service_errors as E
from skyloom.tables import table

KEYS = ["param", "type", "d"]
FIELD = "request_id, param, type, d"


@query(
    "s4_urls_from_fields",
    """SELECT request_id, unnest(['https://store/' || type || '/' || strftime(d, '%Y-%m-%d') || '.nc',
 'https://mirror/' || param || '?t=' || type]) AS url FROM v_cube""",
)
def s4(spark, d):
    patterns = ["https://store/{{ type }}/{{ d }}.nc", " https://mirror/{{param}}?t={{ type }} ", "https://x/{{ area }}", "  "]
    return L.expand(v_cube(spark, d), patterns).select("request_id", "url")


@query(
    "s5_fetch_plan",
    """SELECT DISTINCT url, ltrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS path FROM pages ORDER BY url""",
)
def s5(spark, d):
    return L.fetch_plan(table(spark, d, "pages"))


@query(
    "s6_fetch_outcome",
    """
WITH o AS (SELECT request_id, CASE WHEN status = 404 OR failure = 'ftp_550' THEN 'skipped' WHEN status >= 400 OR failure <> '' THEN 'fatal' ELSE 'ok' END AS r FROM v_fetch)
SELECT request_id, count(*) FILTER (WHERE r = 'ok') AS n_ok, count(*) FILTER (WHERE r = 'skipped') AS n_skipped,
 CASE WHEN bool_or(r = 'fatal') OR count_if(r = 'ok') = 0 THEN 'failed' WHEN count_if(r = 'skipped') > 0 THEN 'partial' ELSE 'complete' END AS result
FROM o GROUP BY 1""",
)
def s6(spark, d):
    return L.request_outcome(v_fetch(spark, d))


@query(
    "s6_timeouts_tolerated",
    """
WITH o AS (SELECT request_id, CASE WHEN status = 404 OR failure IN ('ftp_550', 'read_timeout') THEN 'skipped' WHEN status >= 400 THEN 'fatal' ELSE 'ok' END AS r FROM v_fetch)
SELECT request_id, count(*) FILTER (WHERE r = 'ok') AS n_ok, count(*) FILTER (WHERE r = 'skipped') AS n_skipped,
 CASE WHEN bool_or(r = 'fatal') OR count_if(r = 'ok') = 0 THEN 'failed' WHEN count_if(r = 'skipped') > 0 THEN 'partial' ELSE 'complete' END AS result
FROM o GROUP BY 1""",
)
def s6_tolerant(spark, d):
    return L.request_outcome(v_fetch(spark, d), timeouts_are_fatal=False)


@query(
    "s7_classify_headers",
    """SELECT file_id, message_id, CASE WHEN flag = 'A' AND status = 'F' THEN 'ozone' WHEN flag = 'A' THEN 'dust' WHEN flag = 'N' THEN 'ozone' ELSE '' END AS variable,
 CASE WHEN status = 'F' THEN 'ANALYSIS' ELSE 'FORECAST' END AS type, strftime(data_date, '%Y-%m-%d') AS date,
 CASE WHEN status = 'F' THEN '0' ELSE CAST(forecast_time AS VARCHAR) END AS step FROM v_header""",
)
def s7(spark, d):
    head = v_header(spark, d)
    variables = [{"name": "ozone", "flag": "A", "status": "F"}, {"name": "dust", "flag": "A"}, {"name": "ozone", "flag": "N"}]
    types = [{"name": "ANALYSIS", "status": "F"}, {"name": "FORECAST", "status": "O"}]
    columns = {"flag": F.col("flag"), "status": F.col("status")}
    variable = H.classify(variables, columns)
    kind = H.classify(types, columns)
    step = F.when(kind == "ANALYSIS", F.lit("0")).otherwise(F.col("forecast_time").cast("string"))
    return head.select(
        "file_id",
        "message_id",
        F.coalesce(variable, F.lit("")).alias("variable"),
        kind.alias("type"),
        F.date_format("data_date", "yyyy-MM-dd").alias("date"),
        step.alias("step"),
    )


@query(
    "s7_unknown_headers",
    "SELECT flag, status, count(*) AS n FROM v_header WHERE flag = 'R' GROUP BY 1, 2",
)
def s7_unknown(spark, d):
    variable = H.classify([{"name": "ozone", "flag": "A"}, {"name": "dust", "flag": "N"}], {"flag": F.col("flag")})
    head = v_header(spark, d).where(variable.isNull())
    return head.groupBy("flag", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s8_split_files_on_headers",
    """
WITH s AS (SELECT file_id, list_sort(list(DISTINCT flag)) AS flags, list_sort(list(DISTINCT status)) AS statuses,
 list_sort(list(DISTINCT CAST(message_id AS VARCHAR))) AS messages FROM v_header GROUP BY 1)
SELECT file_id, CASE WHEN len(statuses) > 1 THEN tag || '_message_id-' || message ELSE tag END AS tag FROM
 (SELECT file_id, statuses, tag, unnest(CASE WHEN len(statuses) > 1 THEN messages ELSE ['-'] END) AS message FROM
 (SELECT file_id, statuses, messages, 'base_flag-' || unnest(flags) AS tag FROM s))""",
)
def s8(spark, d):
    return H.split_tags(v_header(spark, d), "file_id", ["flag"], {"status": "message_id"}, base="base")


PHRASES = {"no data": ["the of", "que de"], "bad request": ["AND THE", "un la"]}


@query(
    "s9_classify_service_errors",
    """
WITH g AS (SELECT doc_id // 2 AS request_id, CASE WHEN contains(lower(text), 'un la') OR contains(lower(text), 'and the') THEN 'bad request'
 WHEN contains(lower(text), 'que de') OR contains(lower(text), 'the of') THEN 'no data' END AS g FROM documents)
SELECT request_id, count(*) AS n_errors, CASE WHEN count(*) = 1 AND min(g) IS NOT NULL THEN min(g) ELSE 'retry' END AS verdict FROM g GROUP BY 1
UNION ALL SELECT -1 - doc_id, 1, coalesce(CASE WHEN contains(lower(text), 'un la') OR contains(lower(text), 'and the') THEN 'bad request'
 WHEN contains(lower(text), 'que de') OR contains(lower(text), 'the of') THEN 'no data' END, 'retry') FROM documents""",
)
def s9(spark, d):
    documents = table(spark, d, "documents")
    pairs = documents.select(F.floor(F.col("doc_id") / 2).cast("bigint").alias("request_id"), "text")
    singles = documents.select((-1 - F.col("doc_id")).alias("request_id"), "text")
    log = pairs.unionByName(singles)
    return E.classify_errors(log, ["request_id"], "text", PHRASES).drop("shown")


@query(
    "s9_tidy_error_text",
    """SELECT page_id, 'no grid; ' || url AS shown FROM pages""",
)
def s9_tidy(spark, d):
    text = F.concat(F.lit("Process error:   Failed to execute WPS process [sun]: no grid\n\n   "), F.col("url"), F.lit(" \n"))
    return table(spark, d, "pages").select("page_id", E.tidy(text).alias("shown"))


@query(
    "k4_field_paths",
    """
WITH keep AS (SELECT * FROM v_stored)
SELECT request_id, CASE WHEN keep.param IS NULL THEN 'temporary' ELSE 'permanent' END || '/' || strftime(f.d, '%Y-%m-%d') || '/type=' || f.type
 || '_variable=' || md5(f.param) AS path FROM v_field f LEFT JOIN keep ON f.param = keep.param AND f.type = keep.type AND f.d = keep.d""",
)
def k4(spark, d):
    fields = files.tier_of(v_field(spark, d), v_stored(spark, d), KEYS)
    named = fields.select(
        "request_id", "tier", F.col("d").alias("date"), "type", F.md5("param").alias("variable")
    )
    return named.select("request_id", files.field_path(["date", "type", "variable"], F.col("tier")).alias("path"))


@query(
    "k4_unsafe_values",
    """SELECT param, count(*) AS n FROM v_field WHERE NOT regexp_full_match(param, '[A-Za-z0-9_.:-]+') GROUP BY 1""",
)
def k4_unsafe(spark, d):
    path = files.field_path(["date", "param"], F.lit("temporary"))
    unsafe = v_field(spark, d).withColumnRenamed("d", "date").where(path.isNull())
    return unsafe.groupBy("param").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k7_receipts",
    """SELECT o_orderkey AS request_id, 'dataset-' || c_nationkey AS collection_id, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'successful' END AS status,
 c_mktsegment || ' licence (version ' || (c_custkey % 7) || ')' AS licence, CASE o_orderstatus WHEN 'F' THEN 'no data' ELSE '' END AS message,
 CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice, 2) ELSE -1 END AS download_size
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def k7(spark, d):
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    jobs = orders.select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("collection_id"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("successful").alias("status"),
        F.when(F.col("o_orderstatus") == "F", "no data").alias("message"),
    )
    licence = F.struct(F.concat("c_mktsegment", F.lit(" licence")).alias("title"), (F.col("c_custkey") % 7).alias("revision"))
    collections = customer.select(
        F.col("c_custkey").alias("collection_id"),
        F.concat(F.lit("dataset-"), F.col("c_nationkey")).alias("name"),
        F.array(licence).alias("licences"),
    )
    results = orders.where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("request_id"), F.round("o_totalprice", 2).alias("download_size")
    )
    receipt = K.receipts(jobs, collections, results)
    return receipt.select(
        "request_id",
        F.col("name").alias("collection_id"),
        "status",
        F.array_join("licence", "; ").alias("licence"),
        F.coalesce("message", F.lit("")).alias("message"),
        F.coalesce("download_size", F.lit(-1.0)).alias("download_size"),
    )


@query(
    "k7_receipt_json",
    """SELECT o_orderkey AS request_id, '{"request_id":' || o_orderkey || ',"collection_id":' || o_custkey || ',"status":"' || o_orderstatus || '"'
 || CASE WHEN o_orderstatus = 'F' THEN ',"message":"no data"' ELSE '' END || ',"licence":["' || c_mktsegment || ' (version 2)"]}' AS receipt
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def k7_json(spark, d):
    results = table(spark, d, "orders").select(F.col("o_orderkey").alias("request_id")).where("false")
    return K.receipt_json(receipts_of(spark, d, results))


@query(
    "k7_receipt_json_of_results",
    """WITH r AS (SELECT l_orderkey, 'order-' || l_orderkey || '.zip' AS file_name, CAST(sum(l_quantity) AS BIGINT) AS download_size FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' GROUP BY l_orderkey)
SELECT o_orderkey AS request_id, '{"request_id":' || o_orderkey || ',"collection_id":' || o_custkey || ',"status":"' || o_orderstatus || '"'
 || CASE WHEN o_orderstatus = 'F' THEN ',"message":"no data"' ELSE '' END || ',"licence":["' || c_mktsegment || ' (version 2)"]'
 || CASE WHEN r.file_name IS NULL THEN '' ELSE ',"file_name":"' || r.file_name || '","download_size":' || r.download_size END || '}' AS receipt
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN r ON o_orderkey = l_orderkey""",
)
def k7_json_of_results(spark, d):
    delivered = table(spark, d, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("request_id"))
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "request_id").join(delivered, "request_id")
    results = lines.groupBy("request_id").agg(F.sum("l_quantity").cast("bigint").alias("download_size"))
    name = F.concat(F.lit("order-"), F.col("request_id").cast("string"), F.lit(".zip"))
    return K.receipt_json(receipts_of(spark, d, results.select("request_id", name.alias("file_name"), "download_size")))


def receipts_of(spark, d, results):
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    jobs = orders.select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("collection_id"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "F", "no data").alias("message"),
    )
    licence = F.struct(F.col("c_mktsegment").alias("title"), F.lit(2).alias("revision"))
    collections = customer.select(F.col("c_custkey").alias("collection_id"), F.array(licence).alias("licences"))
    held = [c for c in results.columns if c != "request_id"]
    return K.receipts(jobs, collections, results).select("request_id", "collection_id", "status", "message", "licence", *held)


@query(
    "j4_points_in_boxes",
    """SELECT request_id, string_agg(tag, ',' ORDER BY site_id) AS tags FROM v_area a JOIN v_site s
 ON s.latitude < a.north AND s.longitude > a.west AND s.latitude > a.south AND s.longitude < a.east GROUP BY 1""",
)
def j4(spark, d):
    mapped = K.map_areas_to_values(v_area(spark, d), v_site(spark, d), "tag", "site_id")
    return mapped.select("request_id", F.array_join("values", ",").alias("tags"))


FEATURE_SQL = """feature AS (SELECT site_id, latitude + 3 AS f_north, longitude - 4 AS f_west, latitude - 3 AS f_south, longitude + 4 AS f_east FROM v_site)"""
MEET = "f_south <= north AND f_north >= south AND f_west <= east AND f_east >= west"


def features(spark, d):
    return v_site(spark, d).select(
        "site_id",
        (F.col("latitude") + 3).alias("north"),
        (F.col("longitude") - 4).alias("west"),
        (F.col("latitude") - 3).alias("south"),
        (F.col("longitude") + 4).alias("east"),
    )


@query("j5_features_in_box", f"WITH {FEATURE_SQL} SELECT request_id, site_id FROM v_area JOIN feature ON {MEET}")
def j5(spark, d):
    return K.overlapping_features(v_area(spark, d), features(spark, d), columns=["request_id", "site_id"])


@query(
    "j5_features_at_point",
    f"""WITH {FEATURE_SQL}, p AS (SELECT request_id, north + 0.5 AS north, north - 0.5 AS south, west - 0.5 AS west, west + 0.5 AS east FROM v_area)
SELECT request_id, count(*) AS n_features FROM p JOIN feature ON {MEET} GROUP BY 1""",
)
def j5_point(spark, d):
    box = box_around(F.col("north"), F.col("west"))
    around = v_area(spark, d).select("request_id", *[v.alias(k) for k, v in box.items()])
    numbers = K.overlapping_features(around, features(spark, d), columns=["request_id"], counted="n")
    return numbers.groupBy("request_id").agg(F.sum("n").alias("n_features"))


@query(
    "j5_requests_without_feature",
    f"WITH {FEATURE_SQL} SELECT request_id FROM v_area WHERE NOT EXISTS (SELECT 1 FROM feature WHERE {MEET})",
)
def j5_none(spark, d):
    areas = v_area(spark, d)
    hits = K.overlapping_features(areas, features(spark, d), columns=["request_id"], counted="n")
    hits = hits.select("request_id").distinct()
    return areas.join(hits, "request_id", "left_anti").select("request_id")


@query(
    "t2_first_features_per_request",
    f"""WITH {FEATURE_SQL} SELECT request_id, site_id FROM (SELECT request_id, site_id, row_number() OVER (PARTITION BY request_id ORDER BY site_id) AS rn
 FROM v_area JOIN feature ON {MEET}) WHERE rn <= 2""",
)
def t2(spark, d):
    pairs = K.overlapping_features(
        v_area(spark, d), features(spark, d), columns=["request_id", "site_id"], at_most=("site_id", 2)
    )
    return K.first_features(pairs, ["request_id"], "site_id", 2).select("request_id", "site_id")


@query(
    "j6_split_by_store",
    f"""SELECT {FIELD}, CASE WHEN (param, type, d) IN (SELECT (param, type, d) FROM v_stored) THEN 'latest' ELSE 'archived' END AS backend FROM v_field""",
)
def j6(spark, d):
    return K.split_by_store(v_field(spark, d), v_stored(spark, d), KEYS).select("request_id", *KEYS, "backend")


@query(
    "j7_delivered_or_missing",
    """
WITH w AS (SELECT DISTINCT param, type, d FROM v_cube), g AS (SELECT * FROM v_stored)
SELECT coalesce(w.param, g.param) AS param, coalesce(w.type, g.type) AS type, coalesce(w.d, g.d) AS d,
 CASE WHEN w.param IS NULL THEN 'unexpected' WHEN g.param IS NULL THEN 'missing' ELSE 'delivered' END AS state,
 CASE WHEN g.param IS NULL THEN 'archived' ELSE '' END AS backend
FROM w FULL JOIN g ON w.param = g.param AND w.type = g.type AND w.d = g.d""",
)
def j7(spark, d):
    state = K.delivered_or_missing(v_cube(spark, d), v_stored(spark, d), KEYS)
    return state.withColumn("backend", F.coalesce("backend", F.lit("")))


def number_and_first():
    return [F.count(F.lit(1)).alias("n_candidates"), F.min("p_partkey").alias("first_candidate")]


def of_requests(found):  # rows of one request may ask for different things
    return found.groupBy("request_id").agg(
        F.sum("n_candidates").alias("n_candidates"), F.min("first_candidate").alias("first_candidate")
    )


@query(
    "j8_facet_search",
    """
WITH c AS (SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'low' ELSE p_brand END AS brand, p_type AS kind, p_name FROM part),
r AS (SELECT s_suppkey AS request_id, CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 THEN 'low' ELSE 'Brand#' || (s_suppkey % 25 + 1) END AS brand,
 CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN 'SMALL' ELSE 'LARGE' END AS kind FROM supplier)
SELECT request_id, count(*) AS n_candidates, min(p_partkey) AS first_candidate FROM r JOIN c
 ON (r.brand IS NULL OR r.brand = c.brand) AND (r.kind IS NULL OR r.kind = c.kind) WHERE regexp_matches(p_name, '^(small|red)')
 AND (r.request_id % 5 > 0 OR regexp_matches(p_name, 'ring$')) GROUP BY 1""",
)
def j8(spark, d):
    candidates = table(spark, d, "part").select(
        "p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), "p_name"
    )
    key = F.col("s_suppkey")
    brand = F.when(key % 4 == 1, F.lit("low")).when(key % 4 > 1, F.concat(F.lit("Brand#"), (key % 25 + 1).cast("string")))
    kind = F.when(key % 3 == 1, F.lit("SMALL")).when(key % 3 == 2, F.lit("LARGE"))
    noun = F.when(key % 5 == 0, F.lit("ring"))
    wanted = table(spark, d, "supplier").select(
        key.alias("request_id"), brand.alias("brand"), kind.alias("kind"), noun.alias("p_name")
    )
    named = candidates.where(F.col("p_name").rlike("^(small|red)"))
    groups = {"brand": {"low": ["Brand#1", "Brand#2", "Brand#3"]}}
    found = K.facet_candidates(wanted, named, ["brand", "kind"], groups, {"p_name": "{p_name}$"}, number_and_first())
    return of_requests(found)


@query(
    "j8_first_facet_open",
    """
SELECT r.o_orderkey AS request_id, count(*) AS n_candidates, min(p_partkey) AS first_candidate FROM orders r JOIN part p
 ON p.p_type = CASE WHEN o_orderkey % 2 = 0 THEN 'SMALL' ELSE 'LARGE' END AND p.p_size = o_custkey % 50 + 1
 AND (o_orderkey % 3 > 0 OR p.p_brand = 'Brand#' || (o_custkey % 25 + 1)) GROUP BY 1""",
)
def j8_open(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_size").cast("string").alias("size")
    )
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    wanted = table(spark, d, "orders").select(
        order.alias("request_id"),
        F.when(order % 3 == 0, F.concat(F.lit("Brand#"), (customer % 25 + 1).cast("string"))).alias("brand"),
        F.when(order % 2 == 0, "SMALL").otherwise("LARGE").alias("kind"),
        (customer % 50 + 1).cast("string").alias("size"),
    )
    found = K.facet_candidates(wanted, parts, ["brand", "kind", "size"], {}, summary=number_and_first())
    return of_requests(found)


@query(
    "j9_conditional_tags",
    """
SELECT request_id, 'recent' AS tag FROM v_field GROUP BY 1 HAVING bool_and(d BETWEEN DATE '1999-06-01' AND DATE '2000-05-31' AND type IN ('O', 'P'))
UNION ALL SELECT request_id, 'urgent' FROM v_field GROUP BY 1 HAVING bool_and((param = '1-URGENT' AND type = 'F') OR param IN ('2-HIGH', '5-LOW'))""",
)
def j9(spark, d):
    from datetime import date

    conditions = {
        "recent": [{"d": [(date(1999, 6, 1), date(2000, 5, 31))], "type": ["O", "P"]}],
        "urgent": [{"param": ["1-URGENT"], "type": ["F"]}, {"param": ["2-HIGH", "5-LOW"]}],
    }
    return K.conditional_tags(v_field(spark, d), conditions, ["request_id"])


@query(
    "j9_relative_dates",
    """
SELECT request_id, 'recent' AS tag FROM v_field GROUP BY 1 HAVING bool_and(d BETWEEN DATE '1998-01-02' AND DATE '1998-06-01')
UNION ALL SELECT request_id, 'since' FROM v_field GROUP BY 1 HAVING bool_and(d BETWEEN DATE '1996-02-01' AND DATE '1998-05-30' AND type = 'O')""",
)
def j9_relative(spark, d):
    conditions = {
        "recent": [{"d": ["current-150/current"]}],
        "since": [{"d": ["1996-02-01/current-2"], "type": ["O"]}],
    }
    as_of = F.lit("1998-06-01 09:30:00").cast("timestamp")
    return K.conditional_tags(v_field(spark, d), conditions, ["request_id"], as_of)


@query(
    "j9_missing_key",
    """SELECT request_id, 'urgent' AS tag FROM v_field GROUP BY 1 HAVING bool_and(param = '1-URGENT')""",
)
def j9_missing(spark, d):
    conditions = {"deep": [{"depth": ["5"], "type": ["O"]}], "urgent": [{"depth": ["5"]}, {"param": ["1-URGENT"]}]}
    return K.conditional_tags(v_field(spark, d), conditions, ["request_id"])


@query(
    "p16_facet_ids",
    """SELECT p_partkey, concat_ws('.', 'open', CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END, p_brand,
 concat_ws('-', CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END, CAST(p_size AS VARCHAR))) AS facet_id FROM part""",
)
def p16(spark, d):
    key = F.col("p_partkey")
    dashed = [F.when(key % 3 != 0, F.col("p_name")), F.col("p_size").cast("string")]
    dotted = [F.lit("open"), F.when(key % 4 != 0, F.col("p_type")), F.col("p_brand")]
    return table(spark, d, "part").select("p_partkey", K.facet_id(dashed, dotted).alias("facet_id"))


@query(
    "p17_subset_arguments",
    """
WITH r AS (SELECT request_id, list_sort(list(DISTINCT CAST(year(d) AS VARCHAR))) AS years, list_sort(list(DISTINCT month(d))) AS months,
 list_sort(list(DISTINCT strftime(d, '%d'))) AS days FROM v_field GROUP BY 1)
SELECT request_id, years[1] || '/' || years[-1] AS "time", 'day:' || array_to_string(days, ',') || '|month:' ||
 array_to_string([lower(strftime(make_date(2000, m, 1), '%b')) for m in months], ',') || '|year:' || array_to_string(years, ',') AS time_components,
 '500,' || (request_id % 9) AS level, '-10,20,30,' || (request_id % 80) AS area FROM r""",
)
def p17(spark, d):
    parts = v_field(spark, d).groupBy("request_id").agg(
        F.array_sort(F.collect_set(F.year("d").cast("string"))).alias("years"),
        F.transform(F.array_sort(F.collect_set(F.month("d"))), lambda m: m.cast("string")).alias("months"),
        F.array_sort(F.collect_set(F.date_format("d", "dd"))).alias("days"),
    )
    level = (F.col("request_id") % 9).cast("string")
    levels = F.array(F.lit("500.5"), F.lit("surface"), level)
    area = F.array((F.col("request_id") % 80).cast("string"), F.lit("-10"), F.lit("20"), F.lit("30"))
    arguments = K.subset_arguments(F.col("years"), F.col("months"), F.col("days"), levels, area)
    return parts.select("request_id", *[v.alias(k) for k, v in arguments.items()])


@query(
    "t1_sorted_unique",
    """SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages ORDER BY host""",
)
def t1(spark, d):
    host = F.try_parse_url("url", F.lit("HOST"))
    return table(spark, d, "pages").select(host.alias("host")).distinct().orderBy("host")


@query(
    "t4_files_by_type",
    """
WITH p AS (SELECT ltrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') || CASE page_id % 3 WHEN 0 THEN '.nc' WHEN 1 THEN '.tar.gz' ELSE '' END AS path FROM pages)
SELECT coalesce(nullif(regexp_extract(path, '[.]([^./]+)$', 1), ''), 'unknown') AS type, count(*) AS n_files FROM p GROUP BY 1""",
)
def t4(spark, d):
    key = F.col("page_id") % 3
    suffix = F.when(key == 0, ".nc").when(key == 1, ".tar.gz").otherwise("")
    paths = table(spark, d, "pages").select(F.concat(L.url_path(F.col("url")), suffix).alias("path"))
    return L.group_by_type(paths)


@query(
    "w3_overlapping_validity",
    """
WITH f AS (SELECT request_id, CAST(d AS TIMESTAMP) AS base, CAST(ascii(type) % 5 AS BIGINT) * 24 * 10 AS step FROM v_field),
s AS (SELECT request_id, base, min(base + to_hours(step)) AS first, max(base + to_hours(step)) AS last FROM f GROUP BY 1, 2),
n AS (SELECT *, lead(first) OVER (PARTITION BY request_id ORDER BY base) AS next FROM s)
SELECT request_id, coalesce(bool_or(last >= next), false) AS overlapping FROM n GROUP BY 1""",
)
def w3(spark, d):
    fields = v_field(spark, d).select(
        "request_id",
        F.col("d").cast("timestamp_ntz").alias("base"),
        ((F.ascii("type") % 5) * 240).cast("int").alias("step"),
    )
    return W.overlapping_validity(fields, ["request_id"], "base", "step")


@query(
    "h10_export_groups",
    """
WITH f AS (SELECT request_id, type, CAST(d AS TIMESTAMP) AS base, CAST(ascii(param) % 5 AS BIGINT) * 240 AS step FROM v_field),
s AS (SELECT request_id, type, base, min(base + to_hours(step)) AS first, max(base + to_hours(step)) AS last FROM f GROUP BY 1, 2, 3),
n AS (SELECT *, lead(first) OVER (PARTITION BY request_id, type ORDER BY base) AS next FROM s),
o AS (SELECT request_id, type, coalesce(bool_or(last >= next), false) AS apart FROM n GROUP BY 1, 2)
SELECT request_id || '_' || type || CASE WHEN apart THEN '_' || strftime(base, '%Y-%m-%d') ELSE '' END AS "group", count(*) AS n_fields
FROM f JOIN o USING (request_id, type) GROUP BY 1""",
)
def h10_export(spark, d):
    fields = v_field(spark, d).select(
        "request_id",
        "type",
        F.col("d").cast("timestamp_ntz").alias("base"),
        ((F.ascii("param") % 5) * 240).cast("int").alias("step"),
    )
    grouped = W.export_groups(fields, ["request_id", "type"], "base", "step")
    return grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n_fields"))


@query(
    "w6_validity_axis",
    """
WITH m AS (SELECT o_orderkey, l_linestatus, o_orderdate AS base, CAST(l_linenumber AS BIGINT) * 6 AS step FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
f AS (SELECT l_linestatus, min(base) AS first FROM m GROUP BY 1)
SELECT l_linestatus, strftime(base, '%Y-%m-%d %H') AS base, strftime(base + to_hours(step), '%Y-%m-%d %H') AS valid_time,
 date_diff('hour', first, base) AS reference_hours, count(*) AS n, count(*) = 1 AS "unique"
FROM m JOIN f USING (l_linestatus) GROUP BY 1, 2, 3, 4""",
)
def w6(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("base"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus", (F.col("l_linenumber") * 6).cast("int").alias("step"))
    axis = W.validity_axis(orders.join(lines, "l_orderkey"), ["l_linestatus"], "base", "step")
    shown = {c: F.date_format(c, "yyyy-MM-dd HH") for c in ("base", "valid_time")}
    return axis.withColumns(shown)


@query(
    "a16_duplicate_fields",
    "SELECT file_id, message_id, flag, count(*) AS n FROM v_header GROUP BY 1, 2, 3 HAVING count(*) > 1",
)
def a16(spark, d):
    return H.duplicate_fields(v_header(spark, d), ["file_id", "message_id", "flag"])


@query(
    "a16_one_grid_per_file",
    """SELECT file_id, count(DISTINCT (grid_header, flag)) AS n_grids, count(DISTINCT (grid_header, flag)) = 1 AS same_grid FROM v_header GROUP BY 1""",
)
def a16_grid(spark, d):
    return H.same_grid(v_header(spark, d), ["file_id"], ["grid_header", "flag"])
