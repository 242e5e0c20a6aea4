"""Queries that check and repair tables of requests."""

from pyspark.sql import functions as F

from skyloom.functions import text as X
from skyloom.operators import rules as V
from skyloom.plans.registry import query
from skyloom.plans.views import v_field, v_req, v_sel
from skyloom.tables import table


def joined(column):
    return F.coalesce(F.array_join(column, ","), F.lit(""))


def raw_requests(spark, d):
    """Requests with the usual flaws: packed lists, repeats, compact dates, missing keys, short items."""
    req = v_req(spark, d)
    packed = F.array(F.array_join("param", "/"), F.lit(""))
    compact = F.transform("d", lambda x, i: F.when(i % 2 == 0, F.date_format(x, "yyyyMMdd")).otherwise(F.date_format(x, "yyyy-MM-dd")))
    return req.select(
        "request_id",
        packed.alias("param"),
        F.when(F.col("request_id") % 3 != 0, F.concat("type", "type")).alias("type"),
        compact.alias("d"),
        F.array(F.col("request_id").cast("string")).alias("number"),
    )


RULES = [
    V.Rule("param", required=True, split_on="/", min_length=1, delete_if_short=True, min_items=1, max_items=3),
    V.Rule("type", required=True, default=["O"], unique="remove", allowed=["O", "F"]),
    V.Rule("d", required=True, format="date range", allowed_formats=["yyyyMMdd"]),
    V.Rule("number", kind="integer", min_items=1, max_items=1, maximum={0: 14000000.0}),
]

CHECKED = """
WITH k AS (SELECT request_id, array_to_string(param, ',') AS params, len(param) AS n_params, param,
 CASE WHEN request_id % 3 = 0 THEN ['O'] ELSE type END AS type, d FROM v_req),
m AS (SELECT *, CASE WHEN n_params > 3 THEN 'request[''param'']: [''' || array_to_string(param, ''', ''') || '''] list has too many items. Should have no more than 3' END AS e1,
 CASE WHEN list_contains(type, 'P') THEN 'request[''type''][' || (list_position(type, 'P') - 1) || ']: ''P'' is not one of [''O'', ''F'']' END AS e2,
 CASE WHEN request_id > 14000000 THEN 'request[''number''][0]: ' || CAST(request_id AS DOUBLE)::VARCHAR || ' is greater than the maximum of 14000000.0' END AS e3 FROM k)
"""


@query(
    "v1_enforce_good_requests",
    CHECKED
    + """SELECT request_id, params, array_to_string(type, ',') AS types,
 array_to_string([strftime(x, '%Y-%m-%d') || '/' || strftime(x, '%Y-%m-%d') for x in d], ',') AS dates FROM m
WHERE e1 IS NULL AND e2 IS NULL AND e3 IS NULL""",
)
def v1(spark, d):
    good, _ = V.enforce(raw_requests(spark, d), RULES)
    return good.select(
        "request_id", joined("param").alias("params"), joined("type").alias("types"), joined("d").alias("dates")
    )


@query(
    "v1_enforce_rejects",
    CHECKED
    + """SELECT request_id, 'rules' AS rule_id, count(*) AS n_messages FROM
 (SELECT request_id, unnest([e1, e2, e3]) AS e FROM m) WHERE e IS NOT NULL GROUP BY 1""",
)
def v1_rejects(spark, d):
    _, rejects = V.enforce(raw_requests(spark, d), RULES)
    return rejects.groupBy("request_id", "rule_id").agg(F.count(F.lit(1)).alias("n_messages"))


@query(
    "v2_error_texts",
    CHECKED + """SELECT request_id, unnest([x for x in [e1, e2] if x IS NOT NULL]) AS message FROM m""",
)
def v2(spark, d):
    _, rejects = V.enforce(raw_requests(spark, d), RULES[:3])
    return rejects.select("request_id", "message")


@query(
    "v2_wording_of_rules",
    """
SELECT request_id, unnest(['request: missing mandatory key: ''step''',
 'request[''type'']: [''' || array_to_string(type, ''', ''') || ''']: list has too few items. Should have exactly 4',
 'request[''param''][0]: invalid value: ''' || param[1] || '''. Valid values must match regular expression ''^x''',
 'request[''d''][0]: "' || strftime(d[1], '%Y%m%d') || '" is not a valid date. Expected format is yyyy-mm-dd',
 'request[''hour''][0]: ''x' || (request_id % 7) || ''' is not a valid number',
 'request[''name'']: ''ab'': string is too short. Should have at least 3 character(s)']) AS message FROM v_req WHERE len(type) < 4""",
)
def v2_wording(spark, d):
    return wording(spark, d, F.slice("param", 1, 1), F.slice("d", 1, 1))


@query(
    "v2_wording_of_every_value",
    """
SELECT request_id, unnest(list_concat(['request: missing mandatory key: ''step''',
 'request[''type'']: [''' || array_to_string(type, ''', ''') || ''']: list has too few items. Should have exactly 4'],
 list_transform(param, lambda x, i: 'request[''param''][' || (i - 1) || ']: invalid value: ''' || x || '''. Valid values must match regular expression ''^x'''),
 list_transform(d, lambda x, i: 'request[''d''][' || (i - 1) || ']: "' || strftime(x, '%Y%m%d') || '" is not a valid date. Expected format is yyyy-mm-dd'),
 ['request[''hour''][0]: ''x' || (request_id % 7) || ''' is not a valid number',
 'request[''name'']: ''ab'': string is too short. Should have at least 3 character(s)'])) AS message FROM v_req WHERE len(type) < 4""",
)
def v2_every_value(spark, d):
    return wording(spark, d, F.col("param"), F.col("d"))


def wording(spark, d, param, days):
    rules = [
        V.Rule("step", required=True),
        V.Rule("type", min_items=4, max_items=4),
        V.Rule("param", pattern="^x"),
        V.Rule("d", format="date"),
        V.Rule("hour", kind="number"),
        V.Rule("name", scalar=True, min_length=3),
    ]
    req = v_req(spark, d).select(
        "request_id",
        F.lit(None).cast("array<string>").alias("step"),
        "type",
        param.alias("param"),
        F.transform(days, lambda x: F.date_format(x, "yyyyMMdd")).alias("d"),
        F.array(F.concat(F.lit("x"), (F.col("request_id") % 7).cast("string"))).alias("hour"),
        F.lit("ab").alias("name"),
    )
    _, rejects = V.enforce(req, rules)
    return rejects.select("request_id", "message")


@query("v3_list_to_scalar", "SELECT request_id, CASE WHEN len(param) = 1 THEN param[1] ELSE '' END AS param FROM v_req")
def v3(spark, d):
    return v_req(spark, d).select("request_id", F.coalesce(V.list_to_scalar(F.col("param")), F.lit("")).alias("param"))


@query("v4_scalar_to_list", "SELECT request_id, param, type || ':1' AS type, d FROM v_field")
def v4(spark, d):
    listed = V.scalar_to_list(F.col("type"))
    shown = F.concat_ws(":", listed[0], F.size(listed).cast("string"))
    return v_field(spark, d).select("request_id", "param", shown.alias("type"), "d")


@query("v5_split_on_separator", "SELECT request_id, array_to_string(param, ',') AS params, len(param) AS n FROM v_req")
def v5(spark, d):
    packed = F.array(F.array_join("param", "|"))
    values = X.split_all(packed, "|")
    return v_req(spark, d).select("request_id", joined(values).alias("params"), F.size(values).cast("bigint").alias("n"))


@query(
    "v6_text_to_number",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN round(o_totalprice, 2) WHEN 1 THEN CAST(o_custkey AS DOUBLE) WHEN 2 THEN 1200.0 ELSE -1 END AS num,
 CASE o_orderkey % 4 WHEN 1 THEN o_custkey ELSE -1 END AS whole, CASE WHEN floor(o_totalprice) = o_totalprice THEN CAST(o_totalprice AS BIGINT) ELSE -1 END AS exact FROM orders""",
)
def v6(spark, d):
    kind = F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.format_string("%.2f", "o_totalprice"))
        .when(kind == 1, F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
        .when(kind == 2, F.lit("1.2e3"))
        .otherwise(F.lit("12d"))
    )
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.round(F.coalesce(X.number(text), F.lit(-1.0)), 2).alias("num"),
        F.coalesce(X.integer(text), F.lit(-1)).alias("whole"),
        F.coalesce(X.integer_from_double(F.col("o_totalprice")), F.lit(-1)).alias("exact"),
    )


@query("v7_number_to_text", "SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS price, CAST(p_size AS VARCHAR) AS size FROM part")
def v7(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", V.number_text(F.col("p_retailprice")).alias("price"), V.number_text(F.col("p_size")).alias("size")
    )


@query(
    "v8_delete_short_strings",
    """SELECT request_id, string_agg(p, ',' ORDER BY p) AS params FROM (SELECT request_id, unnest(param) AS p FROM v_req) WHERE length(p) >= 7 GROUP BY 1""",
)
def v8(spark, d):
    kept = V.drop_short(F.col("param"), 7)
    return v_req(spark, d).where(F.size(kept) > 0).select("request_id", joined(kept).alias("params"))


@query(
    "v9_repeated_values",
    """SELECT request_id, array_to_string(type, ',') AS types, 'request[''type'']: has repeated values in the list, e.g. ''' || type[1] || '''' AS message FROM v_req""",
)
def v9(spark, d):
    doubled = v_req(spark, d).select("request_id", F.concat("type", "type").alias("type"))
    removed = V.check(doubled, [V.Rule("type", unique="remove")]).select("request_id", joined("type").alias("types"))
    rejected = V.check(doubled, [V.Rule("type", unique="reject")]).select("request_id", joined("errors").alias("message"))
    return removed.join(rejected, "request_id")


KEYED = """k AS (SELECT p_partkey, unnest(list_distinct(['variable', p_type, 'x_' || p_brand, 'tmp'])) AS key FROM part)"""


def keyed(spark, d):
    names = F.array(F.lit("variable"), F.col("p_type"), F.concat(F.lit("x_"), F.col("p_brand")), F.lit("tmp"))
    values = F.transform(names, lambda n: F.array(F.col("p_name")))
    return table(spark, d, "part").select("p_partkey", F.map_from_arrays(names, values).alias("request"))


@query(
    "v10_remove_unknown_keys",
    f"""WITH {KEYED} SELECT p_partkey, string_agg(key, ',' ORDER BY key) AS keys FROM k
WHERE key IN ('variable', 'SMALL', 'LARGE') OR regexp_matches(key, '^x_') GROUP BY 1""",
)
def v10(spark, d):
    request = V.remove_unknown_keys(F.col("request"), ["variable", "SMALL", "LARGE"], ["^x_"])
    return keyed(spark, d).select("p_partkey", joined(F.array_sort(F.map_keys(request))).alias("keys"))


@query(
    "v10_remove_listed_keys_and_report",
    f"""WITH {KEYED}, r AS (SELECT * FROM k WHERE key IN ('variable', 'SMALL') OR key <> 'tmp')
SELECT p_partkey, string_agg(key, ',' ORDER BY key) AS keys,
 'request: Invalid key name' || CASE WHEN count_if(key NOT IN ('variable', 'SMALL')) > 1 THEN 's' ELSE '' END || ': ''' ||
 string_agg(key, ''', ''' ORDER BY key) FILTER (key NOT IN ('variable', 'SMALL')) || '''' AS message FROM r GROUP BY 1""",
)
def v10_listed(spark, d):
    request = V.remove_unknown_keys(F.col("request"), ["variable", "SMALL"], removable=["tmp"])
    message = V.unknown_key_message(request, ["variable", "SMALL"])
    return keyed(spark, d).select(
        "p_partkey", joined(F.array_sort(F.map_keys(request))).alias("keys"), message.alias("message")
    )


@query(
    "v11_reformat_dates",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN 'someday' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def v11(spark, d):
    kind = F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(kind == 1, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(kind == 2, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.lit("someday"))
    )
    fixed = V.reformat_dates(F.array(text), ["yyyyMMdd", "dd/MM/yyyy"])
    return table(spark, d, "orders").select("o_orderkey", fixed[0].alias("day"))


@query(
    "v12_dates_to_ranges",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN '2020/1' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || '/2030-01-01'
 ELSE strftime(o_orderdate, '%Y-%m-%d') || '/' || strftime(o_orderdate, '%Y-%m-%d') END AS span FROM orders""",
)
def v12(spark, d):
    kind, day = F.col("o_orderkey") % 3, F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(kind == 0, day).when(kind == 1, F.concat(day, F.lit("/2030-01-01"))).otherwise(F.lit("2020/1"))
    return table(spark, d, "orders").select("o_orderkey", V.dates_to_ranges(F.array(text))[0].alias("span"))


@query(
    "v13_defaults_for_required",
    """SELECT request_id, array_to_string(coalesce(type, ['F', 'O']), ',') AS types, 0 AS n_errors FROM v_sel""",
)
def v13(spark, d):
    checked = V.check(v_sel(spark, d), [V.Rule("type", required=True, default=["F", "O"])])
    return checked.select("request_id", joined("type").alias("types"), F.size("errors").alias("n_errors"))


@query(
    "v14_text_formats",
    """SELECT o_orderkey, o_orderkey % 5 = 0 AS numeric, o_orderkey % 5 = 0 AND o_orderkey % 2 = 0 AS positive, o_orderkey % 5 IN (1, 2) AS date_or_range,
 o_orderkey % 5 = 2 AS date_range FROM orders""",
)
def v14(spark, d):
    kind, day = F.col("o_orderkey") % 5, F.date_format("o_orderdate", "yyyy-MM-dd")
    number = F.when(F.col("o_orderkey") % 2 == 0, F.format_string("%.1f", "o_totalprice")).otherwise(F.lit("-3"))
    text = (
        F.when(kind == 0, number)
        .when(kind == 1, day)
        .when(kind == 2, F.concat_ws("/", day, F.date_format(F.date_add("o_orderdate", 3), "yyyy-MM-dd")))
        .when(kind == 3, F.concat_ws("/", day, F.date_format(F.date_sub("o_orderdate", 1), "yyyy-MM-dd")))
        .otherwise(F.concat_ws("/", day, day, day))
    )
    return table(spark, d, "orders").select(
        "o_orderkey",
        X.is_numeric(text).alias("numeric"),
        X.is_positive_numeric(text).alias("positive"),
        X.is_date_or_range(text).alias("date_or_range"),
        X.is_date_range(text).alias("date_range"),
    )


@query(
    "v15_archive_request_rules",
    """
SELECT request_id, unnest(list_filter_out) AS message FROM (SELECT request_id, [x for x in [
 CASE WHEN request_id % 5 = 0 THEN 'request[''type'']: []: list has too few items. Should have at least 1' END,
 'request[''level'']: has repeated values in the list, e.g. ''' || param[1] || '''',
 CASE WHEN request_id % 4 = 0 THEN 'request[''step''][0]: invalid value: ''  ''' END] if x IS NOT NULL] AS list_filter_out FROM v_req)""",
)
def v15(spark, d):
    key = F.col("request_id")
    step = F.when(key % 4 == 0, F.lit("  ")).otherwise(F.lit("6"))
    request = F.create_map(
        F.lit("type"), F.when(key % 5 == 0, F.array().cast("array<string>")).otherwise(F.col("type")),
        F.lit(" AreaX"), F.array(F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0")),
        F.lit("level"), F.concat("param", "param"),
        F.lit("step"), F.array(step),
    )
    messages = V.archive_problems(request)
    return v_req(spark, d).select("request_id", F.explode(messages).alias("message"))


@query(
    "v16_regional_rules",
    """
SELECT request_id, CASE WHEN request_id % 3 = 0 THEN 'request: missing mandatory key: ''type'''
 WHEN len(param) > 2 THEN 'request[''area''][0]: ' || CAST(90.0 + len(param) AS VARCHAR) || ' is greater than the maximum of 90.0' ELSE '' END AS messages,
 'grib' AS format FROM v_sel""",
)
def v16(spark, d):
    one = lambda text: F.array(F.lit(text))
    north = F.when((F.size("param") > 2) & (F.col("request_id") % 3 != 0), (F.size("param") + 90).cast("string")).otherwise(F.lit("60"))
    req = v_sel(spark, d).select(
        "request_id",
        F.col("param").alias("variable"),
        one("ENSEMBLE").alias("model"),
        one("0").alias("level"),
        one("2024-01-01/2024-01-05").alias("date"),
        "type",
        one("0000").alias("time"),
        one("24").alias("step"),
        F.lit(None).cast("array<string>").alias("format"),
        F.array(north, F.lit("-10"), F.lit("30"), F.lit("20")).alias("area"),
    )
    checked = V.check(req, V.regional_rules())
    return checked.select("request_id", joined("errors").alias("messages"), F.col("format")[0].alias("format"))


@query(
    "v17_truth_values",
    """SELECT c_custkey, CASE WHEN c_custkey % 7 IN (0, 2, 4) THEN 'true' WHEN c_custkey % 7 IN (1, 3, 5) THEN 'false' ELSE 'invalid' END AS truth FROM customer""",
)
def v17(spark, d):
    words = F.array(*[F.lit(w) for w in ("YES", "no", "On", "off", "1", "F", "maybe")])
    truth = X.truth(F.get(words, (F.col("c_custkey") % 7).cast("int")))
    return table(spark, d, "customer").select(
        "c_custkey", F.coalesce(truth.cast("string"), F.lit("invalid")).alias("truth")
    )


@query(
    "u3_user_rules",
    """SELECT request_id, array_to_string([upper(x) for x in type], ',') AS types, CASE WHEN list_contains(type, 'P') THEN 'bad' ELSE '' END AS verdict FROM v_req""",
)
def u3(spark, d):
    V.register_format("not provisional", lambda value: value != "P")
    V.register_message("not provisional", lambda value, rule: F.concat(value, F.lit(" is provisional")))
    V.register_repair("upper case", lambda values, rule: F.transform(values, F.upper))
    lowered = v_req(spark, d).select("request_id", F.transform("type", F.lower).alias("type"))
    checked = V.check(lowered, [V.Rule("type", format="not provisional", repairs=["upper case"])])
    return checked.select(
        "request_id",
        joined("type").alias("types"),
        F.when(joined("errors").contains("P is provisional"), "bad").otherwise("").alias("verdict"),
    )
