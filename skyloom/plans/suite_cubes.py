"""Queries on cubes and fields: set algebra, splitting, merging and runs of dates."""

from pyspark.sql import functions as F

from skyloom.operators import boxes as B
from skyloom.operators import cubes as C
from skyloom.plans.registry import query
from skyloom.plans.views import v_con, v_cube, v_field, v_req, v_sel, v_stored

KEYS = ["param", "type", "d"]
FIELD = "request_id, param, type, d"


@query("h3_unfold_cubes", f"SELECT {FIELD} FROM v_cube")
def h3(spark, d):
    return C.unfold(v_req(spark, d), KEYS).select("request_id", *KEYS)


@query(
    "h1_intersection_and_differences",
    """
WITH l AS (SELECT DISTINCT param, type, d FROM v_field), r AS (SELECT * FROM v_stored)
SELECT param, type, d, 'both' AS side FROM (SELECT * FROM l INTERSECT SELECT * FROM r)
UNION ALL SELECT param, type, d, 'left' FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
UNION ALL SELECT param, type, d, 'right' FROM (SELECT * FROM r EXCEPT SELECT * FROM l)""",
)
def h1(spark, d):
    return C.compare(v_field(spark, d), v_stored(spark, d), KEYS)


def open_keyed(df):
    """Requests as maps; a key that is NULL is not in the map."""
    keys = F.map_from_arrays(F.array(F.lit("param"), F.lit("type")), F.array("param", "type"))
    return df.select("dataset", F.map_filter(keys, lambda _, v: v.isNotNull()).alias("keys"))


@query(
    "h1_fields_with_keys_of_their_own",
    """
WITH l AS (SELECT DISTINCT dataset, 'param=' || p || coalesce(';type=' || t, '') AS field FROM
 (SELECT dataset, p, unnest(coalesce(type, [NULL])) AS t FROM (SELECT dataset, unnest(param) AS p, type FROM v_sel))),
r AS (SELECT DISTINCT dataset, 'param=' || p || coalesce(';type=' || t, '') AS field FROM
 (SELECT dataset, p, unnest(coalesce(type, [NULL])) AS t FROM (SELECT dataset, unnest(param) AS p, type FROM v_con)))
SELECT coalesce(l.dataset, r.dataset) AS dataset, coalesce(l.field, r.field) AS field,
 CASE WHEN r.field IS NULL THEN 'left' WHEN l.field IS NULL THEN 'right' ELSE 'both' END AS side
FROM l FULL JOIN r ON l.dataset = r.dataset AND l.field = r.field""",
)
def h1_open(spark, d):
    left, right = (C.unfold_open(open_keyed(v(spark, d))) for v in (v_sel, v_con))
    return C.compare(left, right, ["dataset", "field"]).withColumn("field", C.field_text(F.col("field")))


@query(
    "h1_empty_lists",
    """SELECT DISTINCT dataset, 'param=' || p || ';type=' || t AS field FROM
 (SELECT dataset, p, unnest(type) AS t FROM (SELECT dataset, unnest(param) AS p, type FROM v_sel WHERE type IS NOT NULL))""",
)
def h1_empty(spark, d):
    some = v_sel(spark, d).withColumn("type", F.coalesce("type", F.array().cast("array<string>")))
    fields = C.unfold_open(open_keyed(some)).select("dataset", "field")
    return fields.distinct().withColumn("field", C.field_text(F.col("field")))


@query(
    "h11_unequal_key_sets",
    """SELECT dataset, count(DISTINCT type IS NULL) AS n_key_sets FROM v_sel GROUP BY 1 HAVING count(DISTINCT type IS NULL) > 1""",
)
def h11_unequal(spark, d):
    return C.unequal_key_sets(open_keyed(v_sel(spark, d)), ["dataset"])


@query(
    "h2_same_fields",
    """
WITH odd AS (SELECT param, type, d FROM v_field), st AS (SELECT param, type, d FROM v_stored),
s AS (SELECT coalesce(a.param, b.param) AS param, a.param IS NOT NULL AND b.param IS NOT NULL AS hit
 FROM (SELECT DISTINCT * FROM odd) a FULL JOIN st b ON a.param = b.param AND a.type = b.type AND a.d = b.d)
SELECT param, bool_and(hit) AS same FROM s GROUP BY param""",
)
def h2(spark, d):
    return C.same_fields(v_field(spark, d), v_stored(spark, d), KEYS, by=["param"])


@query("h4_subtract", f"SELECT {FIELD} FROM v_field ANTI JOIN v_stored USING (param, type, d)")
def h4(spark, d):
    return C.difference(v_field(spark, d), v_stored(spark, d), KEYS).select("request_id", *KEYS)


@query("h4_subtract_as_cubes", f"SELECT {FIELD} FROM v_cube ANTI JOIN v_stored USING (param, type, d)")
def h4_cubes(spark, d):
    stored = C.merge(v_stored(spark, d), KEYS)
    left = B.subtract(v_req(spark, d), stored, KEYS, "request_id", meet_on="d")
    return C.unfold(left, KEYS).select("request_id", *KEYS)


@query(
    "h1_cubes_of_both_sides",
    """
WITH l AS (SELECT DISTINCT dataset, param, type FROM v_cube),
r AS (SELECT DISTINCT dataset, param, unnest(type) AS type FROM (SELECT dataset, unnest(param) AS param, type FROM v_con WHERE type IS NOT NULL))
SELECT coalesce(l.dataset, r.dataset) AS dataset, coalesce(l.param, r.param) AS param, coalesce(l.type, r.type) AS type,
 CASE WHEN l.dataset IS NULL THEN 'right' WHEN r.dataset IS NULL THEN 'left' ELSE 'both' END AS side
FROM l FULL JOIN r ON l.dataset = r.dataset AND l.param = r.param AND l.type = r.type""",
)
def h1_cubes(spark, d):
    keys = ["param", "type"]
    sides = B.compare(v_req(spark, d), v_con(spark, d).where("type IS NOT NULL"), keys, ["dataset"], meet_on="param")
    return C.unfold(sides, keys).select("dataset", *keys, "side")


@query("h6_repeated_fields_as_cubes", "SELECT DISTINCT dataset, param, type, d FROM v_cube")
def h6_cubes(spark, d):
    cubes = B.without_repeated_fields(v_req(spark, d), KEYS, ["dataset"])
    return C.unfold(cubes, KEYS).select("dataset", *KEYS)


@query("h5_merge_keeps_fields", f"SELECT {FIELD} FROM v_field")
def h5(spark, d):
    cubes = C.merge(v_field(spark, d), KEYS, scope=["request_id"])
    return C.unfold(cubes, KEYS).select("request_id", *KEYS)


def _merge_rounds(rounds: int) -> str:
    """SQL of so many rounds of merging; once nothing merges, a round changes nothing."""
    parts = [
        """c0 AS (SELECT dataset, request_id AS place, CASE WHEN request_id % 2 = 1 THEN list_reverse(param) ELSE param END AS param, type FROM v_req)"""
    ]
    for i in range(rounds):
        a, b = f"c{i}", f"c{i + 1}"
        parts += [
            f"""k{i} AS (SELECT dataset, count(*) - count(DISTINCT list_sort(type)) AS sp, count(*) - count(DISTINCT list_sort(param)) AS st FROM {a} GROUP BY 1)""",
            f"""t{i} AS (SELECT {a}.*, CASE WHEN greatest(sp, st) = 0 THEN '' WHEN sp >= st THEN 'param' ELSE 'type' END AS k FROM {a} JOIN k{i} USING (dataset))""",
            f"""p{i} AS (SELECT dataset, list_sort(type) AS g, v, min(place * 100 + nth) AS seen FROM (SELECT dataset, place, type, unnest(param) AS v, generate_subscripts(param, 1) AS nth FROM t{i} WHERE k = 'param') GROUP BY 1, 2, 3)""",
            f"""q{i} AS (SELECT dataset, list_sort(param) AS g, v, min(place * 100 + nth) AS seen FROM (SELECT dataset, place, param, unnest(type) AS v, generate_subscripts(type, 1) AS nth FROM t{i} WHERE k = 'type') GROUP BY 1, 2, 3)""",
            f"""{b} AS (SELECT dataset, place, param, type FROM t{i} WHERE k = ''
 UNION ALL SELECT f.dataset, f.place, l.param, f.type FROM (SELECT dataset, list_sort(type) AS g, min(place) AS place, arg_min(type, place) AS type FROM t{i} WHERE k = 'param' GROUP BY 1, 2) f
  JOIN (SELECT dataset, g, list(v ORDER BY seen) AS param FROM p{i} GROUP BY 1, 2) l ON f.dataset = l.dataset AND f.g = l.g
 UNION ALL SELECT f.dataset, f.place, f.param, l.type FROM (SELECT dataset, list_sort(param) AS g, min(place) AS place, arg_min(param, place) AS param FROM t{i} WHERE k = 'type' GROUP BY 1, 2) f
  JOIN (SELECT dataset, g, list(v ORDER BY seen) AS type FROM q{i} GROUP BY 1, 2) l ON f.dataset = l.dataset AND f.g = l.g)""",
        ]
    return ",\n".join(parts)


@query(
    "h5_merge_to_fixpoint",
    f"""WITH {_merge_rounds(6)}
SELECT dataset, place AS first_request, array_to_string(param, ',') AS params, array_to_string(type, ',') AS types FROM c6""",
)
def h5_fixpoint(spark, d):
    given = F.when(F.col("request_id") % 2 == 1, F.reverse("param")).otherwise(F.col("param"))
    cubes = v_req(spark, d).withColumn("param", given)
    merged = C.merge_cubes(cubes, ["param", "type"], ["dataset"], "request_id")
    return merged.select(
        "dataset",
        F.col("request_id").alias("first_request"),
        F.array_join("param", ",").alias("params"),
        F.array_join("type", ",").alias("types"),
    )


@query(
    "h5_merge_counts_cubes",
    """
WITH one AS (SELECT request_id, type, d, list_sort(list(DISTINCT param)) AS param FROM v_field GROUP BY 1, 2, 3),
two AS (SELECT request_id, d, param, list_sort(list(type)) AS type FROM one GROUP BY 1, 2, 3),
three AS (SELECT request_id, param, type FROM two GROUP BY 1, 2, 3)
SELECT request_id, count(*) AS n_cubes FROM three GROUP BY 1""",
)
def h5_counts(spark, d):
    cubes = C.merge(v_field(spark, d), KEYS, scope=["request_id"])
    return cubes.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_cubes"))


@query(
    "h5_merge_with_barred_key",
    """
WITH one AS (SELECT request_id, type, d, list_sort(list(DISTINCT param)) AS param FROM v_field GROUP BY 1, 2, 3),
two AS (SELECT request_id, type, param, list_sort(list(d)) AS d FROM one GROUP BY 1, 2, 3)
SELECT request_id, type, array_to_string(param, ',') AS params, len(d) AS n_days, d[1] AS first_day FROM two""",
)
def h5_barred(spark, d):
    cubes = C.merge(v_field(spark, d), KEYS, scope=["request_id"], barred=["type"])
    return cubes.select(
        "request_id",
        F.col("type")[0].alias("type"),
        F.array_join("param", ",").alias("params"),
        F.size("d").cast("bigint").alias("n_days"),
        F.col("d")[0].alias("first_day"),
    )


@query("h6_remove_duplicate_fields", "SELECT DISTINCT dataset, param, type, d FROM v_cube")
def h6(spark, d):
    return C.distinct_fields(v_req(spark, d), KEYS, scope=["dataset"])


@query(
    "h7_split_to_size",
    f"""SELECT {FIELD}, (row_number() OVER (PARTITION BY request_id ORDER BY param, type, d) - 1) // 4 AS piece FROM v_cube""",
)
def h7(spark, d):
    return C.split(v_req(spark, d), KEYS, 4).select("request_id", *KEYS, "piece")


@query(
    "h8_chunk_over_requests",
    f"""SELECT {FIELD}, (row_number() OVER (ORDER BY request_id, param, type, d) - 1) // 900 AS chunk FROM v_cube""",
)
def h8(spark, d):
    return C.chunk(v_req(spark, d), KEYS, ["request_id"], C.SLOW_STORE_CHUNK).select("request_id", *KEYS, "chunk")


@query(
    "h8_chunk_at_most_groups",
    """WITH c AS (SELECT *, (row_number() OVER (ORDER BY request_id, param, type, d) - 1) // 5000 AS chunk FROM v_cube)
SELECT chunk, count(*) AS n_fields, min(request_id) AS first_request, max(request_id) AS last_request FROM c WHERE chunk < 3 GROUP BY 1""",
)
def h8_max(spark, d):
    fields = C.chunk(v_req(spark, d), KEYS, ["request_id"], C.FAST_STORE_CHUNK, max_groups=3)
    return fields.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n_fields"),
        F.min("request_id").alias("first_request"),
        F.max("request_id").alias("last_request"),
    )


@query(
    "h9_split_on_key",
    """SELECT request_id, type, array_to_string(param, ',') AS params, len(d) AS n_days
FROM (SELECT request_id, unnest(type) AS type, param, d FROM v_req)""",
)
def h9(spark, d):
    return C.split_on(v_req(spark, d), ["type"]).select(
        "request_id",
        F.col("type")[0].alias("type"),
        F.array_join("param", ",").alias("params"),
        F.size("d").cast("bigint").alias("n_days"),
    )


@query(
    "h9_split_by_month",
    """SELECT request_id, CAST(date_trunc('month', d) AS DATE) AS month, count(DISTINCT d) AS n_days, min(d) AS first_day, max(d) AS last_day
FROM v_field GROUP BY 1, 2""",
)
def h9_month(spark, d):
    return C.split_by_month(v_req(spark, d)).select(
        "request_id",
        "month",
        F.size("d").cast("bigint").alias("n_days"),
        F.array_min("d").alias("first_day"),
        F.array_max("d").alias("last_day"),
    )


@query(
    "h10_backend_groups",
    """
WITH f AS (SELECT dataset, type, param, CASE WHEN param < '3' THEN 'sfc' ELSE 'upper' END AS layer, request_id, d,
 row_number() OVER (PARTITION BY dataset, type, param ORDER BY request_id, d) - 1 AS rn FROM v_field)
SELECT dataset, type, layer, param, rn // 50 AS call, count(*) AS n_fields FROM f GROUP BY 1, 2, 3, 4, 5""",
)
def h10(spark, d):
    from skyloom.operators.catalogue import backend_calls

    fields = v_field(spark, d).withColumn("layer", F.when(F.col("param") < "3", "sfc").otherwise("upper"))
    calls = backend_calls(fields, ["dataset", "type", "layer", "param"], ["request_id", "d"])
    return calls.groupBy("dataset", "type", "layer", "param", "call").agg(F.count(F.lit(1)).alias("n_fields"))


@query(
    "h11_envelope_in_first_seen_order",
    """
WITH e AS (SELECT dataset, 'param' AS key, request_id, unnest(param) AS value, generate_subscripts(param, 1) AS place FROM v_req
 UNION ALL SELECT dataset, 'type', request_id, unnest(type), generate_subscripts(type, 1) FROM v_req),
f AS (SELECT dataset, key, value, min(request_id * 1000 + place) AS first FROM e GROUP BY 1, 2, 3)
SELECT dataset, key, string_agg(value, ',' ORDER BY first) AS vals FROM f GROUP BY 1, 2""",
)
def h11(spark, d):
    merged = C.envelope(v_req(spark, d), ["param", "type"], ["dataset"], "request_id")
    return merged.select("dataset", "key", F.array_join("values", ",").alias("vals"))


@query(
    "h12_canonical_sort",
    """SELECT dataset, string_agg(DISTINCT request_id // 10000, ',' ORDER BY request_id // 10000) AS numbers,
 string_agg(DISTINCT param, ',' ORDER BY param) AS words
FROM (SELECT DISTINCT dataset, request_id, unnest(param) AS param FROM v_req) GROUP BY dataset""",
)
def h12(spark, d):
    first = v_req(spark, d).select(
        "dataset",
        F.floor(F.col("request_id") / 10000).cast("string").alias("number"),
        F.explode("param").alias("word"),
    )
    listed = first.groupBy("dataset").agg(F.collect_set("number").alias("number"), F.collect_set("word").alias("word"))
    return listed.select(
        "dataset",
        F.array_join(C.canonical_values(F.col("number")), ",").alias("numbers"),
        F.array_join(C.canonical_values(F.col("word")), ",").alias("words"),
    )


@query(
    "t3_first_fields_of_request",
    f"""SELECT {FIELD}, row_number() OVER (PARTITION BY request_id ORDER BY param, type, d) <= 3 AS taken FROM v_cube""",
)
def t3(spark, d):
    taken, rest = C.take_first(v_req(spark, d), KEYS, 3)
    both = taken.withColumn("taken", F.lit(True)).unionByName(rest.withColumn("taken", F.lit(False)))
    return both.select("request_id", *KEYS, "taken")


@query(
    "k5_request_order_ordinals",
    f"SELECT {FIELD}, row_number() OVER (PARTITION BY request_id ORDER BY param, type, d) - 1 AS ordinal FROM v_cube",
)
def k5(spark, d):
    from skyloom.sinks.files import in_request_order

    fields = C.unfold_with_ordinal(v_req(spark, d), KEYS)
    return in_request_order(fields, ["request_id", "ordinal"]).select("request_id", *KEYS, "ordinal")


@query(
    "a4_count_fields",
    "SELECT dataset, CAST(sum(len(param) * len(type) * len(d)) AS BIGINT) AS n_fields FROM v_req GROUP BY dataset",
)
def a4(spark, d):
    return C.count_fields(v_req(spark, d), KEYS, by=["dataset"])


@query(
    "a4_count_fields_ignoring_key",
    "SELECT request_id, CAST(sum(len(param) * len(d)) AS BIGINT) AS n_fields FROM v_req GROUP BY request_id",
)
def a4_ignore(spark, d):
    return C.count_fields(v_req(spark, d), KEYS, by=["request_id"], ignore=["type"])


RUNS = """
WITH days AS (SELECT DISTINCT {by}, {day} AS d FROM {source}),
islands AS (SELECT {by}, d, d - CAST(row_number() OVER (PARTITION BY {by} ORDER BY d) AS INTEGER) AS run FROM days)
SELECT {by}, min(d) AS "start", max(d) AS "end", CASE WHEN min(d) = max(d) THEN strftime(min(d), '%Y-%m-%d')
 ELSE strftime(min(d), '%Y-%m-%d') || '/' || strftime(max(d), '%Y-%m-%d') END AS span FROM islands GROUP BY {by}, run"""


@query("w1_compress_dates_of_stations", RUNS.format(by="user_id", day="CAST(ts AS DATE)", source="events"))
def w1(spark, d):
    from skyloom.tables import table

    days = table(spark, d, "events").select("user_id", F.to_date("ts").alias("d"))
    return C.runs_of_dates(days, ["user_id"])


@query("w1_compress_dates_of_requests", RUNS.format(by="request_id", day="d", source="v_field"))
def w1_requests(spark, d):
    return C.runs_of_dates(v_field(spark, d), ["request_id"])


@query(
    "w1_expand_undoes_compress",
    "SELECT DISTINCT request_id, d FROM v_field",
)
def w1_roundtrip(spark, d):
    spans = C.runs_of_dates(v_field(spark, d), ["request_id"]).groupBy("request_id").agg(F.collect_list("span").alias("spans"))
    return spans.select("request_id", F.explode(C.expand_dates(F.col("spans"))).alias("d"))


@query(
    "w4_dates_consecutive_in_given_order",
    """
WITH g AS (SELECT request_id, d, o, lag(d) OVER (PARTITION BY request_id ORDER BY o) AS before
 FROM (SELECT DISTINCT request_id, d, d AS o FROM v_field))
SELECT request_id, bool_and(before IS NULL OR d - before = 1) AS consecutive FROM g GROUP BY 1""",
)
def w4(spark, d):
    from skyloom.operators.windows import consecutive_in_order

    return v_req(spark, d).select("request_id", consecutive_in_order(F.col("d")).alias("consecutive"))


@query(
    "w5_order_preserving_distinct",
    """SELECT request_id, array_to_string(list_sort(param), ',') AS vals FROM v_req""",
)
def w5(spark, d):
    doubled = F.concat("param", F.reverse("param"), "param")
    return v_req(spark, d).select(
        "request_id", F.array_join(C.order_preserving_distinct(doubled), ",").alias("vals")
    )


@query(
    "k6_reuse_of_results",
    """
WITH done AS (SELECT DISTINCT param, type FROM v_req WHERE d[1] < DATE '1995-01-15')
SELECT request_id, done.param IS NOT NULL AS hit FROM v_req LEFT JOIN done ON v_req.param = done.param AND v_req.type = done.type""",
)
def k6_reuse(spark, d):
    from skyloom.operators.requests import fingerprint, reusable_results

    keys = F.create_map(F.lit("type"), F.col("type"), F.lit("param"), F.col("param"))
    requests = v_req(spark, d).withColumn("fingerprint", fingerprint(keys, F.lit(False)))
    done = requests.where(F.col("d")[0] < F.lit("1995-01-15").cast("date")).select("fingerprint").distinct()
    return reusable_results(requests, done.withColumn("result", F.lit("file"))).select("request_id", "hit")


@query(
    "k6_request_fingerprints",
    """SELECT array_to_string(param, ',') AS params, array_to_string(type, ',') AS types, count(*) AS group_size, 1 AS n_fingerprints
FROM v_req GROUP BY 1, 2""",
)
def k6(spark, d):
    from skyloom.operators.requests import fingerprint

    keyed = v_req(spark, d).select(
        F.array_join("param", ",").alias("params"),
        F.array_join("type", ",").alias("types"),
        fingerprint(F.create_map(F.lit("type"), F.col("type"), F.lit("param"), F.col("param")), F.lit(False)).alias("fp"),
    )
    return keyed.groupBy("params", "types").agg(
        F.count(F.lit(1)).alias("group_size"), F.count_distinct("fp").cast("int").alias("n_fingerprints")
    )
