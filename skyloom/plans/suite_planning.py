"""Queries that plan requests in bulk: constraints, open values, sizes and costs."""

from pyspark.sql import functions as F

from skyloom.operators import constraints as N
from skyloom.operators import costs as P
from skyloom.operators import cubes as C
from skyloom.operators import forms
from skyloom.plans.planning import Costing, estimate_costs
from skyloom.plans.registry import query
from skyloom.plans.views import v_area, v_con, v_field, v_req, v_sel
from skyloom.tables import table

KEYS = ["param", "type"]
PARAM_WEIGHTS = {"1-URGENT": 5, "5-LOW": 2}
TYPE_WEIGHTS = {"F": 3}


def text(column):
    return F.coalesce(F.array_join(column, ","), F.lit(""))


@query(
    "j1_intersect_constraints",
    """
SELECT r.request_id, c.constraint_id, array_to_string(list_sort(list_intersect(r.param, c.param)), ',') AS params,
 CASE WHEN c.type IS NULL THEN '' ELSE array_to_string(list_sort(list_intersect(r.type, c.type)), ',') END AS types,
 len(r.d) AS n_days
FROM v_req r JOIN v_con c USING (dataset)
WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))""",
)
def j1(spark, d):
    cut = N.intersect(v_req(spark, d), v_con(spark, d).drop("d_start", "d_end"), KEYS)
    return cut.select(
        "request_id",
        "constraint_id",
        text("param").alias("params"),
        text("type").alias("types"),
        F.size("d").cast("bigint").alias("n_days"),
    )


@query(
    "j1_requests_without_valid_combination",
    """
SELECT r.request_id FROM v_req r WHERE NOT EXISTS (SELECT 1 FROM v_con c WHERE c.dataset = r.dataset
 AND list_has_any(r.param, c.param) AND list_has_any(r.type, c.type) AND c.type IS NOT NULL)""",
)
def j1_rejects(spark, d):
    requests = v_req(spark, d)
    typed = v_con(spark, d).where("type IS NOT NULL").drop("d_start", "d_end")
    return N.without_valid_combination(requests, N.intersect(requests, typed, KEYS)).select("request_id")


def early_con(spark, d):
    """Constraints that ended before 1996, so that later datasets have none."""
    return v_con(spark, d).where("d_end < DATE'1996-01-01'")


EARLY_SQL = "early AS (SELECT * FROM v_con WHERE d_end < DATE '1996-01-01')"


@query(
    "j1_dataset_without_constraints",
    f"""
WITH {EARLY_SQL}
SELECT r.request_id, c.constraint_id, array_to_string(list_sort(list_intersect(r.param, c.param)), ',') AS params,
 CASE WHEN c.type IS NULL THEN '' ELSE array_to_string(list_sort(list_intersect(r.type, c.type)), ',') END AS types, len(r.d) AS n_days
FROM v_req r JOIN early c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))
UNION ALL SELECT request_id, CAST(-1 AS BIGINT), array_to_string(param, ','), array_to_string(type, ','), len(d)
FROM v_req ANTI JOIN early USING (dataset)""",
)
def j1_unconstrained(spark, d):
    cut = N.intersect_or_pass(v_req(spark, d), early_con(spark, d).drop("d_start", "d_end"), KEYS)
    return cut.select(
        "request_id",
        F.coalesce("constraint_id", F.lit(-1).cast("bigint")).alias("constraint_id"),
        text("param").alias("params"),
        text("type").alias("types"),
        F.size("d").cast("bigint").alias("n_days"),
    )


@query(
    "j2_intersect_date_ranges",
    """
WITH spans AS (SELECT dataset, request_id, CAST(min(d) AS DATE) AS s, CAST(max(d) AS DATE) AS e FROM v_field GROUP BY 1, 2)
SELECT request_id, constraint_id, greatest(s, d_start) AS "start", least(e, d_end) AS "end"
FROM spans JOIN v_con USING (dataset) WHERE s <= d_end AND d_start <= e""",
)
def j2(spark, d):
    spans = v_field(spark, d).groupBy("dataset", "request_id").agg(F.min("d").alias("start"), F.max("d").alias("end"))
    ranges = v_con(spark, d).select("dataset", "constraint_id", "d_start", "d_end")
    return N.intersect_date_ranges(spans, ranges).select("request_id", "constraint_id", "start", "end")


@query(
    "j2_long_ranges",
    """
WITH r AS (SELECT o_orderkey AS request_id, c_nationkey AS dataset, CAST(o_orderdate AS DATE) - CAST(o_orderkey * 7 % 20000 AS INTEGER) AS s,
 CAST(o_orderdate AS DATE) AS e FROM orders JOIN customer ON o_custkey = c_custkey),
c AS (SELECT s_suppkey AS constraint_id, s_nationkey AS dataset, DATE '1940-01-01' + CAST(s_suppkey * 997 % 20000 AS INTEGER) AS s,
 DATE '1940-01-01' + CAST(s_suppkey * 997 % 20000 + s_suppkey * 37 % 25000 AS INTEGER) AS e FROM supplier)
SELECT request_id, constraint_id, greatest(r.s, c.s) AS "start", least(r.e, c.e) AS "end"
FROM r JOIN c USING (dataset) WHERE r.s <= c.e AND c.s <= r.e""",
)
def j2_long(spark, d):
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dataset"))
    day = F.to_date("o_orderdate")
    asked = table(spark, d, "orders").join(customer, "o_custkey").select(
        F.col("o_orderkey").alias("request_id"),
        "dataset",
        F.date_sub(day, (F.col("o_orderkey") * 7 % 20000).cast("int")).alias("start"),
        day.alias("end"),
    )
    key, epoch = F.col("s_suppkey"), F.lit("1940-01-01").cast("date")
    first = key * 997 % 20000
    allowed = table(spark, d, "supplier").select(
        key.alias("constraint_id"),
        F.col("s_nationkey").alias("dataset"),
        F.date_add(epoch, first.cast("int")).alias("d_start"),
        F.date_add(epoch, (first + key * 37 % 25000).cast("int")).alias("d_end"),
    )
    return N.intersect_date_ranges(asked, allowed).select("request_id", "constraint_id", "start", "end")


FORM_SQL = """
form AS (SELECT DISTINCT dataset, 'param' AS key, unnest(param) AS value FROM v_con
 UNION SELECT DISTINCT dataset, 'type', unnest(type) FROM v_con)"""


@query(
    "f19_unconstrained_keys_pass",
    f"""
WITH {FORM_SQL.strip()}, whole AS (SELECT * FROM form UNION SELECT DISTINCT CAST(c_nationkey * 10000 + year(o_orderdate) AS BIGINT),
 'segment', c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT dataset, key, value FROM whole ANTI JOIN (SELECT DISTINCT dataset, key FROM form) USING (dataset, key)""",
)
def f19(spark, d):
    con = v_con(spark, d)
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    segments = table(spark, d, "orders").join(customer, "o_custkey").select(
        (F.col("c_nationkey") * 10000 + F.year("o_orderdate")).cast("bigint").alias("dataset"),
        F.lit("segment").alias("key"),
        F.col("c_mktsegment").alias("value"),
    )
    form = N.form_of_constraints(con, KEYS).unionByName(segments.distinct())
    return N.unconstrained_values(form, N.constrained_keys(con, KEYS))


@query(
    "a11_possible_values",
    """
WITH hit AS (SELECT r.request_id, c.param, c.type FROM v_sel r JOIN v_con c USING (dataset)
 WHERE (r.param IS NULL OR list_has_any(r.param, c.param)) AND (r.type IS NULL OR (c.type IS NOT NULL AND list_has_any(r.type, c.type))))
SELECT DISTINCT request_id, 'param' AS key, unnest(param) AS value FROM hit
UNION SELECT DISTINCT request_id, 'type', unnest(type) FROM hit""",
)
def a11(spark, d):
    return forms.possible_values(v_sel(spark, d), v_con(spark, d), KEYS)


@query(
    "a12_form_state",
    """
SELECT DISTINCT request_id, 'param' AS key, unnest(c.param) AS value FROM v_sel r JOIN v_con c USING (dataset)
 WHERE r.type IS NULL OR (c.type IS NOT NULL AND list_has_any(r.type, c.type))
UNION SELECT DISTINCT request_id, 'type', unnest(c.type) FROM v_sel r JOIN v_con c USING (dataset)
 WHERE r.param IS NULL OR list_has_any(r.param, c.param)""",
)
def a12(spark, d):
    return forms.form_state(v_sel(spark, d), v_con(spark, d), KEYS)


@query(
    "a13_form_state_mixed",
    f"""
WITH {FORM_SQL.strip()}
SELECT DISTINCT request_id, 'param' AS key, unnest(c.param) AS value FROM v_sel r JOIN v_con c USING (dataset)
 WHERE r.type IS NOT NULL AND (c.type IS NULL OR list_has_any(r.type, c.type))
UNION SELECT request_id, key, value FROM v_sel r JOIN form USING (dataset) WHERE r.type IS NULL AND key = 'param'
UNION SELECT DISTINCT request_id, 'type', unnest(c.type) FROM v_sel r JOIN v_con c USING (dataset)
 WHERE list_has_any(r.param, c.param)""",
)
def a13(spark, d):
    con = v_con(spark, d)
    return forms.form_state_mixed(v_sel(spark, d), con, KEYS, N.form_of_constraints(con, KEYS))


@query(
    "a11_unknown_key",
    f"""
WITH {EARLY_SQL}, known AS (SELECT DISTINCT dataset, 'param' AS key FROM early UNION SELECT DISTINCT dataset, 'type' FROM early WHERE type IS NOT NULL),
asked AS (SELECT dataset, request_id, 'param' AS key FROM v_sel WHERE param IS NOT NULL UNION ALL SELECT dataset, request_id, 'type' FROM v_sel WHERE type IS NOT NULL
 UNION ALL SELECT dataset, request_id, 'd' FROM v_req)
SELECT request_id, key, 'invalid param ' || chr(39) || key || chr(39) AS message FROM asked SEMI JOIN known USING (dataset) ANTI JOIN known USING (dataset, key)""",
)
def a11_unknown(spark, d):
    rules = early_con(spark, d)
    asked = v_req(spark, d).withColumn("type", F.when(F.col("request_id") % 3 != 0, F.col("type")))
    asked = asked.withColumn("d", F.col("d").cast("array<string>"))
    return forms.unknown_keys(asked, rules, N.form_of_constraints(rules, KEYS), [*KEYS, "d"])


GRANULES_SQL = """
hit AS (SELECT r.request_id, list_intersect(r.param, c.param) AS param,
  CASE WHEN c.type IS NULL THEN ['-'] ELSE list_intersect(r.type, c.type) END AS type
 FROM v_req r JOIN v_con c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))),
granule AS (SELECT DISTINCT request_id, param, unnest(type) AS type FROM (SELECT request_id, unnest(param) AS param, type FROM hit))"""


# A type that no constraint of the dataset mentions is valid as it is selected.
VALID_SQL = GRANULES_SQL.replace(
    "CASE WHEN c.type IS NULL THEN ['-']",
    "CASE WHEN r.dataset NOT IN (SELECT dataset FROM v_con WHERE type IS NOT NULL) THEN r.type WHEN c.type IS NULL THEN ['-']",
)


@query(
    "a5_count_granules",
    f"WITH {VALID_SQL.strip()} SELECT request_id, count(*) AS n_granules FROM granule GROUP BY 1",
)
def a5(spark, d):
    return P.count_granules(P.granule_boxes(v_req(spark, d), v_con(spark, d), KEYS), KEYS)


@query(
    "a5_without_constraints",
    f"""
WITH {EARLY_SQL},
hit AS (SELECT r.request_id, list_intersect(r.param, c.param) AS param,
  CASE WHEN r.dataset NOT IN (SELECT dataset FROM early WHERE type IS NOT NULL) THEN r.type WHEN c.type IS NULL THEN ['-'] ELSE list_intersect(r.type, c.type) END AS type
 FROM v_req r JOIN early c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))
 UNION ALL SELECT request_id, param, type FROM v_req ANTI JOIN early USING (dataset)),
granule AS (SELECT DISTINCT request_id, param, unnest(type) AS type FROM (SELECT request_id, unnest(param) AS param, type FROM hit))
SELECT request_id, count(*) AS n_granules FROM granule GROUP BY 1""",
)
def a5_unconstrained(spark, d):
    return P.count_granules(P.granule_boxes(v_req(spark, d), early_con(spark, d), KEYS), KEYS)


@query(
    "a5_count_granules_roughly",
    f"""WITH {VALID_SQL.strip()} SELECT request_id, CAST(sum(len(param) * len(type)) AS BIGINT) AS n_granules
FROM (SELECT DISTINCT request_id, list_sort(param) AS param, list_sort(type) AS type FROM hit) GROUP BY 1""",
)
def a5_rough(spark, d):
    return P.count_granules_roughly(v_req(spark, d), v_con(spark, d), KEYS)


@query(
    "a6_weighted_granules",
    f"""WITH {VALID_SQL.strip()} SELECT request_id, CAST(sum(CASE param WHEN '1-URGENT' THEN 5 WHEN '5-LOW' THEN 2 ELSE 1 END
 * CASE type WHEN 'F' THEN 3 ELSE 1 END * 4) AS BIGINT) AS weighted_granules FROM granule WHERE type <> '-' GROUP BY 1""",
)
def a6(spark, d):
    found = P.granule_boxes(v_req(spark, d), v_con(spark, d), KEYS)
    return P.weigh_granules(found, KEYS, {"param": PARAM_WEIGHTS, "type": TYPE_WEIGHTS}, {"type": 4})


SIZE_SQL = """(len(param) + CASE WHEN list_contains(param, '1-URGENT') THEN 4 ELSE 0 END + CASE WHEN list_contains(param, '5-LOW') THEN 1 ELSE 0 END)
 * (len(type) + CASE WHEN list_contains(type, 'F') THEN 2 ELSE 0 END) * 3 * len(d)"""


def _size():
    return P.estimate_fields(
        ["param", "type", "d", "area"], {"param": PARAM_WEIGHTS, "type": TYPE_WEIGHTS}, {"type": 3}
    )


@query("a7_estimate_fields", f"SELECT request_id, CAST({SIZE_SQL} AS BIGINT) AS size FROM v_req")
def a7(spark, d):
    return v_req(spark, d).select("request_id", _size().alias("size"))


@query(
    "a8_precise_size",
    f"""
WITH {FORM_SQL.strip()}, firsts AS (SELECT dataset, min(value) AS t FROM form WHERE key = 'type' GROUP BY 1),
r AS (SELECT s.dataset, request_id, param, coalesce(type, [t]) AS type FROM v_sel s LEFT JOIN firsts USING (dataset)),
hit AS (SELECT r.request_id, list_intersect(r.param, c.param) AS param,
  CASE WHEN c.type IS NULL THEN ['-'] ELSE list_intersect(r.type, c.type) END AS type
 FROM r JOIN v_con c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))),
granule AS (SELECT DISTINCT request_id, param, unnest(type) AS type FROM (SELECT request_id, unnest(param) AS param, type FROM hit))
SELECT request_id, CAST(2 * count(granule.param) AS BIGINT) AS precise_size FROM v_sel LEFT JOIN granule USING (request_id) GROUP BY 1""",
)
def a8(spark, d):
    con = v_con(spark, d)
    return P.precise_size(v_sel(spark, d), con, N.form_of_constraints(con, KEYS), KEYS, weight=2)


SELECTED_SQL = f"""{FORM_SQL.strip()}, firsts AS (SELECT dataset, min(value) AS t FROM form WHERE key = 'type' GROUP BY 1),
r AS (SELECT s.dataset, request_id, param, coalesce(type, [t]) AS type FROM v_sel s LEFT JOIN firsts USING (dataset)),
hit AS (SELECT r.request_id, list_intersect(r.param, c.param) AS param,
  CASE WHEN c.type IS NULL THEN ['-'] ELSE list_intersect(r.type, c.type) END AS type
 FROM r JOIN v_con c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))),
granule AS (SELECT DISTINCT request_id, param, unnest(type) AS type FROM (SELECT request_id, unnest(param) AS param, type FROM hit)),
weighted AS (SELECT request_id, sum(CASE param WHEN '1-URGENT' THEN 5 WHEN '5-LOW' THEN 2 ELSE 1 END
 * CASE type WHEN 'F' THEN 3 ELSE 1 END * 4) AS w FROM granule WHERE type <> '-' GROUP BY 1)"""
WEIGHTS = {"param": PARAM_WEIGHTS, "type": TYPE_WEIGHTS}


@query(
    "a8_precise_size_weighted",
    f"""WITH {SELECTED_SQL}
SELECT request_id, CAST(2 * coalesce(w, 0) AS BIGINT) AS precise_size FROM v_sel LEFT JOIN weighted USING (request_id)""",
)
def a8_weighted(spark, d):
    con = v_con(spark, d)
    form = N.form_of_constraints(con, KEYS)
    return P.precise_size(v_sel(spark, d), con, form, KEYS, 2, weighted_values=WEIGHTS, weighted_keys={"type": 4})


def dated(spark, d):
    """Requests whose days are a key of the form that no constraint mentions, and that form."""
    requests = v_req(spark, d).withColumn("d", F.col("d").cast("array<string>"))
    days = v_field(spark, d).select("dataset", F.lit("d").alias("key"), F.col("d").cast("string").alias("value")).distinct()
    return requests, N.form_of_constraints(v_con(spark, d), KEYS).unionByName(days)


@query(
    "a8_precise_size_free_keys",
    f"""WITH {GRANULES_SQL.strip()}, n AS (SELECT request_id, count(*) AS n FROM granule GROUP BY 1)
SELECT request_id, CAST(coalesce(n, 0) * len(d) AS BIGINT) AS precise_size FROM v_req LEFT JOIN n USING (request_id)""",
)
def a8_free(spark, d):
    requests, form = dated(spark, d)
    return P.precise_size(requests, v_con(spark, d), form, [*KEYS, "d"])


@query(
    "a10_cost_report_weighted",
    f"""
WITH {GRANULES_SQL.strip()}, weighted AS (SELECT request_id, sum(CASE param WHEN '1-URGENT' THEN 5 WHEN '5-LOW' THEN 2 ELSE 1 END
 * CASE type WHEN 'F' THEN 3 ELSE 1 END * 3) AS w FROM granule WHERE type <> '-' GROUP BY 1),
costs AS (SELECT request_id, CAST({SIZE_SQL} AS BIGINT) AS size, CAST(coalesce(w, 0) * len(d) AS BIGINT) AS precise_size
 FROM v_req LEFT JOIN weighted USING (request_id)),
ranked AS (SELECT *, CASE WHEN size / 400.0 >= precise_size / 300.0 THEN 'size' ELSE 'precise_size' END AS deciding_cost FROM costs)
SELECT request_id, size, precise_size, deciding_cost, CASE WHEN (CASE WHEN deciding_cost = 'size' THEN size ELSE precise_size END) <= 60 THEN 'small'
 WHEN (CASE WHEN deciding_cost = 'size' THEN size ELSE precise_size END) <= 400 THEN 'medium' ELSE 'large' END AS cost_class FROM ranked""",
)
def a10_weighted(spark, d):
    requests, form = dated(spark, d)
    costing = Costing(
        weighted_values=WEIGHTS,
        weighted_keys={"type": 3},
        limits={"size": 400, "precise_size": 300},
        bounds={"small": 60, "medium": 400},
        last_class="large",
        based_on="highest_cost_limit_ratio",
    )
    return estimate_costs(requests, v_con(spark, d), form, KEYS, costing, counted=["d"])


@query(
    "a9_area_weight_of_grid",
    """SELECT request_id, greatest(0, CAST(trunc((north - south) / 0.25 * (east - west) / 0.25) AS BIGINT)) AS grid_points FROM v_area""",
)
def a9_grid(spark, d):
    box = [F.col(c) for c in ("north", "west", "south", "east")]
    return v_area(spark, d).select("request_id", P.grid_area_weight(*box).alias("grid_points"))


@query(
    "a9_area_weight_of_observations",
    """SELECT request_id, CASE WHEN request_id % 5 = 0 THEN 1 WHEN request_id % 7 = 0 THEN 64800
 ELSE greatest(1, CAST(trunc(abs(north - south) / 0.5 * abs(east - west) / 0.5) AS BIGINT)) END AS points
 FROM v_area""",
)
def a9_obs(spark, d):
    shown = F.col("request_id") % 7 != 0
    box = [F.when(shown, F.col(c)) for c in ("north", "west", "south", "east")]
    weight = P.observation_area_weight(*box, F.col("request_id") % 5 == 0, 0.5, 0.5)
    whole = P.observation_area_weight(*box, F.col("request_id") % 5 == 0)
    return v_area(spark, d).select("request_id", F.when(shown, weight).otherwise(whole).alias("points"))


@query(
    "a10_cost_report",
    f"""
WITH {GRANULES_SQL.strip()}, precise AS (SELECT request_id, count(*) AS n FROM granule GROUP BY 1),
costs AS (SELECT v_req.request_id, {SIZE_SQL} AS size, coalesce(n, 0) AS precise_size FROM v_req LEFT JOIN precise USING (request_id)),
ranked AS (SELECT *, CASE WHEN size / 400.0 > 0 AND size / 400.0 >= precise_size / 30.0 THEN 'size'
 WHEN precise_size > 0 THEN 'precise_size' ELSE '' END AS highest FROM costs)
SELECT request_id, CAST(size AS BIGINT) AS size, CAST(precise_size AS BIGINT) AS precise_size, highest,
 CASE WHEN size <= 10 THEN 0 WHEN size <= 50 THEN 1 WHEN size <= 200 THEN 2 ELSE 3 END AS class_index,
 CASE WHEN (CASE WHEN highest = 'precise_size' THEN precise_size ELSE size END) <= 5 THEN 'small'
  WHEN (CASE WHEN highest = 'precise_size' THEN precise_size ELSE size END) <= 40 THEN 'medium' ELSE 'huge' END AS class_name
FROM ranked""",
)
def a10(spark, d):
    con, form = v_con(spark, d), N.form_of_constraints(v_con(spark, d), KEYS)
    requests = v_req(spark, d)
    sizes = requests.select("request_id", _size().alias("size"))
    costs = sizes.join(P.precise_size(requests.drop("d"), con, form, KEYS), "request_id")
    kinds = {"size": F.col("size"), "precise_size": F.col("precise_size")}
    highest = F.coalesce(P.highest_ratio(kinds, {"size": 400, "precise_size": 30}), F.lit(""))
    based_on = F.when(F.col("highest") == "precise_size", F.col("precise_size")).otherwise(F.col("size"))
    return costs.withColumn("highest", highest).select(
        "request_id",
        "size",
        "precise_size",
        "highest",
        P.cost_class(F.col("size"), [200, 10, 50]).alias("class_index"),
        P.cost_class(based_on, {"medium": 40, "small": 5}, "huge").alias("class_name"),
    )
