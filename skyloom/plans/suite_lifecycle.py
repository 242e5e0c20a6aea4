"""Queries over several operators at once: documents in, planning calls and the way of a request."""

from pyspark.sql import functions as F

from skyloom.operators import constraints as N
from skyloom.operators import requests as R
from skyloom.operators.grid import longitude_part_columns, read_axis
from skyloom.operators.rules import Rule
from skyloom.plans import lifecycle as L
from skyloom.plans import planning as P
from skyloom.plans.registry import query
from skyloom.plans.suite_catalogue import features
from skyloom.plans.suite_planning import FORM_SQL
from skyloom.plans.views import v_area, v_con, v_field, v_grid, v_req, v_sel
from skyloom.sources import documents as J
from skyloom.tables import table

KEYS = ["param", "type"]


def deep_forms(spark, d):
    """A form per part, of the dataset that its size names, with values two and five groups down."""
    down, up = '{"label":"group","details":{"groups":[', "]}}"
    two = F.concat(F.lit(down + '{"values":["'), F.col("p_brand"), F.lit('"]}' + up))
    five = F.concat(F.lit(4 * down + '{"values":["'), F.col("p_name"), F.lit('"]}' + 4 * up))
    head = F.concat(F.lit('[{"name":"'), F.col("p_type"), F.lit('","type":"StringListArrayWidget","details":{"groups":['))
    text = F.concat(head, two, F.lit(","), five, F.lit("]}}]"))
    return J.forms(table(spark, d, "part").select(F.col("p_size").alias("dataset"), text.alias("text")), "text", ["dataset"])


@query("p14_deep_forms", "SELECT p_type AS name, p_brand AS value FROM part UNION SELECT p_type, p_name FROM part")
def p14_deep(spark, d):
    return R.form_values(deep_forms(spark, d))


@query(
    "p14_forms_of_datasets",
    "SELECT p_size AS dataset, p_type AS name, p_brand AS value FROM part UNION SELECT p_size, p_type, p_name FROM part",
)
def p14_datasets(spark, d):
    return R.form_values(deep_forms(spark, d), ["dataset"])


@query(
    "doc_requests_from_json",
    """SELECT request_id, 'param' AS key, unnest(param) AS value FROM v_req UNION ALL SELECT request_id, 'type', unnest(type) FROM v_req""",
)
def doc_requests(spark, d):
    text = F.to_json(F.struct("param", "type"))
    documents = v_req(spark, d).select("request_id", text.alias("text"))
    opened = J.requests(documents, "text", ["request_id"])
    return opened.select("request_id", F.explode("keys").alias("key", "values")).select(
        "request_id", "key", F.explode("values").alias("value")
    )


@query(
    "doc_constraints_from_json",
    """SELECT dataset, count(*) AS n_constraints, count(type) AS n_with_type, CAST(sum(len(param)) AS BIGINT) AS n_params FROM v_con GROUP BY 1""",
)
def doc_constraints(spark, d):
    one = F.struct("param", "type")
    documents = v_con(spark, d).groupBy("dataset").agg(F.to_json(F.collect_list(one)).alias("text"))
    rows = J.key_columns(J.constraints(documents, "text", ["dataset"]), KEYS, ["dataset"])
    return rows.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_constraints"),
        F.count("type").alias("n_with_type"),
        F.sum(F.size("param")).alias("n_params"),
    )


@query(
    "plan_apply_constraints_homogeneous",
    f"""
WITH {FORM_SQL.strip()}, extra AS (SELECT DISTINCT dataset, 'month' AS key, strftime(d, '%m') AS value FROM v_field),
mentions AS (SELECT dataset, count(type) > 0 AS typed FROM v_con GROUP BY 1)
SELECT DISTINCT request_id, 'param' AS key, unnest(c.param) AS value FROM v_sel r JOIN v_con c USING (dataset) JOIN mentions USING (dataset)
 WHERE r.type IS NULL OR NOT typed OR (c.type IS NOT NULL AND list_has_any(r.type, c.type))
UNION SELECT DISTINCT request_id, 'type', unnest(c.type) FROM v_sel r JOIN v_con c USING (dataset)
 WHERE r.param IS NULL OR list_has_any(r.param, c.param)
UNION ALL SELECT request_id, key, value FROM v_sel JOIN extra USING (dataset)""",
)
def plan_constraints(spark, d):
    con = v_con(spark, d)
    month = [F.lit("month").alias("key"), F.date_format("d", "MM").alias("value")]
    form = N.form_of_constraints(con, KEYS).unionByName(v_field(spark, d).select("dataset", *month).distinct())
    return P.apply_constraints(v_sel(spark, d), con, form, KEYS, method="homogeneous")


@query(
    "plan_check_validity",
    """
WITH feature AS (SELECT latitude + 3 AS f_north, longitude - 4 AS f_west, latitude - 3 AS f_south, longitude + 4 AS f_east FROM v_site)
SELECT request_id, EXISTS (SELECT 1 FROM feature WHERE f_south <= north AND f_north >= south AND f_west <= east AND f_east >= west) AS valid FROM v_area""",
)
def plan_validity(spark, d):
    return P.check_validity(v_area(spark, d), features(spark, d))


@query(
    "plan_request_tags",
    """
WITH cut AS (SELECT r.request_id, unnest(list_intersect(r.param, c.param)) AS param, CASE WHEN c.type IS NULL THEN [NULL] ELSE list_intersect(r.type, c.type) END AS type
 FROM v_req r JOIN v_con c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type)))
SELECT request_id, 'high' AS tag FROM cut GROUP BY 1 HAVING bool_and(param IN ('1-URGENT', '2-HIGH'))
UNION ALL SELECT request_id, 'open' FROM (SELECT request_id, unnest(type) AS type FROM cut) GROUP BY 1 HAVING bool_and(coalesce(type = 'O', false))""",
)
def plan_tags(spark, d):
    conditions = {"high": [{"param": ["1-URGENT", "2-HIGH"]}], "open": [{"type": ["O"]}]}
    return P.request_tags(v_req(spark, d).drop("d"), v_con(spark, d).drop("d_start", "d_end"), KEYS, conditions)


@query(
    "plan_cost_estimate",
    """
WITH hit AS (SELECT r.request_id, list_intersect(r.param, c.param) AS param, CASE WHEN c.type IS NULL THEN ['-'] ELSE list_intersect(r.type, c.type) END AS type
 FROM v_req r JOIN v_con c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))),
g AS (SELECT DISTINCT request_id, param, unnest(type) AS type FROM (SELECT request_id, unnest(param) AS param, type FROM hit)),
n AS (SELECT request_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT request_id, CAST(len(param) * len(type) * len(d) * 32 AS BIGINT) AS size, CAST(coalesce(n, 0) * 32 AS BIGINT) AS precise_size FROM v_req LEFT JOIN n USING (request_id))
SELECT request_id, size, precise_size, 'precise_size' AS deciding_cost, CASE WHEN precise_size <= 64 THEN 'small' WHEN precise_size <= 192 THEN 'medium' ELSE 'large' END AS cost_class FROM c""",
)
def plan_costs(spark, d):
    con = v_con(spark, d)
    boxes = {"north": 11.0, "west": 20.0, "south": 10.0, "east": 22.0}
    requests = v_req(spark, d).withColumns({k: F.lit(v) for k, v in boxes.items()})
    costing = P.Costing(bounds={"small": 64, "medium": 192}, last_class="large", based_on="precise_size")
    return P.estimate_costs(requests, con, N.form_of_constraints(con, KEYS), KEYS, costing, counted=["d"])


LIFE = """
WITH fine AS (SELECT * FROM v_req WHERE len(param) <= 2),
cut AS (SELECT r.request_id, c.constraint_id, list_intersect(r.param, c.param) AS param, CASE WHEN c.type IS NULL THEN NULL ELSE list_intersect(r.type, c.type) END AS type, r.d
 FROM fine r JOIN v_con c USING (dataset) WHERE list_has_any(r.param, c.param) AND (c.type IS NULL OR list_has_any(r.type, c.type))),
kept AS (SELECT *, [x for x in d if x < DATE '1999-06-15'] AS early, len([x for x in d if x = DATE '1999-06-15']) > 0 AS on_limit FROM cut)
"""


@query(
    "life_prepared_requests",
    LIFE
    + """SELECT request_id, constraint_id, 'before' AS piece, len(param) AS n_params, len(early) AS n_days, '00:00,12:00' AS times FROM kept WHERE len(early) > 0
UNION ALL SELECT request_id, constraint_id, 'limit', len(param), 1, '00:00' FROM kept WHERE on_limit""",
)
def life_prepared(spark, d):
    ready = _prepared(spark, d).requests
    return ready.select(
        "request_id",
        "constraint_id",
        "piece",
        F.size("variable").cast("bigint").alias("n_params"),
        F.size("date").cast("bigint").alias("n_days"),
        F.array_join("time", ",").alias("times"),
    )


@query(
    "life_rejected_requests",
    LIFE
    + """SELECT request_id, 'rules' AS rule_id FROM v_req WHERE len(param) > 2
UNION ALL SELECT request_id, 'constraints' FROM fine WHERE request_id NOT IN (SELECT request_id FROM cut)
UNION ALL SELECT request_id, 'embargo' FROM kept GROUP BY 1 HAVING bool_and(len(early) = 0 AND NOT on_limit)""",
)
def life_rejects(spark, d):
    return _prepared(spark, d).rejects.select("request_id", "rule_id")


def _prepared(spark, d):
    raw = v_req(spark, d).withColumnRenamed("d", "date").withColumn("time", F.array(F.lit("00:00"), F.lit("12:00")))
    config = L.Preparation(
        rules=[Rule("param", required=True, min_items=1, max_items=2)],
        constrained=KEYS,
        mapping={"rename": {"param": "variable"}, "remap": {"param": {"1-URGENT": "t"}}},
        embargo={"days": 5},
    )
    as_of = F.lit("1999-06-20 06:00:00").cast("timestamp_ntz")
    return L.prepare(raw, v_con(spark, d).drop("d_start", "d_end"), config, as_of)


@query(
    "f9_wrap_many_boxes",
    """
WITH b AS (SELECT request_id, west, east, west < 0 AND west + 360 < 360 AS eastward FROM v_area)
SELECT request_id, 0 AS part, round(CASE WHEN west >= 0 THEN west ELSE west + 360 END, 6) AS "start",
 round(CASE WHEN west >= 0 THEN east WHEN east < 0 THEN east + 360 ELSE 360.0 END, 6) AS "end" FROM b
UNION ALL SELECT request_id, 1, 0.0, round(east, 6) FROM b WHERE west < 0 AND east >= 0""",
)
def f9_many(spark, d):
    parts = longitude_part_columns(F.col("west"), F.col("east"), read_axis(v_grid(spark, d), "longitude"))
    rows = v_area(spark, d).select("request_id", F.explode(parts).alias("p"))
    return rows.select(
        "request_id", "p.part", F.round("p.start", 6).alias("start"), F.round("p.end", 6).alias("end")
    )
