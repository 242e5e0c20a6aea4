"""Queries that answer a table of requests in one job."""

from pyspark.sql import functions as F

from skyloom.operators import bulk as B
from skyloom.operators.grid import daily_reduce
from skyloom.plans.registry import near, query
from skyloom.plans.views import v_area, v_grid, v_obs

PERIOD = """
asked AS (SELECT *, DATE '2024-01-01' + CAST(request_id % 25 AS INTEGER) AS first,
 CASE WHEN request_id % 2 = 0 THEN ['view', 'click'] ELSE ['error'] END AS variables FROM v_area)"""


def asked(spark, d):
    key = F.col("request_id")
    first = F.date_add(F.lit("2024-01-01").cast("date"), (key % 25).cast("int"))
    names = F.when(key % 2 == 0, F.array(F.lit("view"), F.lit("click"))).otherwise(F.array(F.lit("error")))
    return v_area(spark, d).withColumns({"start": first, "end": F.date_add(first, 4), "variables": names})


@query(
    "s1_many_requests_at_once",
    f"""WITH {PERIOD.strip()} SELECT request_id, variable, CAST(valid_time AS DATE) AS day, latitude, longitude, round(avg(value) + 1e-9, 6) AS value
FROM asked JOIN v_grid ON list_contains(variables, variable) AND CAST(valid_time AS DATE) BETWEEN first AND first + 4
 AND latitude BETWEEN south AND north AND longitude BETWEEN west AND east GROUP BY 1, 2, 3, 4, 5""",
)
def s1_bulk(spark, d):
    cells = B.answer_from_grid(v_grid(spark, d), asked(spark, d))
    daily = daily_reduce(cells, "mean", by=["request_id", "variable", "latitude", "longitude"])
    return daily.withColumn("value", near(F.col("value")))


@query(
    "s2_many_requests_at_once",
    f"""WITH {PERIOD.strip()} SELECT request_id, observed_variable AS variable, count(*) AS n, min(observation_id) AS first_observation
FROM asked JOIN v_obs ON list_contains(variables, observed_variable) AND report_timestamp >= first + INTERVAL 6 HOUR
 AND report_timestamp < first + INTERVAL 102 HOUR AND latitude >= south AND latitude < north AND longitude >= west AND longitude < east GROUP BY 1, 2""",
)
def s2_bulk(spark, d):
    hours = {"start": 6, "end": 6}
    timed = asked(spark, d).withColumns(
        {c: F.col(c).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(h)) for c, h in hours.items()}
    )
    found = B.answer_from_observations(v_obs(spark, d), timed, numbers_of="observation_id")
    return found.select("request_id", "variable", "n", F.col("observation_id").alias("first_observation"))


@query(
    "s1_requests_without_data",
    f"""WITH {PERIOD.strip()} SELECT request_id FROM asked WHERE NOT EXISTS (SELECT 1 FROM v_grid WHERE list_contains(variables, variable)
 AND CAST(valid_time AS DATE) BETWEEN first AND first + 4 AND latitude BETWEEN south AND north AND longitude BETWEEN west AND east)""",
)
def s1_none(spark, d):
    requests = asked(spark, d)
    return B.without_answer(requests, B.answer_from_grid(v_grid(spark, d), requests)).select("request_id")
