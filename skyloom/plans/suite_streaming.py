"""Queries for the operators that also run on streams.

They run in batch form here; the tests run them as streams and compare.
"""

from datetime import datetime

from pyspark.sql import functions as F

from skyloom.plans.registry import near, query
from skyloom.plans.views import v_field
from skyloom.session import scratch
from skyloom.streaming.daily import closed_before, daily_windows
from skyloom.streaming.embargo import MovingEmbargo
from skyloom.tables import table


@query(
    "x1_daily_reduction_of_closed_days",
    """
WITH last AS (SELECT CAST(max(ts) + INTERVAL 2 HOUR - INTERVAL 1 DAY AS DATE) AS d FROM events)
SELECT event_type, CAST(ts + INTERVAL 2 HOUR AS DATE) AS day, round(avg(value) + 1e-9, 6) AS mean, min(value) AS min, max(value) AS max,
 round(stddev_pop(value) + 1e-9, 6) AS std, round(sum(value), 4) AS sum, count(*) AS n FROM events GROUP BY 1, 2 HAVING day < (SELECT d FROM last)""",
)
def x1(spark, d):
    events = table(spark, d, "events")
    days = daily_windows(events, ["mean", "min", "max", "std", "sum"], ["event_type"], shift_hours=2)
    moved = F.col("ts") + F.make_dt_interval(hours=F.lit(2))
    (still_open,) = events.agg(closed_before(moved)).first()
    closed = days.where(F.col("day") < F.lit(still_open))
    return closed.withColumns({"mean": near(F.col("mean")), "std": near(F.col("std")), "sum": F.round("sum", 4)})


@query(
    "x2_moving_embargo",
    """SELECT request_id, param, type, d, CASE WHEN d <= DATE '1997-06-30' THEN 0 WHEN d <= DATE '1999-12-25' THEN 1 ELSE -1 END AS batch FROM v_field""",
)
def x2(spark, d):
    """Two batches through the sink: the first brings all fields, the second only the passing of time."""
    path = scratch(spark, "embargo")
    sink = MovingEmbargo(path, 5, lambda batch: (datetime(1997, 7, 5), datetime(1999, 12, 30))[batch])
    fields = v_field(spark, d).select("request_id", "param", "type", "d")
    sink(fields, 0)
    sink(fields.where("false"), 1)
    batch = F.lit(0)
    released = [spark.read.schema(fields.schema).parquet(f"{path}/released/batch={n}").withColumn("batch", batch + n) for n in (0, 1)]
    held = sink.held_after(spark, 1).select(*fields.columns).withColumn("batch", batch - 1)
    return released[0].unionByName(released[1]).unionByName(held)
