"""Answering a whole table of requests in one job.

A request is a row with ``request_id``, ``variables``, first and last day, and
the edges of a box.  Requests and data meet on variable, day and a coarse cell,
which is an equality join; on a store partitioned by variable and day it also
prunes the folders to read.  ``cell`` in degrees should be about the size of the
usual box: it decides how many rows a request is laid out to.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.dates import date_range
from skyloom.functions.space import cell_of_point, cells_of_box
from skyloom.operators.meetings import Columns, meetings

EDGES = ("north", "west", "south", "east")


def laid_out(requests: DataFrame, first: Column, last: Column, cell: float) -> DataFrame:
    """One row per variable, day and coarse cell of each request."""
    return (
        requests.withColumn("variable", F.explode(F.array_distinct("variables")))
        .withColumn("valid_date", F.explode(date_range(first, last)))
        .withColumn("_cell", F.explode(cells_of_box(*[F.col(e) for e in EDGES], cell)))
        .drop("variables")
    )


def answer_from_grid(grid: DataFrame, requests: DataFrame, cell: float = 30.0) -> DataFrame:
    """Grid rows of every request; days and box include both ends.

    ``requests`` has ``start`` and ``end`` dates.
    """
    asked = laid_out(requests, F.col("start"), F.col("end"), cell).drop("start", "end")
    if "valid_date" not in grid.columns:
        grid = grid.withColumn("valid_date", F.to_date("valid_time"))
    located = grid.withColumn("_cell", cell_of_point(F.col("latitude"), F.col("longitude"), cell))
    inside = F.col("latitude").between(F.col("south"), F.col("north")) & F.col("longitude").between(
        F.col("west"), F.col("east")
    )
    return located.join(asked, ["variable", "valid_date", "_cell"]).where(inside).drop("_cell", *EDGES)


def answer_from_observations(
    observations: DataFrame, requests: DataFrame, cell: float = 30.0, numbers_of: str | None = None
) -> DataFrame:
    """Observations of every request; time and box are half-open.

    ``requests`` has ``start`` and ``end`` times without a zone.  With ``numbers_of``, a column of the observations, a
    request comes once for each variable it finds, with the number ``n`` of its observations and the smallest value of that
    column.  Requests and observations of a day and cell are then compared in blocks, and no pair of them is a row.
    """
    if numbers_of is not None:  # a row becomes many, so that few large pieces of a file would take long
        slices = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        requests = requests.repartition(slices, "request_id")
    asked = laid_out(requests, F.to_date("start"), F.to_date("end"), cell)
    located = observations.withColumnRenamed("observed_variable", "variable").withColumns(
        {
            "valid_date": F.to_date("report_timestamp"),
            "_cell": cell_of_point(F.col("latitude"), F.col("longitude"), cell),
        }
    )
    if numbers_of is not None:
        on = ["variable", "valid_date", "_cell"]
        asking = asked.select(*on, "request_id", F.col("variable").alias("_variable"), "start", "end", *EDGES)
        times = F.col("report_timestamp").cast("timestamp_ntz").alias("_time")
        held = located.select(*on, numbers_of, times, F.col("latitude").alias("_latitude"), F.col("longitude").alias("_longitude"))
        named, along = ["request_id", "_variable", numbers_of], ("south", "north", "_latitude")
        met = meetings(asking, held, on, _asked_for, named, counted="n", least=numbers_of, along=along)
        found = met.groupBy("request_id", F.col("_variable").alias("variable"))
        return found.agg(F.sum("n").alias("n"), F.min(numbers_of).alias(numbers_of))
    inside = (
        (F.col("report_timestamp") >= F.col("start"))
        & (F.col("report_timestamp") < F.col("end"))
        & (F.col("latitude") >= F.col("south"))
        & (F.col("latitude") < F.col("north"))
        & (F.col("longitude") >= F.col("west"))
        & (F.col("longitude") < F.col("east"))
    )
    return located.join(asked, ["variable", "valid_date", "_cell"]).where(inside).drop("_cell", "start", "end", *EDGES)


def _asked_for(request: Columns, observation: Columns) -> np.ndarray:
    met = observation["_latitude"] >= request["south"]
    met &= observation["_latitude"] < request["north"]
    met &= observation["_longitude"] >= request["west"]
    met &= observation["_longitude"] < request["east"]
    met &= observation["_time"] >= request["start"]
    met &= observation["_time"] < request["end"]
    return met


def without_answer(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests that found no data, which is an error of theirs."""
    return requests.join(answers.select("request_id").distinct(), "request_id", "left_anti")
