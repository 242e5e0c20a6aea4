"""The gridded store: Parquet in long form, partitioned by variable and day.

Its coordinates lie beside the cells in ``_axes``, which a scan of the cells
does not see.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.errors import InvalidRequest, NoData
from skyloom.operators.grid import axes_of, select_nearest, slice_box, slice_time
from skyloom.functions.dates import partial_date_bounds
from skyloom.tables import GRID, conform, missing_as_null


def write_store(grid: DataFrame, path: str) -> None:
    dated = missing_as_null(conform(grid, GRID), "value").withColumn("valid_date", F.to_date("valid_time"))
    (
        dated.repartitionByRange("variable", "valid_date", "latitude", "longitude")
        .sortWithinPartitions("variable", "valid_date", "latitude", "longitude")
        .write.mode("overwrite")
        .partitionBy("variable", "valid_date")
        .parquet(path)
    )
    axes_of(grid).repartition(1).write.mode("overwrite").parquet(f"{path}/_axes")


def open_axes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/_axes")


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The store with its known columns, so that no file is opened to find them."""
    return spark.read.schema(T.StructType([*GRID, T.StructField("valid_date", T.DateType())])).parquet(path)


def scan(
    grid: DataFrame,
    variables: Sequence[str],
    start: str,
    end: str,
    box: tuple[float, float, float, float] | None = None,
    points: DataFrame | None = None,
    axes: DataFrame | None = None,
) -> DataFrame:
    """Rows of the variables in a period, in a box (N, W, S, E) or at the nearest points.

    A variable the store lacks is an error, and so is an empty result.
    """
    if (box is None) == (points is None):
        raise InvalidRequest("`area` and `location` are mutually exclusive, and one of them is required.")
    wanted = sorted(set(variables))
    # one row of one folder each, on a store partitioned by variable
    missing = [v for v in wanted if grid.where(F.col("variable") == v).isEmpty()]
    if missing:
        raise InvalidRequest(f"Invalid variable: {missing}")
    chosen = slice_time(grid.where(F.col("variable").isin(wanted)), start, end)
    if "valid_date" in chosen.columns:  # the same period on the partition column
        low, after = partial_date_bounds(start, end)
        last = after - F.make_dt_interval(secs=F.lit(0.000001))
        chosen = chosen.where(F.col("valid_date").between(F.to_date(low), F.to_date(last)))
    if box is not None:
        chosen = slice_box(chosen, *box)
    else:
        chosen = select_nearest(chosen, points, axes)
    if chosen.isEmpty():
        raise NoData(f"No data found for {start}/{end} and {box or 'points'}.")
    return chosen
