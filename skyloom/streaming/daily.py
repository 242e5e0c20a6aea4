"""Daily reduction over arriving rows, equal to the batch result on closed days."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.errors import ConfigurationError
from skyloom.functions.dates import clock_seconds_since_1970
from skyloom.operators.grid import REDUCERS
from skyloom.tables import nan_to_null


def daily_windows(
    rows: DataFrame,
    how: Sequence[str],
    by: Sequence[str],
    time: str = "ts",
    value: str = "value",
    shift_hours: int = 0,
    watermark: str = "1 day",
) -> DataFrame:
    """One row per closed day and group, on a stream or on a table.

    Late rows are taken until the watermark passes the end of their day.  State
    is one row of partial sums per open day and group.  The median cannot be
    kept like that and is left to the batch form.
    """
    unknown = [h for h in how if h not in REDUCERS]
    if unknown:
        raise ConfigurationError(f"not incremental: {unknown}")
    # a watermark needs an instant; the clock is read as UTC, so that days are cut the same in every session
    moved = F.timestamp_seconds(clock_seconds_since_1970(F.col(time)) + shift_hours * 3600)
    timed = rows.withColumn("event_time", moved)
    if rows.isStreaming:
        timed = timed.withWatermark("event_time", watermark)
    known = nan_to_null(F.col(value))
    reduced = timed.groupBy(F.window("event_time", "1 day").alias("_w"), *by).agg(
        *[REDUCERS[h](known).alias(h) for h in how], F.count(known).alias("n")
    )
    day = F.date_from_unix_date((F.unix_seconds("_w.start") / 86400).cast("int"))
    return reduced.select(*by, day.alias("day"), *how, "n")


def write_closed_days(days: DataFrame, path: str, checkpoint: str):
    """Append closed days to a Parquet table, then stop when all input is read."""
    return (
        days.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_before(time: Column, watermark_days: int = 1) -> Column:
    """First day that is still open once all rows up to the latest time are in."""
    return F.to_date(F.max(time) - F.make_dt_interval(days=F.lit(watermark_days)))
