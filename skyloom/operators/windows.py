"""Runs, overlaps and orders along time or position."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.dates import clock_seconds_since_1970
from skyloom.operators.scale import salted_join


def consecutive_in_order(dates: Column) -> Column:
    """Whether each date of the list is the day after the one before it, in the given order."""
    n = F.size(dates)
    places = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.forall(places, lambda i: F.datediff(F.get(dates, i), F.get(dates, i - 1)) == 1)


def clumps(rows: DataFrame, by: Sequence[str], position: str, mask: Column, block: int = 1_000_000) -> DataFrame:
    """Half-open slices ``[start, stop)`` of consecutive positions where the mask holds.

    Positions are whole numbers.  Runs are found inside blocks of positions and
    then joined across block borders, where at most two runs per block are
    left, so no window ever covers a whole series.
    """
    hits = rows.where(mask).select(*by, F.col(position).cast("bigint").alias("_p"))
    hits = hits.withColumn("_block", F.floor(F.col("_p") / block))
    place = F.row_number().over(Window.partitionBy(*by, "_block").orderBy("_p"))
    runs = (
        hits.withColumn("_run", F.col("_p") - place)
        .groupBy(*by, "_block", "_run")
        .agg(F.min("_p").alias("start"), (F.max("_p") + 1).alias("stop"))
        .drop("_block", "_run")
    )
    at_border = (F.col("start") % block == 0) | (F.col("stop") % block == 0)
    inner, border = runs.where(~at_border), runs.where(at_border)
    along = Window.partitionBy(*by).orderBy("start")
    fresh = F.coalesce(F.lag("stop").over(along) != F.col("start"), F.lit(True))
    chained = border.withColumn("_new", fresh.cast("int")).withColumn("_chain", F.sum("_new").over(along))
    joined = chained.groupBy(*by, "_chain").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_chain")
    return inner.unionByName(joined)


def overlapping_validity(fields: DataFrame, by: Sequence[str], base: str, steps: str) -> DataFrame:
    """Whether the last validity time of a base time reaches the first one of the next, per group.

    One row per base time is left before the window.
    """
    hour = F.make_dt_interval(hours=F.col(steps))
    spans = fields.groupBy(*by, base).agg(
        F.min(F.col(base) + hour).alias("_first"), F.max(F.col(base) + hour).alias("_last")
    )
    following = F.lead("_first").over(Window.partitionBy(*by).orderBy(base))
    return (
        spans.withColumn("_next", following)
        .groupBy(*by)
        .agg(F.coalesce(F.bool_or(F.col("_last") >= F.col("_next")), F.lit(False)).alias("overlapping"))
    )


def export_groups(fields: DataFrame, by: Sequence[str], base: str, steps: str) -> DataFrame:
    """Fields that fit into one output with a single time axis, under one group name.

    Base times are kept apart only where their validity times overlap.
    """
    flags = overlapping_validity(fields, by, base, steps)
    flagged = salted_join(fields, flags, by, [base, steps])
    apart = F.when(F.col("overlapping"), F.date_format(base, "yyyy-MM-dd"))
    names = [F.col(c).cast("string") for c in by]
    return flagged.withColumn("group", F.concat_ws("_", *names, apart)).drop("overlapping")


def validity_axis(messages: DataFrame, by: Sequence[str], base: str, step_hours: str) -> DataFrame:
    """Validity time, hours since the first base time, and how often the pair of times occurs.

    Equal times are counted first; the first base time comes from an aggregate
    and a salted join, so a large file is neither one window nor one task.
    """
    first = messages.groupBy(*by).agg(F.min(base).alias("_first"))
    times = messages.select(*by, base, step_hours).groupBy(*by, base, step_hours).agg(F.count(F.lit(1)).alias("_times"))
    timed = salted_join(times, first, by, [base, step_hours]).withColumn(
        "valid_time", F.col(base) + F.make_dt_interval(hours=F.col(step_hours))
    )
    seconds = clock_seconds_since_1970(F.col(base)) - clock_seconds_since_1970(F.col("_first"))
    return (
        timed.withColumn("reference_hours", (seconds / 3600).cast("bigint"))
        .groupBy(*by, base, "valid_time", "reference_hours")
        .agg(F.sum("_times").alias("n"))
        .withColumn("unique", F.col("n") == 1)
    )
