"""Embargo as a moving limit over arriving fields.

Fields past the limit are kept in a side table and given out by a later batch,
once the limit has passed them.  The side table has a folder for each batch and
release day, so a batch that runs again after a failure writes the same
folders again.  A small calendar of the days still held says which folders a
batch must read; days that were given out are not in it any more.
"""

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MovingEmbargo:
    """``foreachBatch`` sink: released fields under ``<path>/released``, the rest under ``<path>/held``; ``date`` is a column of dates."""

    def __init__(self, path: str, delay_days: int, clock: Callable[[int], datetime], date: str = "d") -> None:
        self.path = path
        self.delay_days = delay_days
        self.clock = clock
        self.date = date
        self.schema: T.StructType | None = None

    def held_after(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What is still held after a batch; nothing before the first one.  A folder that is gone is an error."""
        if batch_id < 0:
            return None
        days = self._days(spark, batch_id)
        return self._held(spark, days.collect())

    def _days(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The calendar after a batch: days of which something is held and the batches that brought it."""
        entry = [T.StructField(self.date, T.DateType()), T.StructField("since", T.IntegerType())]
        return spark.read.schema(T.StructType(entry)).parquet(f"{self.path}/days/batch={batch_id}")

    def _held(self, spark: SparkSession, days: Sequence[tuple[date, int]]) -> DataFrame:
        """Held fields of some entries of the calendar; only their folders are listed."""
        reader = spark.read.option("basePath", f"{self.path}/held")
        if self.schema is not None:
            reader = reader.schema(T.StructType([*self.schema.fields, T.StructField("since", T.IntegerType())]))
        elif not days:
            return spark.createDataFrame([], T.StructType([T.StructField(self.date, T.DateType())]))
        if not days:
            return spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/held/since={since}/{self.date}={day.isoformat()}" for day, since in days]
        return reader.parquet(*folders).drop("since")

    def _limit(self, batch_id: int) -> Column:
        return F.date_sub(F.lit(self.clock(batch_id).date().isoformat()).cast("date"), self.delay_days)

    def __call__(self, arrived: DataFrame, batch_id: int) -> None:
        """Give out what a batch brings and what the limit has passed since the last one.

        Held fields are written once, under the batch that brought them and the day that releases them.  The calendar of
        days still held is written anew by each batch, so a batch lists the days it gives out and nothing older.
        """
        spark, day = arrived.sparkSession, F.col(self.date)
        self.schema, limit = arrived.schema, self._limit(batch_id)
        out, kept = arrived.where(day <= limit), arrived.where(day > limit)
        days = kept.select(self.date, F.lit(batch_id).alias("since")).distinct()
        if batch_id > 0:
            before = self._days(spark, batch_id - 1)
            days = days.unionByName(before.where(day > limit))
            out = out.unionByName(self._held(spark, before.where(day <= limit).collect()).select(*arrived.columns))
        # a day with many fields is split, so that it is not one task
        spread = kept.hint("rebalance", self.date).write.mode("overwrite")
        spread.partitionBy(self.date).parquet(f"{self.path}/held/since={batch_id}")
        days.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/days/batch={batch_id}")
        out.write.mode("overwrite").parquet(f"{self.path}/released/batch={batch_id}")


def run(fields: DataFrame, embargo: MovingEmbargo, checkpoint: str):
    return (
        fields.writeStream.foreachBatch(embargo)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
