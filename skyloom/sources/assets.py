"""Asset files of observations and the manifest that says which ones can matter."""

import json
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.observations import Retrieval, filter_column, predicate

SKETCH_BITS = 1024  # places of a file's station sketch

EXTENTS = (
    "path string, n_rows long, t_min timestamp_ntz, t_max timestamp_ntz, lat_min double, lat_max double, "
    "lon_min double, lon_max double, codes array<int>, stations array<int>, schema string"
)


def read_assets(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All asset files as one scan; columns may differ between them."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def manifest(assets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Extent in time and space of every asset."""
    return assets.groupBy(*by).agg(*_extents(assets.columns))


def _extents(columns: Sequence[str]) -> list[Column]:
    sides = {"t": "report_timestamp", "lat": filter_column(columns, "latitude"), "lon": filter_column(columns, "longitude")}
    found = []
    for name, column in sides.items():
        found += [F.min(f"`{column}`").alias(f"{name}_min"), F.max(f"`{column}`").alias(f"{name}_max")]
    return [*found, F.count(F.lit(1)).alias("n_rows")]


def can_hold(
    time: tuple[datetime, datetime], latitude: tuple[float, float], longitude: tuple[float, float]
) -> Column:
    """Whether an asset's extent meets the half-open coverages of a request."""
    low, high = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in time)
    return (
        (F.col("t_min") < high)
        & (F.col("t_max") >= low)
        & (F.col("lat_min") < latitude[1])
        & (F.col("lat_max") >= latitude[0])
        & (F.col("lon_min") < longitude[1])
        & (F.col("lon_max") >= longitude[0])
    )


def _sketched(station: Column) -> Column:
    return F.pmod(F.xxhash64(station.cast("string")), F.lit(SKETCH_BITS)).cast("int")


def append_assets(rows: DataFrame, store: str, by: Sequence[str], files: int) -> None:
    """Add rows to a store of asset files, and what each new file holds to its manifest.

    Rows are put into files by ``by`` and time, so a file has a narrow extent and an asset of any size has many files.  A file's
    entry has its extent, its variable codes and a sketch of its stations: hashes modulo 1024, so no list grows with the
    stations.  Only new files are read for it.  The manifest is written last: rows of a call that fails are never seen.
    """
    spark = rows.sparkSession
    folder = f"{store}/rows/{uuid.uuid4().hex}"
    ordered = rows.repartitionByRange(files, *by, "report_timestamp").sortWithinPartitions(*by, "report_timestamp")
    ordered.write.parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder).withColumn("path", F.col("_metadata.file_path"))
    entries = stored.groupBy("path").agg(
        *_extents(rows.columns),
        F.array_sort(F.collect_set(F.col("observed_variable_code").cast("int"))).alias("codes"),
        F.array_sort(F.collect_set(_sketched(F.col("primary_station_id")))).alias("stations"),
    )
    named = entries.withColumn("schema", F.lit(rows.schema.json()))
    names = T.StructType.fromDDL(EXTENTS).names
    named.select(*names).write.mode("append").parquet(f"{store}/manifest")


def _may_match(wanted: Retrieval, codes: dict[str, int]) -> Column:
    """Whether a file can have rows of a retrieval; a file without any value of a filtered column cannot."""
    test = F.lit(True)
    if wanted.time is not None:
        low, high = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in wanted.time)
        test = test & (F.col("t_min") < high) & (F.col("t_max") >= low)
    for name, coverage in (("lat", wanted.latitude), ("lon", wanted.longitude)):
        if coverage is not None:
            test = test & (F.col(f"{name}_min") < coverage[1]) & (F.col(f"{name}_max") >= coverage[0])
    if wanted.variables is not None:
        known = F.array(*[F.lit(codes[v]) for v in wanted.variables if v in codes]).cast("array<int>")
        test = test & F.arrays_overlap("codes", known)
    if wanted.stations is not None:
        sketch = F.array(*[_sketched(F.lit(s)) for s in wanted.stations]).cast("array<int>")
        test = test & F.arrays_overlap("stations", sketch)
    return test


def surviving_files(spark: SparkSession, store: str, wanted: Retrieval, codes: dict[str, int]) -> DataFrame:
    """Entries of the manifest that a retrieval cannot rule out."""
    return spark.read.schema(EXTENTS).parquet(f"{store}/manifest").where(_may_match(wanted, codes))


def read_pruned(spark: SparkSession, store: str, wanted: Retrieval, codes: dict[str, int]) -> DataFrame:
    """Matching rows of all assets of a store as one scan of the files that can hold any.

    Columns may differ between assets; one that an asset lacks is NULL there.  The driver sees the paths of the
    surviving files, as it does for any scan, and no footer is read for their schema.
    """
    kept = surviving_files(spark, store, wanted, codes).select("path", "schema")
    paths = [r.path for r in kept.select("path").collect()]
    every = spark.read.schema(EXTENTS).parquet(f"{store}/manifest")
    fields: dict[str, T.StructField] = {}
    for row in sorted(every.select("schema").distinct().collect()):
        for f in T.StructType.fromJson(json.loads(row.schema)):
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    schema = T.StructType(list(fields.values()))
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows.where(predicate(rows.columns, wanted, codes))
