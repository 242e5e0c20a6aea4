"""Outputs: long tables, cubes by tag, field-addressed folders and commented CSV."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys of a field's path in their order, keys of an area, characters that a path may have.
FIELD_KEYS = ("model", "type", "variable", "level", "time", "step")
AREA_KEYS = ("north", "south", "east", "west")
SAFE_TEXT = r"^[\w.:-]+$"


def in_request_order(fields: DataFrame, order: Sequence[str]) -> DataFrame:
    """Fields in the order the request names them, over all partitions, for one merged output."""
    return fields.repartitionByRange(*order).sortWithinPartitions(*order)


# --- long tables and cubes -------------------------------------------------------


def long_table(cells: DataFrame, time: str = "time") -> DataFrame:
    """A selected cube as a table, with the time under its output name."""
    return cells.withColumnRenamed(time, "valid_time")


def write_long_table(cells: DataFrame, path: str, fmt: str = "csv", time: str = "time") -> None:
    writer = long_table(cells, time).write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def write_cubes(cells: DataFrame, path: str, tag: str = "tag") -> None:
    """One folder per dataset tag, cells of a tag in coordinate order."""
    order = [c for c in (tag, "variable", "valid_time", "latitude", "longitude") if c in cells.columns]
    (
        cells.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy(tag)
        .option("compression", "zstd")
        .parquet(path)
    )


# --- field-addressed layout --------------------------------------------------------


def field_path(columns: Sequence[str], tier: Column, suffix: str = "") -> Column:
    """``tier/date/key=value_...`` with the keys in their fixed order, area keys last.

    ``suffix`` goes to the tier, as for a server of its own.  NULL when a value has characters that do not belong in a path.
    """
    rank = {k: str(i) for i, k in enumerate(FIELD_KEYS)} | {k: f"ZZZ{i}" for i, k in enumerate(AREA_KEYS)}
    keys = sorted((c for c in columns if c not in ("date", "_backend")), key=lambda c: rank.get(c, c))
    parts = [F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys]
    folder = F.concat(tier, F.lit(suffix))
    safe = F.lit(True)
    for name in columns:
        safe = safe & F.col(name).cast("string").rlike(SAFE_TEXT)
    return F.when(safe, F.concat_ws("/", folder, F.col("date").cast("string"), F.concat_ws("_", *parts)))


def tier_of(fields: DataFrame, permanent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """permanent for fields that lie in a permanent cube, temporary for the rest."""
    known = permanent.select(*keys).distinct().withColumn("_keep", F.lit(True))
    joined = fields.join(known, list(keys), "left")
    return joined.withColumn("tier", F.when(F.col("_keep"), "permanent").otherwise("temporary")).drop("_keep")


def write_fields(fields: DataFrame, path: str) -> None:
    """Fields under folders of their tier and keys; those cut to a sub-area are never stored.

    Rows are dealt in the order of all keys, so that a folder with very many fields is written by many tasks.
    """
    whole = fields.where("north IS NULL") if "north" in fields.columns else fields
    folders = [c for c in ("tier", "date", "model", "type", "variable", "level") if c in whole.columns]
    finer = [c for c in ("time", "step", "latitude", "longitude") if c in whole.columns]
    whole.repartitionByRange(*folders, *finer).write.mode("overwrite").partitionBy(*folders).parquet(path)


# --- CSV with a commented header ------------------------------------------------------

# The rule above and below the header, and the wording of its lines in csv_header.
RULE = "#" * 88


def csv_header(
    summary: dict,
    variables: Sequence[tuple[str, str]],
    uncertainties: Sequence[tuple[str, str]],
    dataset: str,
    source: str,
    licences: Sequence[str],
) -> str:
    """Text of the header from one summary row and the distinct variables with their units."""
    area = "{min_lat:.2f}/{max_lat:.2f}/{min_lon:.2f}/{max_lon:.2f}".format(**summary)
    legend = [f"# {name} {text}" for name, text in uncertainties] or [
        "# No uncertainty columns available for this dataset."
    ]
    lines = [
        RULE,
        f"# This file contains data retrieved from {dataset}",
        "# This product comes under the following licences:",
        *[f"# {licence}" for licence in licences],
        f"# Data source: {source}",
        f"# Time extent: {summary['time_start']} - {summary['time_end']}",
        f"# Geographic area (minlat/maxlat/minlon/maxlon): {area}",
        "# Variables selected and units:",
        *[f"# {name} [{unit}]" for name, unit in variables],
        "# Uncertainty legend:",
        *legend,
        RULE,
    ]
    return "\n".join(lines) + "\n"


def write_csv(observations: DataFrame, path: str, dataset: str, source: str, licences: Sequence[str]) -> None:
    """Body as text columns; the header goes to ``header.txt`` beside it, as a distributed CSV has no first line."""
    from skyloom.operators.observations import extract_summary, variables_and_units

    spark = observations.sparkSession
    summary = extract_summary(observations).first().asDict()
    # the number of variables of a data model is small and fixed
    pairs = [tuple(r) for r in variables_and_units(observations).orderBy("observed_variable", "units").collect()]
    uncertain = [
        (c, observations.schema[c].metadata.get("long_name", c).capitalize().replace("_", " "))
        for c in observations.columns
        if "uncertainty_value" in c
    ]
    header = csv_header(summary, pairs, uncertain, dataset, source, licences)
    texts = observations.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in observations.columns])
    texts.write.mode("overwrite").option("header", True).csv(f"{path}/body")
    spark.createDataFrame([(header.rstrip("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/header"
    )
