"""Point observations: one row per observation, one column per variable of the data model."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.errors import ConfigurationError, NoData
from skyloom.operators.scale import salted_join, union_all
from skyloom.tables import literal_map

COORDINATES = ("latitude", "longitude")


@dataclass(frozen=True)
class Retrieval:
    """What to take from observations.  Coverages are half-open: [start, end)."""

    stations: Sequence[str] | None = None
    time: tuple[datetime, datetime] | None = None
    latitude: tuple[float, float] | None = None
    longitude: tuple[float, float] | None = None
    days: Sequence[int] | None = None
    variables: Sequence[str] | None = None
    extra: Mapping[str, object] = field(default_factory=dict)


def filter_column(columns: Sequence[str], coordinate: str) -> str:
    """Column a coverage is tested on: header, then station, then the plain one."""
    for name in (f"{coordinate}|header_table", f"{coordinate}|station_configuration"):
        if name in columns:
            return name
    return coordinate


def half_open(column: str, low: object, high: object) -> Column:
    return (F.col(f"`{column}`") >= F.lit(low)) & (F.col(f"`{column}`") < F.lit(high))


def predicate(columns: Sequence[str], wanted: Retrieval, codes: Mapping[str, int]) -> Column:
    """All filters of a retrieval as one conjunction on bare columns, so that it reaches the scan."""
    test = F.lit(True)
    if wanted.stations is not None:
        test = test & F.col("primary_station_id").isin(list(wanted.stations))
    if wanted.time is not None:
        low, high = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in wanted.time)
        test = test & (F.col("report_timestamp") >= low) & (F.col("report_timestamp") < high)
    for name, coverage in (("longitude", wanted.longitude), ("latitude", wanted.latitude)):
        if coverage is not None:
            test = test & half_open(filter_column(columns, name), *coverage)
    if wanted.days is not None:
        test = test & F.dayofmonth("report_timestamp").isin(list(wanted.days))
    if wanted.variables is not None:
        # a label without a code is ignored
        test = test & F.col("observed_variable_code").isin([codes[v] for v in wanted.variables if v in codes])
    for name, value in wanted.extra.items():
        if name not in columns:
            raise ConfigurationError(f"Field '{name}' in extra_filters not found in the dataset.")
        column = F.col(f"`{name}`")
        test = test & (column.isin(list(value)) if isinstance(value, (list, tuple)) else column == F.lit(value))
    return test


def retrieve(assets: Sequence[DataFrame], wanted: Retrieval, codes: Mapping[str, int]) -> DataFrame:
    """Matching rows of all assets together; a column an asset lacks is NULL there."""
    parts = [a.where(predicate(a.columns, wanted, codes)) for a in assets]
    return union_all(parts)


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise NoData("No data found for your request.")
    return df


def lite_columns(
    df: DataFrame, mandatory: Sequence[str], optional: Sequence[str], disabled: Sequence[str] = ()
) -> DataFrame:
    """Only the columns of the lite data model, variants of a name from other tables included."""
    keep = (set(mandatory) | set(optional)) - set(disabled)
    chosen = [c for c in df.columns if c not in disabled and c.split("|")[0] in keep]
    return df.select(*[F.col(f"`{c}`") for c in chosen])


def plain_coordinates(df: DataFrame) -> DataFrame:
    """Give the observation's own coordinate, else the header's or the station's, the plain name.

    With both of the latter and no own coordinate, all keep their names.
    """
    names = {}
    for coordinate in COORDINATES:
        own, header, station = (
            f"{coordinate}|{t}" for t in ("observations_table", "header_table", "station_configuration")
        )
        if own in df.columns:
            names[own] = coordinate
        elif (header in df.columns) != (station in df.columns):
            names[header if header in df.columns else station] = coordinate
    return df.withColumnsRenamed(names)


def first_known(*columns: str) -> Column:
    """Row-wise choice of a coordinate, in the order given."""
    return F.coalesce(*[F.col(f"`{c}`") for c in columns])


def decode(df: DataFrame, column: str, labels: Mapping[int, str]) -> Column:
    """Label of a coded value; NULL for an unknown code."""
    return F.try_element_at(literal_map(dict(labels)), F.col(column))


def decode_by_table(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Labels through a code table (code, label); a common code is spread over tasks."""
    return salted_join(df, codes.withColumnRenamed("code", column), [column], df.columns, "left")


def extract_summary(df: DataFrame, order: str = "observation_id", by: Sequence[str] = ()) -> DataFrame:
    """Extent of an extract, or of each group of ``by``, with first and last report by an explicit row order."""
    return df.groupBy(*by).agg(
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
        F.date_format(F.min_by("report_timestamp", order), "yyyyMMdd").alias("time_start"),
        F.date_format(F.max_by("report_timestamp", order), "yyyyMMdd").alias("time_end"),
    )


def variables_and_units(df: DataFrame) -> DataFrame:
    return df.select("observed_variable", "units").distinct()


def text_widths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest width in bytes of text columns, one row per column."""
    widths = df.agg(*[F.max(F.octet_length(c)).cast("bigint").alias(c) for c in columns])
    return widths.unpivot([], list(columns), "column", "width")


def with_attributes(df: DataFrame, attributes: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach units, standard names and the like to columns."""
    fixed = {  # fixed values
        "height_of_station_above_sea_level": {"units": "m"},
        "longitude": {"standard_name": "longitude", "units": "degrees_east"},
        "latitude": {"standard_name": "latitude", "units": "degrees_north"},
        "report_timestamp": {"standard_name": "time"},
    }
    for name in df.columns:
        known = {**fixed.get(name, {}), **attributes.get(name, {})}
        if known:
            df = df.withMetadata(name, known)
    return df


def append_history(history: str | None, text: str) -> str:
    return text if history is None else f"{history}\n{text}"
