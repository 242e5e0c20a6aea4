"""Schemas of the core tables and the way data gets in."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

REQUESTS = T.StructType(
    [
        T.StructField("request_id", T.LongType(), False),
        T.StructField("dataset", T.LongType()),
        T.StructField("keys", T.MapType(T.StringType(), STRINGS)),
    ]
)

CONSTRAINTS = T.StructType(
    [
        T.StructField("constraint_id", T.LongType(), False),
        T.StructField("dataset", T.LongType()),
        T.StructField("keys", T.MapType(T.StringType(), STRINGS)),
    ]
)

GRID = T.StructType(
    [
        T.StructField("variable", T.StringType(), False),
        T.StructField("valid_time", T.TimestampNTZType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)

OBSERVATIONS = T.StructType(
    [
        T.StructField("observation_id", T.LongType(), False),
        T.StructField("report_timestamp", T.TimestampNTZType(), False),
        T.StructField("primary_station_id", T.StringType()),
        T.StructField("observed_variable_code", T.IntegerType()),
        T.StructField("observed_variable", T.StringType()),
        T.StructField("observation_value", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("processing_level", T.IntegerType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("request_id", T.LongType(), False),
        T.StructField("rule_id", T.StringType(), False),
        T.StructField("reason_group", T.StringType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("message", T.StringType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a core table in its types, other columns after them."""
    core = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    names = set(schema.names)
    return df.select(*core, *[F.col(f"`{c}`") for c in df.columns if c not in names])


def missing_as_null(df: DataFrame, *columns: str) -> DataFrame:
    """NaN stands for a missing value in grids; NULL does in every aggregate here."""
    return df.withColumns({c: nan_to_null(F.col(c)) for c in columns})


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def literal_rows(rows: list[dict], types: dict[str, str]) -> Column:
    """A small configuration table as one constant array of structs.

    Exploding or filtering it is row-local, so looking something up in a
    configuration never needs a join.
    """
    if not rows:
        raise ValueError("a configuration table needs at least one row")
    return F.array(
        *[F.struct(*[F.lit(row.get(c)).cast(t).alias(c) for c, t in types.items()]) for row in rows]
    )


def literal_map(mapping: dict) -> Column:
    """A small value map as one constant map column."""
    if not mapping:
        raise ValueError("a value map needs at least one entry")
    return F.create_map(*[F.lit(item) for pair in mapping.items() for item in pair])
