"""Message headers as rows: naming them, and splitting files into like parts."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify(encodings: Sequence[Mapping[str, object]], headers: Mapping[str, Column]) -> Column:
    """Name of the first encoding whose keys all agree with the header; NULL when none does.

    An encoding is a row of ``name`` and header keys; a missing key agrees with
    anything.  The definitions become one CASE expression, so no join is needed.
    """
    name = F.lit(None).cast("string")
    for encoding in reversed(encodings):
        agrees = F.lit(True)
        for key, value in encoding.items():
            if key != "name":
                agrees = agrees & (headers[key] == F.lit(value))
        name = F.when(agrees, F.lit(encoding["name"])).otherwise(name)
    return name


def split_tags(
    headers: DataFrame, by: str, split_on: Sequence[str], aliases: Mapping[str, str], base: str = ""
) -> DataFrame:
    """The parts a file is split into, as tags ``key-value_key-value``.

    With an alias, a file that has more than one value of the first key is
    split on the second.
    """
    wanted = list(dict.fromkeys([*split_on, *aliases.keys(), *aliases.values()]))
    seen = headers.groupBy(by).agg(
        *[F.array_sort(F.collect_set(F.col(k).cast("string"))).alias(f"_{k}") for k in wanted]
    )
    nothing = F.array(F.lit(None).cast("string"))
    tags = seen.select(by, *[F.col(f"_{k}") for k in wanted])
    parts = []
    for key in split_on:
        tags = tags.withColumn(f"t_{key}", F.explode(f"_{key}"))
        parts.append(F.concat(F.lit(f"{key}-"), F.col(f"t_{key}")))
    for first, second in aliases.items():
        values = F.when(F.size(f"_{first}") > 1, F.col(f"_{second}")).otherwise(nothing)
        tags = tags.withColumn(f"t_{second}", F.explode(values))
        parts.append(F.concat(F.lit(f"{second}-"), F.col(f"t_{second}")))
    return tags.select(by, F.concat_ws("_", *([F.lit(base)] if base else []), *parts).alias("tag"))


def duplicate_fields(headers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fields of a cube that occur more than once."""
    return headers.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def same_grid(headers: DataFrame, by: Sequence[str], grid: Sequence[str]) -> DataFrame:
    """Whether all fields of a file lie on one grid."""
    return headers.groupBy(*by).agg(
        F.count_distinct(*grid).alias("n_grids"), (F.count_distinct(*grid) == 1).alias("same_grid")
    )
