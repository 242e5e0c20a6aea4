"""Requests, constraints and forms that come as JSON text, one document per row.

Keys are open: documents of different datasets have different ones.  A scalar
and a list of one mean the same.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDGETS = """array<struct<name: string, label: string, type: string, details: struct<
 values: array<string>, minStart: string, maxEnd: string, groups: array<string>>>>"""


def open_keys(text: Column) -> Column:
    """A JSON object to map<key, list of text>; null becomes an empty list."""
    raw = F.from_json(text, "map<string,string>")
    return F.transform_values(raw, lambda _, v: _as_list(v))


def _as_list(value: Column) -> Column:
    return (
        F.when(value.isNull(), F.array().cast("array<string>"))
        .when(value.startswith("["), F.from_json(value, "array<string>"))
        .otherwise(F.array(value))
    )


def requests(documents: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Requests as maps of key to list."""
    return documents.select(*keep, open_keys(F.col(text)).alias("keys"))


def key_columns(rows: DataFrame, keys: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One column per key of a dataset; NULL where a row lacks the key."""
    return rows.select(*keep, *[F.try_element_at("keys", F.lit(k)).alias(k) for k in keys])


def constraints(documents: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """One row per constraint of each dataset's list, its values as sorted distinct lists."""
    rows = F.from_json(F.col(text), "array<map<string,string>>")
    opened = documents.select(*keep, F.posexplode(rows).alias("constraint_no", "_row"))
    lists = F.transform_values("_row", lambda _, v: F.array_sort(F.array_distinct(_as_list(v))))
    return opened.select(*keep, "constraint_no", lists.alias("keys"))


def forms(documents: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Widgets of a form as rows, the values of nested groups of any depth put together."""
    opened = documents.select(*keep, F.explode(F.from_json(F.col(text), WIDGETS)).alias("w"))
    listed = "array<string>"

    def inside(group: Column, path: str) -> Column:
        return F.from_json(F.get_json_object(group, path), listed)

    def deeper(state: Column, _: Column) -> Column:
        values = F.flatten(F.array_compact(F.transform(state["open"], lambda g: inside(g, "$.values"))))
        plain = F.filter(state["open"], lambda g: F.get_json_object(g, "$.values").isNull())
        groups = F.flatten(F.array_compact(F.transform(plain, lambda g: inside(g, "$.details.groups"))))
        return F.struct(groups.alias("open"), F.concat(state["found"], F.array(values)).alias("found"))

    groups = F.col("w.details.groups")
    # no group lies deeper than the word stands in the text of the groups
    levels = F.sequence(F.lit(0), F.regexp_count(F.to_json(groups), F.lit("groups")))
    start = F.struct(groups.alias("open"), F.array().cast("array<array<string>>").alias("found"))
    found = F.when(groups.isNotNull(), F.aggregate(levels, start, deeper, lambda s: s["found"]))
    return opened.select(
        *keep,
        F.col("w.name").alias("name"),
        F.col("w.type").alias("type"),
        F.col("w.details.values").alias("values"),
        found.alias("groups"),
        F.col("w.details.minStart").alias("min_start"),
        F.col("w.details.maxEnd").alias("max_end"),
    )
