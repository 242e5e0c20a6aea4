"""Register every query with the SQL that gives the same rows."""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.plans.views import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Add a query; the views its SQL names are put in front as a WITH list."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, folder)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return build

    return add


def with_views(sql: str) -> str:
    needed: list[str] = []

    def need(text: str) -> None:
        for view in re.findall(r"\bv_\w+", text):
            if view in SQL_VIEWS and view not in needed:
                need(SQL_VIEWS[view])
                if view not in needed:
                    needed.append(view)

    need(sql)
    sql = sql.strip()
    views = [f"{v} AS ({SQL_VIEWS[v].strip()})" for v in needed]
    if not views:
        return sql
    if sql.upper().startswith("WITH "):
        return "WITH " + ",\n".join(views) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(views) + "\n" + sql


def near(value: Column) -> Column:
    """Six places, with exact halves moved off the edge where the order of a sum would decide."""
    return F.round(value + 1e-9, 6)
