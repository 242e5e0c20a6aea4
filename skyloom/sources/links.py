"""Addresses of files: expansion of patterns, plan of what to fetch, and the outcome."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import extension

PLACEHOLDER = re.compile(r"\{\{\s*(\w+)\s*\}\}")
RETRIABLE = [408, 429, 500, 502, 503, 504]  # fixed values: HTTP codes worth another try
FINAL_FTP = ["ftp_550", "ftp_553"]  # fixed values
TIMEOUTS = ["connection_error", "read_timeout"]  # fixed values


def render(pattern: str, columns: Sequence[str]) -> Column | None:
    """A pattern with its placeholders filled from columns; None when the fields have no such key."""
    pieces, at = [], 0
    for found in PLACEHOLDER.finditer(pattern):
        if found.group(1) not in columns:
            return None
        pieces += [F.lit(pattern[at : found.start()]), F.col(found.group(1)).cast("string")]
        at = found.end()
    return F.trim(F.concat(*pieces, F.lit(pattern[at:])))


def expand(fields: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """One row per field and pattern with its address; empty ones and those lacking a key are skipped."""
    rendered = [u for u in (render(p, fields.columns) for p in patterns) if u is not None]
    urls = F.filter(F.array_compact(F.array(*rendered)), lambda u: u != "")
    return fields.withColumn("url", F.explode(urls))


def url_path(url: Column) -> Column:
    return F.ltrim(F.try_parse_url(url, F.lit("PATH")), F.lit("/"))


def fetch_plan(urls: DataFrame) -> DataFrame:
    """Each address once, sorted, with the path it is stored under."""
    return urls.select("url").distinct().withColumn("path", url_path(F.col("url"))).orderBy("url")


def outcome(status: Column, failure: Column, timeouts_are_fatal: bool = True) -> Column:
    """ok, skipped or fatal for one fetch."""
    skipped = ((status >= 400) & ~status.isin(RETRIABLE)) | failure.isin(FINAL_FTP)
    if not timeouts_are_fatal:
        skipped = skipped | failure.isin(TIMEOUTS)
    return F.when(skipped, "skipped").when((status >= 400) | (failure != ""), "fatal").otherwise("ok")


def request_outcome(log: DataFrame, timeouts_are_fatal: bool = True) -> DataFrame:
    """failed, partial or complete per request: one fatal fetch or no success at all fails it."""
    judged = log.withColumn("outcome", outcome(F.col("status"), F.col("failure"), timeouts_are_fatal))
    counted = judged.groupBy("request_id").agg(
        F.count_if(F.col("outcome") == "ok").alias("n_ok"),
        F.count_if(F.col("outcome") == "skipped").alias("n_skipped"),
        F.bool_or(F.col("outcome") == "fatal").alias("_fatal"),
    )
    result = (
        F.when(F.col("_fatal") | (F.col("n_ok") == 0), "failed")
        .when(F.col("n_skipped") > 0, "partial")
        .otherwise("complete")
    )
    return counted.withColumn("result", result).drop("_fatal")


def group_by_type(paths: DataFrame, path: str = "path") -> DataFrame:
    return paths.groupBy(extension(F.col(path)).alias("type")).agg(F.count(F.lit(1)).alias("n_files"))
