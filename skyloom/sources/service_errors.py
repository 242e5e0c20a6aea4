"""Error texts of outside services: which are final, and what to show of them."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KNOWN_PHRASES = {  # fixed values
    "no data": ["Error: incorrect dates", "Error: no data available for the period"],
    "bad request": [
        "outside of the satellite field of view",
        "Maximum number of daily requests reached",
        "Unknown string format",
    ],
}


def phrase_group(text: Column, phrases: Mapping[str, Sequence[str]] = KNOWN_PHRASES) -> Column:
    """Group of the last known phrase in the text, in any case; NULL when there is none."""
    lower, group = F.lower(text), F.lit(None).cast("string")
    for name, known in phrases.items():
        for phrase in known:
            group = F.when(F.contains(lower, F.lit(phrase.lower())), name).otherwise(group)
    return group


def tidy(text: Column) -> Column:
    """Lines of a message joined by semicolons, without the service's own prefix."""
    text = F.regexp_replace(text, "^Process error: *(.+)", "$1")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda l: F.trim(l)), lambda l: l != "")
    return F.regexp_replace(F.array_join(lines, "; "), r"^ *Failed to execute WPS process \[\w+\]: *", "")


def classify_errors(
    log: DataFrame, by: Sequence[str], text: str, phrases: Mapping[str, Sequence[str]] = KNOWN_PHRASES
) -> DataFrame:
    """Per request: final when there is exactly one error and it is a known one, else retried.

    The single text is taken by ``min``, which is only looked at when it is the
    only one.
    """
    judged = log.withColumn("_group", phrase_group(F.col(text), phrases))
    summed = judged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_errors"), F.min("_group").alias("_group"), F.min(tidy(F.col(text))).alias("_text")
    )
    final = (F.col("n_errors") == 1) & F.col("_group").isNotNull()
    return summed.select(
        *by,
        "n_errors",
        F.when(final, F.col("_group")).otherwise("retry").alias("verdict"),
        F.when(final, F.col("_text")).otherwise("").alias("shown"),
    )
