"""A dataset as configuration plus operators, and several of them behind one request."""

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.errors import InvalidRequest, NoData
from skyloom.operators.scale import union_all
from skyloom.session import scratch
from skyloom.tables import literal_rows

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Dataset:
    """How one dataset answers a request.

    ``read`` turns a translated request into rows, ``steps`` are run on them in
    order.  One request is a small dictionary, so its translation is plain
    Python; tables of requests go through ``operators.requests``.
    """

    name: str
    read: Callable[[dict], DataFrame]
    mapping: Mapping = field(default_factory=dict)
    steps: Sequence[Callable[[DataFrame], DataFrame]] = ()

    def translate(self, request: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
        keys = {**self.mapping.get("defaults", {}), **request}
        remap, rename = self.mapping.get("remap", {}), self.mapping.get("rename", {})
        mapped = {rename.get(k, k): [remap.get(k, {}).get(v, v) for v in vs] for k, vs in keys.items()}
        return mapped | dict(self.mapping.get("force", {}))

    def retrieve(self, request: Mapping[str, Sequence[str]]) -> DataFrame:
        df = self.read(self.translate(request))
        for step in self.steps:
            df = df.transform(step)
        return df


def unite_sources(sources: Mapping[str, Callable[[], DataFrame]]) -> tuple[DataFrame, dict[str, Exception]]:
    """Rows of all sources with a ``source`` column; a source that cannot answer is left out.

    All sources failing is an error.
    """
    parts: list[DataFrame] = []
    failed: dict[str, Exception] = {}
    for name, read in sources.items():
        try:
            parts.append(read().withColumn("source", F.lit(name)))
        except (AnalysisException, InvalidRequest, NoData) as problem:
            log.warning("source %s gives nothing: %s", name, problem)
            failed[name] = problem
    if not parts:
        raise NoData("no source could answer the request")
    return union_all(parts), failed


OUTCOMES = {"source": "string", "answered": "boolean", "fault": "string"}


def unite_written(
    spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]]
) -> tuple[DataFrame, DataFrame]:
    """Rows of all sources as in :func:`unite_sources`, and an outcome for each: also a fault while a source is read counts.

    Each source is written to the shared folder by a job of its own, after
    Spark's own retries.  The rows come from the sources that were written
    whole; what a failed job left behind is not read.  All sources failing is an
    error.
    """
    parts: list[DataFrame] = []
    outcomes: list[dict] = []
    for name, read in sources.items():
        path = scratch(spark, "source")
        try:
            rows = read()
            rows.write.parquet(path)
        except (PySparkException, Py4JJavaError, InvalidRequest, NoData) as problem:
            fault = str(problem).partition("\n")[0]
            log.warning("source %s gives nothing: %s", name, fault)
            outcomes.append({"source": name, "answered": False, "fault": fault})
            continue
        parts.append(spark.read.schema(rows.schema).parquet(path).withColumn("source", F.lit(name)))
        outcomes.append({"source": name, "answered": True})
    if not parts:
        raise NoData("no source could answer the request")
    return union_all(parts), spark.range(1).select(F.inline(literal_rows(outcomes, OUTCOMES)))
