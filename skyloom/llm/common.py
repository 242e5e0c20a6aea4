"""What several operators of this package share: tables in the shared folder, ranks by blocks, components, slices."""

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.session import scratch


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and go on from there.

    This cuts the lineage: a lost executor costs the tasks it ran, and a second
    reader does not compute the rows again.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def block_count(rows: int) -> int:
    """About the root of ``rows``: neither the blocks nor the rows in one grow with all rows."""
    return 1 << max(0, math.ceil(math.log2(max(rows, 1)) / 2))


def running_before(
    df: DataFrame, group: str, block: str, order: Sequence[str], weight: Column | None = None, name: str = "before"
) -> DataFrame:
    """Add the sum of ``weight`` (1 where none is given) over the rows of a group that come earlier.

    Rows stand in the order of ``block`` and then of ``order``.  Sums of blocks are aggregated first, so that
    a task holds either the blocks of one group or the rows of one block, never a group.  Rows equal in
    ``order`` take the places of each other.  ``group`` must not be null.
    """
    amount = F.lit(1).cast("long") if weight is None else weight
    totals = df.groupBy(group, block).agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(group, block, F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast("long")).alias("_base"))
    within = Window.partitionBy(group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(amount).over(within), F.lit(0).cast("long"))
    return df.join(bases, [group, block]).withColumn(name, F.col("_base") + local).drop("_base")


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of ``edges`` (long ``a``, long ``b``) reaches, as ``node`` and ``root``.

    Every round links all larger neighbours of a node to its smallest one, then all smaller ones, and writes the
    links; the number of rounds grows with the logarithm of the longest path.  Minima are aggregated
    before the shuffle, and a node with very many neighbours is an ordinary skewed join.  Nodes without
    an edge to another have no row.
    """
    links = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    state = _state(links)
    while state[0]:
        links = written(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(links: DataFrame) -> tuple:
    wide = "decimal(20,0)"
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.col("a").cast(wide)), F.sum(F.col("b").cast(wide)), F.sum(F.hash("a", "b").cast("long"))
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
    return moved.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct()


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice have about ``most_bytes``; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)
