"""Building blocks that keep every task bounded when keys are skewed.

* running totals over a whole table without a one-task window,
* joins that emit only pairs with a value in common,
* range joins through coarse cells instead of nested loops,
* salting for a key that holds a large part of the rows.

Salting copies the smaller side, so it is used where that side is a lookup:
constraints, codes, axes, group sizes.  Where both sides are tables of fields
the join is left to Spark, whose adaptive execution splits a skewed partition
of the left side at run time.  No join here carries a broadcast hint, and a side
that is copied is kept from a broadcast that only its size before the copies allows.
"""

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from math import inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.errors import NoData
from skyloom.session import checkpointed

ABSENT = "\u0000absent"  # token of a key that one side leaves open


POSITION_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its lower bits


def row_ordinals(df: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Number all rows from 0 in the given order.

    One range shuffle sorts the rows over the cluster.  They are then written
    once, so that a second read sees the same partitions and positions.  Only
    the size of each partition is brought together.
    """
    ranged = checkpointed(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", POSITION_BITS).cast("int")
    base = _bases(ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("total")))
    place = F.col("_at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return ranged.withColumn(name, F.get(base, part) + place).drop("_at")


def running_offsets(df: DataFrame, order: Sequence[str], weight: Column, name: str = "offset") -> DataFrame:
    """Add the sum of ``weight`` over all rows before this one in the given order, which should be unique.

    As for :func:`row_ordinals`; a window inside each range partition adds up
    its own rows.
    """
    ranged = checkpointed(
        df.withColumn("_weight", weight.cast("bigint"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    base = _bases(ranged.groupBy(F.col("_part").alias("part")).agg(F.sum("_weight").alias("total")))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("_weight").over(within), F.lit(0))
    return ranged.withColumn(name, F.get(base, F.col("_part")) + local).drop("_part", "_weight")


def _bases(totals: DataFrame) -> Column:
    """Sum of all earlier partitions by partition number, as one constant array.

    One number per partition comes to the driver, however many rows there are.
    """
    sizes = {row["part"]: row["total"] for row in totals.collect()}
    bases, running = [], 0
    for part in range(max(sizes, default=-1) + 1):
        bases.append(running)
        running += sizes.get(part, 0)
    text = ",".join(map(str, bases)) or "0"
    return F.split(F.lit(text), ",").cast("array<bigint>")


def default_salts(df: DataFrame) -> int:
    """Copies of the small side: a few on a small session, 64 at most on a large one."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(64, partitions // 16))


IN_MEMORY = 4  # rows in memory against the compressed files that Spark's estimate goes by


def copied(df: DataFrame, copies: int) -> DataFrame:
    """A side of a join that ``explode`` made up to ``copies`` times as long.

    Spark's estimate leaves out what ``explode`` adds, so it would send a side of
    many rows whole through the driver.  Such a side is joined by a shuffle.
    """
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = conf.autoBroadcastJoinThreshold()
    return df.hint("merge") if size <= limit < size * copies * IN_MEMORY else df


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
    copies: int = 1,
) -> DataFrame:
    """Equality join that spreads each key of ``big`` over ``salts`` tasks.

    ``small`` is copied once per salt.  Right for inner, left, semi and anti
    joins, where every row of ``big`` must meet all rows of its key.  How many
    salts there are follows from the session's shuffle partitions.  ``copies``
    tells how many rows one row of ``small`` was made into before.
    """
    salts = salts or default_salts(big)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join cannot be salted on its left side")
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(copied(right, salts * copies), [*on, "_salt"], how).drop("_salt")


def matching_pairs(
    left: DataFrame,
    right: DataFrame,
    scope: Sequence[str],
    left_tokens: Column,
    right_tokens: Column,
    keep: Column,
    spread_by: Sequence[str] = (),
    salts: int | None = None,
) -> DataFrame:
    """Pairs of rows in the same scope with at least one token in common that ``keep`` accepts, each pair once.

    Both sides are exploded on their tokens, which makes this an equality join.
    A pair that meets on several tokens is kept on the smallest one only, so
    nothing has to be made distinct afterwards.  Tokens are joined by hash;
    ``keep`` must test the pair itself, which also drops chance meetings.
    """
    l_set, r_set, token = "_left_tokens", "_right_tokens", "_token"
    lefts = left.withColumn(l_set, _hashed(left_tokens)).withColumn(token, F.explode(l_set))
    rights = right.withColumn(r_set, _hashed(right_tokens)).withColumn(token, F.explode(r_set))
    on = [*scope, token]
    if spread_by:
        joined = salted_join(lefts, rights, on, spread_by, salts=salts, copies=USUAL_TOKENS)
    else:
        joined = lefts.join(copied(rights, USUAL_TOKENS), on)
    once = F.array_min(F.array_intersect(l_set, r_set)) == F.col(token)
    return joined.where(once & keep).drop(l_set, r_set, token)


USUAL_TOKENS = 16  # rows that one row is taken to make where it is exploded on its tokens


def _hashed(tokens: Column) -> Column:
    return F.array_distinct(F.transform(tokens, lambda t: F.xxhash64(t)))


def interval_pairs(
    left: DataFrame,
    right: DataFrame,
    scope: Sequence[str],
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    spread_by: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """Pairs of rows whose date ranges, both ends included, overlap; a range without days meets nothing.

    Rows that meet on a node of :func:`range_nodes` overlap, and a pair meets on
    one node, so nothing is tested or dropped after the join.  The left side is
    the large one.  The length of the longest range of the right side comes to the driver, as the
    left side needs no blocks longer than that around its starts.
    """
    node = "_node"
    start, end = map(F.col, right_range)
    longest = right.agg(F.max(F.unix_date(end) + 1 - F.unix_date(start))).first()[0] or 0
    around = max(1, min(NODE_LEVELS, int(longest).bit_length() if longest > 0 else 1))
    lefts = left.withColumn(node, F.explode(range_nodes(*map(F.col, left_range), asks=True, around_levels=around)))
    rights = right.withColumn(node, F.explode(range_nodes(*map(F.col, right_range), asks=False)))
    return salted_join(lefts, rights, [*scope, node], spread_by, salts=salts, copies=3 * NODE_LEVELS).drop(node)


NODE_LEVELS = 22  # blocks of 1, 2, 4 ... days; the largest are longer than all years a date can have


def range_nodes(start: Column, end: Column, asks: bool, around_levels: int = NODE_LEVELS) -> Column:
    """Blocks of days that a date range, both ends included, brings to a join; at most three for each level.

    Two ranges overlap if the start of the asking one lies in the other, or if
    the start of the other lies in the asking one after its first day, never
    both.  A start stands for all blocks around it, a range for the fewest
    blocks it consists of, so a start and a range have at most one in common.
    Around its start a range gets ``around_levels`` sizes of blocks, the smallest ones.
    """
    first, after = F.unix_date(start), F.unix_date(end) + 1
    levels = F.sequence(F.lit(0), F.lit(NODE_LEVELS - 1))

    def around(day: Column, kind: int) -> Column:
        sizes = F.sequence(F.lit(0), F.lit(around_levels - 1))
        return F.transform(sizes, lambda k: _node(F.call_function("shiftright", day, k), k, kind))

    def parts(low: Column, high: Column, kind: int) -> Column:
        def of(k: Column) -> Column:
            size = F.call_function("shiftleft", F.lit(1), k)
            a = F.call_function("shiftright", low + size - 1, k)  # first and last block inside the range; odd ones
            b = F.call_function("shiftright", high, k)  # have no larger block around them that is inside as well
            odd = [(a < b) & (x.bitwiseAND(F.lit(1)) == 1) for x in (a, b)]
            return F.array(F.when(odd[0], _node(a, k, kind)), F.when(odd[1], _node(b - 1, k, kind)))

        return F.array_compact(F.flatten(F.transform(levels, of)))

    if asks:
        nodes = F.concat(around(first, 0), parts(first + 1, after, 1))
    else:
        nodes = F.concat(parts(first, after, 0), around(first, 1))
    return F.when(first < after, nodes).otherwise(F.array().cast("array<bigint>"))


def _node(block: Column, level: Column, kind: int) -> Column:
    """Block, level and kind as one number."""
    return (block.cast("bigint") * 32 + level) * 2 + kind


def between_neighbours(rows: DataFrame, marks: DataFrame, at: str, spread_by: Sequence[str]) -> DataFrame:
    """Add to every row the last mark up to its value ``at`` and the first one from it on, as ``_before`` and ``_after``.

    ``marks`` has numbers in ``_mark``.  Rows and marks share one range shuffle,
    in which also the rows of one value are spread, and nothing is joined.  The
    least and the greatest mark of each partition come to the driver, to serve
    the partitions beside it.  Where there is no mark on a side, it is infinite.
    """
    both = rows.withColumns({"_at": F.col(at).cast("double"), "_spread": F.xxhash64(*spread_by)}).unionByName(
        marks.select("_mark", F.col("_mark").alias("_at"), F.lit(0).cast("bigint").alias("_spread")),
        allowMissingColumns=True,
    )
    order = ["_at", "_spread"]
    ranged = checkpointed(
        both.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    held = ranged.where(F.col("_mark").isNotNull()).groupBy("_part").agg(F.min("_mark"), F.max("_mark")).collect()
    if not held:
        raise NoData(f"no coordinates on {at}")
    ends = {part: (low, high) for part, low, high in held}
    parts = range(max(ends, default=-1) + 2)  # beyond the last mark all partitions are alike
    before = list(accumulate((ends.get(p, NO_MARK)[1] for p in parts[:-1]), max, initial=-inf))
    after = list(accumulate((ends.get(p, NO_MARK)[0] for p in reversed(parts[1:])), min, initial=inf))[::-1]
    up = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_part").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    place = F.least(F.col("_part"), F.lit(parts[-1]))
    near = ranged.withColumns(
        {
            "_before": F.coalesce(F.last("_mark", True).over(up), F.get(_numbers(before), place)),
            "_after": F.coalesce(F.last("_mark", True).over(down), F.get(_numbers(after), place)),
        }
    )
    return near.where(F.col("_mark").isNull()).drop("_mark", "_at", "_spread", "_part")


NO_MARK = (inf, -inf)  # least and greatest of nothing


def _numbers(values: Sequence[float]) -> Column:
    """A constant array of doubles."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<double>")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def group_ordinals(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "ordinal", salts: int | None = None
) -> DataFrame:
    """Number the rows of each group from 0, also when one group holds most rows.

    Ranks come from one sort over the cluster; the first rank of a group is
    then subtracted, with the groups salted for that join.
    """
    ranked = row_ordinals(df, [*by, *order], "_rank")
    firsts = ranked.groupBy(*by).agg(F.min("_rank").alias("_first"))
    placed = salted_join(ranked, firsts, by, order, salts=salts)
    return placed.withColumn(name, F.col("_rank") - F.col("_first")).drop("_rank", "_first")
