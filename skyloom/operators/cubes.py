"""Hypercube algebra: a cube is a row with one array per key and stands for the product of its values.

Work that needs single fields goes through :func:`unfold`; every other
operator stays on the arrays.  Set operations join on all keys of a field, so
no key can be hot.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.dates import range_struct
from skyloom.operators.scale import running_offsets, union_all
from skyloom.session import checkpointed


PIECE = 100_000  # fields that one row unfolds to at most
FAST_STORE_CHUNK = 5000  # fixed values: fields of one call to either store
SLOW_STORE_CHUNK = 900


def expand_dates(texts: Column) -> Column:
    """Dates and ``a/b`` ranges, as text, to a list of dates in the given order."""
    return F.flatten(
        F.transform(
            texts,
            lambda t: F.coalesce(
                F.sequence(range_struct(t)["start"], range_struct(t)["end"]), F.array().cast("array<date>")
            ),
        )
    )


def unreadable_dates(texts: Column) -> Column:
    """Texts that :func:`expand_dates` cannot read: no date, or a range that runs backwards."""
    return F.filter(texts, lambda t: range_struct(t).isNull())


def unfold(cubes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cubes to single fields, one scalar column per key."""
    return unfold_with_ordinal(cubes, keys, "_ordinal").drop("_ordinal")


def unfold_with_ordinal(cubes: DataFrame, keys: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Single fields with their position in the cube, the last key running fastest.

    A cube of any size is cut into ranges of positions, which are dealt out over
    the cluster before they are unfolded.  A field follows from its position
    alone (mixed radix), so it needs no sort and no window.  A cube of
    more fields than a bigint can count is an error.
    """
    if not keys:
        return cubes.withColumn(name, F.lit(0).cast("bigint"))
    total = F.coalesce(field_count(keys), F.when(_any_absent(keys), F.lit(0)).otherwise(F.raise_error(F.lit("a cube has too many fields"))))
    pieces = cubes.withColumn("_total", total.cast("bigint")).where("_total > 0")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("_total") - 1, F.lit(PIECE).cast("bigint"))
    spread = _spread(pieces.withColumn("_from", F.explode(starts)))
    upto = F.least(F.col("_total"), F.col("_from") + PIECE) - 1
    fields = spread.withColumn(name, F.explode(F.sequence(F.col("_from"), upto))).drop("_from", "_total")
    place, picked = F.col(name), {}
    for key in reversed(keys):
        size = F.size(key).cast("bigint")
        picked[key] = F.get(F.col(key), F.pmod(place, size).cast("int"))
        place = F.expr(f"{name} div ({' * '.join(f'size(`{k}`)' for k in keys[keys.index(key):])})") if len(keys) > 1 else place
    order = [c for c in cubes.columns]
    return fields.select(*[picked[c].alias(c) if c in picked else F.col(c) for c in order], name)


def _any_absent(keys: Sequence[str]) -> Column:
    absent = F.lit(False)
    for key in keys:
        absent = absent | F.col(key).isNull()
    return absent


def _spread(rows: DataFrame) -> DataFrame:
    """Deal rows out by their scalar columns.  A given number of partitions is not made smaller at run time."""
    scalars = [c for c, t in rows.dtypes if not t.startswith(("array", "map", "struct"))]
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *scalars)


def count_fields(
    cubes: DataFrame, keys: Sequence[str], by: Sequence[str] = (), ignore: Sequence[str] = ()
) -> DataFrame:
    """How many fields the cubes hold, without unfolding them."""
    counted = F.sum(field_count([k for k in keys if k not in ignore])).alias("n_fields")
    return cubes.groupBy(*by).agg(counted) if by else cubes.agg(counted)


def field_count(keys: Sequence[str]) -> Column:
    """Fields of a cube; NULL where a bigint cannot count them or a key is absent."""
    product = F.lit(1).cast("bigint")
    for key in keys:
        product = F.try_multiply(product, F.when(F.col(key).isNotNull(), F.size(key).cast("bigint")))
    return product


def distinct_fields(cubes: DataFrame, keys: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """Fields of overlapping cubes, each once."""
    return unfold(cubes, keys).select(*scope, *keys).distinct()


def difference(fields: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fields that the other set does not have."""
    return fields.join(other.select(*keys).distinct(), list(keys), "left_anti")


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every field of either set once, with ``side`` saying left, right or both."""
    marked = (
        left.select(*keys)
        .withColumn("_l", F.lit(True))
        .withColumn("_r", F.lit(False))
        .unionByName(right.select(*keys).withColumn("_l", F.lit(False)).withColumn("_r", F.lit(True)))
    )
    seen = marked.groupBy(*keys).agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right")
    return seen.select(*keys, side.alias("side"))


def same_fields(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Whether two sets hold the same fields, over all or for each value of ``by``."""
    sides = compare(left, right, [*by, *[k for k in keys if k not in by]])
    same = F.bool_and(F.col("side") == "both").alias("same")
    return sides.groupBy(*by).agg(same) if by else sides.agg(same)


def unfold_open(cubes: DataFrame, keys: str = "keys", field: str = "field") -> DataFrame:
    """Cubes with keys of their own (a map of key to list) to single fields.

    A field is a list of (key, value) in order of keys, so fields of different
    key sets never compare equal.  Keys are unfolded one after the other; how
    many passes that takes is the largest number of keys in a request.
    """
    entries = cubes.withColumn("_entries", F.array_sort(F.map_entries(keys))).drop(keys)
    most = entries.agg(F.max(F.size("_entries"))).first()[0] or 0
    fields = entries.withColumn(field, F.array().cast("array<struct<key:string,value:string>>"))
    for i in range(most):
        entry = F.get("_entries", i)
        pairs = F.transform(entry["value"], lambda v: F.struct(entry["key"].alias("key"), v.alias("value")))
        rest = [c for c in fields.columns if c != "_pair"]
        fields = fields.where(entry.isNull() | (F.size(pairs) > 0))  # an empty list stands for no field
        fields = fields.select(*rest, F.explode_outer(pairs).alias("_pair"))
        longer = F.concat(field, F.array("_pair"))
        fields = fields.withColumn(field, F.when(F.col("_pair").isNotNull(), longer).otherwise(F.col(field)))
        fields = fields.drop("_pair")
    return fields.drop("_entries")


def field_text(field: Column) -> Column:
    """A field with keys of its own as ``key=value`` text."""
    return F.array_join(F.transform(field, lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";")


def key_set(keys: Column) -> Column:
    """The sorted key names of an open-keyed request."""
    return F.array_sort(F.map_keys(keys))


def unequal_key_sets(requests: DataFrame, by: Sequence[str], keys: str = "keys") -> DataFrame:
    """Groups whose requests do not all have the same keys, which rules out one envelope for them."""
    n = F.count_distinct(key_set(F.col(keys)))
    return requests.groupBy(*by).agg(n.alias("n_key_sets")).where("n_key_sets > 1")


def merge(fields: DataFrame, keys: Sequence[str], scope: Sequence[str] = (), barred: Sequence[str] = ()) -> DataFrame:
    """Join fields back into few cubes, one pass per key.

    Each pass puts together cubes that agree on all other keys.  A barred key
    keeps one value per cube.  An array holds at most the distinct values of
    its key.
    """
    cubes = fields.select(*scope, *[F.array(k).alias(k) for k in keys])
    passes = [k for k in keys if k not in barred]
    if not passes:
        return cubes.distinct()
    for key in passes:  # the first pass also drops repeated fields
        others = [*scope, *[k for k in keys if k != key]]
        cubes = cubes.groupBy(*others).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(key)))).alias(key))
    return cubes.select(*scope, *keys)


def merge_cubes(cubes: DataFrame, keys: Sequence[str], scope: Sequence[str], place: str, barred: Sequence[str] = ()) -> DataFrame:
    """Merge cubes that differ in one key at most, again and again until none do; no field is listed.

    In each round every scope takes the key that saves most cubes, the earlier one on a tie.  A merged
    cube stands at the smallest ``place`` of its parts, and its values in the order in which they are first seen.  Cubes without
    values in common stay apart as long as they differ in two keys.  A list holds distinct values only, and the driver
    sees one number a round.
    """
    free = [k for k in keys if k not in barred]
    columns = [*scope, place, *keys]
    open_, done = cubes.select(*columns), cubes.select(*columns).where("false")
    while free:
        others = {k: F.struct(*[F.array_sort(o) for o in keys if o != k], F.lit(k)) for k in free}
        saved = [(F.count(F.lit(1)) - F.count_distinct(c)).alias(f"_saved_{k}") for k, c in others.items()]
        counts = open_.groupBy(*scope).agg(*saved)
        best = F.greatest(F.lit(0), *[F.col(f"_saved_{k}") for k in free])
        chosen = F.coalesce(*[F.when((best > 0) & (F.col(f"_saved_{k}") == best), F.lit(k)) for k in free])
        marked = checkpointed(open_.join(counts.select(*scope, chosen.alias("_key")), list(scope)))
        done = done.unionByName(marked.where("_key IS NULL").select(*columns))
        going = marked.where("_key IS NOT NULL")
        if going.isEmpty():
            break
        open_ = union_all([_merged_on(going.where(F.col("_key") == k), k, keys, scope, place) for k in free])
    return done if free else open_


def _merged_on(cubes: DataFrame, key: str, keys: Sequence[str], scope: Sequence[str], place: str) -> DataFrame:
    """One cube for all that agree in the other keys, whatever the order of their values."""
    same = {f"_same_{k}": F.array_sort(k) for k in keys if k != key}
    by = [*scope, *same]
    named = cubes.withColumns(same)
    # the other keys as the first of the cubes has them
    first = named.groupBy(*by).agg(F.min(F.struct(place, *[k for k in keys if k != key])).alias("_first"))
    values = named.select(*by, place, F.posexplode(key).alias("_at", "_value"))
    seen = values.groupBy(*by, "_value").agg(F.min(F.struct(place, "_at")).alias("_seen"))
    listed = seen.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_seen", "_value"))).alias("_list"))
    fields = {k: F.col("_list._value") if k == key else F.col(f"_first.{k}") for k in keys}
    merged = first.join(listed, by)
    return merged.select(*scope, F.col(f"_first.{place}").alias(place), *[c.alias(k) for k, c in fields.items()])


def split(cubes: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Fields of each cube with the number of the piece they fall in; no piece exceeds ``size``."""
    return unfold_with_ordinal(cubes, keys).withColumn("piece", F.floor(F.col("ordinal") / size).cast("bigint"))


def chunk(
    cubes: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, max_groups: int | None = None
) -> DataFrame:
    """Fields of many cubes with a group number; groups hold ``size`` fields, cubes in the given order.

    Only the cubes are put in order; the place of a field follows from the
    fields before its cube and its own position in it.
    """
    placed = running_offsets(cubes, order, field_count(keys), "_before")
    fields = unfold_with_ordinal(placed, keys, "_within")
    group = F.floor((F.col("_before") + F.col("_within")) / size).cast("bigint")
    fields = fields.withColumn("chunk", group).drop("_before", "_within")
    return fields if max_groups is None else fields.where(F.col("chunk") < max_groups)


def take_first(cubes: DataFrame, keys: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` fields of every cube, and the fields that remain."""
    fields = unfold_with_ordinal(cubes, keys)
    return fields.where(F.col("ordinal") < n), fields.where(F.col("ordinal") >= n)


def split_on(cubes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One cube per value of the named keys, each still a one-element list."""
    for key in keys:
        cubes = cubes.withColumn(key, F.explode(key)).withColumn(key, F.array(key))
    return cubes


def split_by_month(cubes: DataFrame, key: str = "d") -> DataFrame:
    """One cube per calendar month of its dates, dates in the order given."""
    months = F.array_distinct(F.transform(key, lambda d: F.trunc(d, "month")))
    return cubes.withColumn("month", F.explode(months)).withColumn(
        key, F.filter(key, lambda d: F.trunc(d, "month") == F.col("month"))
    )


def envelope(cubes: DataFrame, keys: Sequence[str], by: Sequence[str], position: str) -> DataFrame:
    """Distinct values per key over all cubes of a group, in order of first appearance.

    The first place of each value is found before anything is listed, so a list
    holds distinct values only.
    """
    lists = F.array(*[F.col(k).cast("array<string>") for k in keys])
    by_key = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), lists)
    entries = cubes.select(*by, position, F.explode(by_key).alias("key", "_values"))
    entries = entries.select(*by, "key", position, F.posexplode("_values").alias("_place", "value"))
    firsts = entries.groupBy(*by, "key", "value").agg(F.min(F.struct(position, "_place")).alias("_first"))
    listed = firsts.groupBy(*by, "key").agg(F.array_sort(F.collect_list(F.struct("_first", "value"))).alias("_list"))
    return listed.select(*by, "key", F.col("_list.value").alias("values"))


def canonical_values(values: Column) -> Column:
    """Values sorted, as numbers when all of them are numbers."""
    numeric = F.forall(values, lambda v: v.try_cast("double").isNotNull())
    by_number = F.transform(
        F.array_sort(F.transform(values, lambda v: F.struct(v.try_cast("double").alias("n"), v.alias("v")))),
        lambda s: s["v"],
    )
    return F.when(numeric, by_number).otherwise(F.array_sort(values))


def order_preserving_distinct(values: Column) -> Column:
    return F.array_distinct(values)


def runs_of_dates(dates: DataFrame, by: Sequence[str], date: str = "d") -> DataFrame:
    """Runs of consecutive days per group as start, end and text.

    Days are made distinct first, so a group's window holds at most the days
    of its period.
    """
    days = dates.select(*by, date).distinct()
    place = F.row_number().over(Window.partitionBy(*by).orderBy(date))
    runs = days.withColumn("_run", F.date_sub(F.col(date), place)).groupBy(*by, "_run")
    spans = runs.agg(F.min(date).alias("start"), F.max(date).alias("end")).drop("_run")
    return spans.withColumn("span", span_text(F.col("start"), F.col("end")))


def span_text(start: Column, end: Column) -> Column:
    return F.when(start == end, F.date_format(start, "yyyy-MM-dd")).otherwise(
        F.concat_ws("/", F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd"))
    )
