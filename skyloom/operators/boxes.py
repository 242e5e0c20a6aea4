"""Sets of fields kept as cubes: overlapping cubes made disjoint, and what a cube keeps when others are taken away.

A set of cubes is an array of structs with one list per key.  A key that a cube does not have is a list of one
NULL.  Both operations sweep over one key at a time: the values of a key fall into atoms, the values that
lie in the same cubes, and each atom goes on with the cubes that have it.  So no field is ever listed, and a
cube of any size costs what its values and its neighbours cost.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.scale import USUAL_TOKENS, copied, union_all

# Expressions are put together as SQL text, as Spark reads one long text much faster than it takes many small calls.


def name(column: str) -> str:
    return f"`{column}`"


def box(keys: Sequence[str]) -> str:
    """The cube of a row as a struct; an absent or empty list becomes a list of one NULL."""
    return _struct({k: f"IF(size({name(k)}) > 0, {name(k)}, array(NULL))" for k in keys})


def holds_fields(cube: str, keys: Sequence[str]) -> str:
    return " AND ".join(f"coalesce(size({cube}.{name(k)}) > 0, false)" for k in keys) or "true"


def disjoint(cubes: str, keys: Sequence[str]) -> Column:
    """Cubes without common fields that hold the same fields as ``cubes`` (SQL of a list of structs) together."""
    return F.expr(_swept(f"filter({cubes}, c -> {holds_fields('c', keys)})", keys, {}, False))


def residual(keys: Sequence[str], cubes: str) -> Column:
    """Disjoint cubes with the fields of the row's own cube that none of ``cubes`` has.

    Taking one cube away leaves one cube for each key at most.
    """
    return F.expr(_swept(f"filter({cubes}, c -> {holds_fields('c', keys)})", keys, {}, True))


def _swept(cubes: str, keys: Sequence[str], prefix: Mapping[str, str], own: bool) -> str:
    depth, key, rest = len(prefix), keys[0], keys[1:]
    here, lists, atom, there = (f"{v}{depth}" for v in ("here", "lists", "atom", "there"))
    values = name(key) if own else f"array_distinct(flatten({lists}))"
    if rest:
        fixed = {**prefix, key: atom}
        met = f"filter({here}, c -> size(array_intersect(c.{name(key)}, {atom})) > 0)"
        deeper = _swept(there, rest, fixed, own)
        if own:
            whole = _struct({**fixed, **{k: name(k) for k in rest}})
            deeper = f"IF(size({there}) = 0, array({whole}), {deeper})"
        found = f"flatten(transform({atoms(values, lists)}, {atom} -> {_let(met, there, deeper)}))"
    else:
        kept = f"array_except({values}, flatten({lists}))" if own else values
        found = f"filter(array({_struct({**prefix, key: kept})}), c -> size(c.{name(key)}) > 0)"
    found = _let(f"array_distinct(transform({here}, c -> c.{name(key)}))", lists, found)
    return _let(cubes, here, found)


def atoms(values: str, lists: str) -> str:
    """``values`` in groups: those that lie in the same of ``lists`` are together, in their order."""
    halves = "transform(groups, g -> array(array_intersect(g, one), array_except(g, one)))"
    return f"aggregate({lists}, array({values}), (groups, one) -> filter(flatten({halves}), g -> size(g) > 0))"


def _struct(lists: Mapping[str, str]) -> str:
    return "struct(" + ", ".join(f"{c} AS {name(k)}" for k, c in lists.items()) + ")"


def _let(value: str, variable: str, use: str) -> str:
    """``use`` of a value that is worked out once."""
    return f"get(transform(array({value}), {variable} -> {use}), 0)"


def volume(
    cubes: str, keys: Sequence[str], weights: Mapping[str, Mapping[str, int]] = {}, factors: Mapping[str, int] = {}
) -> Column:
    """Sum over the fields of disjoint cubes of their values' weights times the factors of the keys; 1 where none is given.

    A number beyond 64 bits is an error.
    """
    product = " * ".join(f"{weighted_size(f'c.{name(k)}', weights.get(k, {}))} * {int(factors.get(k, 1))}L" for k in keys)
    return F.expr(f"aggregate({cubes}, 0L, (total, c) -> total + {product or '1L'})")


def weighted_size(values: str, weights: Mapping[str, int]) -> str:
    """How many values there are, each by its weight; that of an absent key is looked up as empty text."""
    more = [
        f" + IF(exists({values}, v -> coalesce(v, '') = {literal(value)}), {int(weight) - 1}L, 0L)" for value, weight in weights.items()
    ]
    return f"(bigint(size({values})){''.join(more)})"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parts_in_common(
    left: DataFrame, right: DataFrame, keys: Sequence[str], id_column: str, meet_on: str, scope: Sequence[str] = ()
) -> DataFrame:
    """For each cube of ``left``, the distinct parts of it that cubes of ``right`` have, as ``parts``; empty where there is none.

    Cubes meet on each value of one key, ``meet_on``, and pairs are kept where all keys have something in common.  A
    cube of ``right`` goes to a value without its list of that key, so its copies are no longer than its fields.  Parts
    that differ in that key only are one.  A list is as long as the cubes of ``right`` that one cube meets, so ``right`` should be merged.
    """
    others = [k for k in keys if k != meet_on]
    lefts, rights = (side.withColumn(meet_on, F.explode(F.array_distinct(meet_on))) for side in (left, right))
    lefts = lefts.select(*scope, id_column, *keys)
    rights = rights.select(*scope, *keys).withColumnsRenamed({c: f"r_{c}" for c in (*scope, *keys)})
    met = F.col(meet_on).eqNullSafe(F.col(f"r_{meet_on}"))
    for column in scope:
        met = met & (F.col(column) == F.col(f"r_{column}"))
    for key in others:
        met = met & F.arrays_overlap(F.col(key), F.col(f"r_{key}"))
    pairs = lefts.join(copied(rights, USUAL_TOKENS), met)
    common = [F.array_sort(F.array_intersect(F.col(k), F.col(f"r_{k}"))).alias(k) for k in others]
    found = pairs.select(id_column, *common, F.struct(meet_on).alias("_value")).repartition(id_column)
    listed = found.groupBy(id_column, *others).agg(F.array_sort(F.collect_set("_value")).alias("_values"))
    listed = listed.where(F.exists("_values", lambda v: v[meet_on].isNotNull())).withColumn(meet_on, F.col(f"_values.{meet_on}"))
    met = listed.groupBy(id_column).agg(F.collect_list(F.struct(*keys)).alias("parts"))
    parts = F.coalesce("parts", F.array().cast(met.schema["parts"].dataType))
    return left.join(met, id_column, "left").withColumn("parts", parts)


def subtract(
    left: DataFrame, right: DataFrame, keys: Sequence[str], id_column: str, meet_on: str, scope: Sequence[str] = ()
) -> DataFrame:
    """The cubes of ``left``, each replaced by disjoint cubes with what ``right`` does not have.  Other columns pass through."""
    met = parts_in_common(left, right, keys, id_column, meet_on, scope)
    return _opened(met.withColumn("parts", residual(keys, "parts")), left.columns, keys)


def common(
    left: DataFrame, right: DataFrame, keys: Sequence[str], id_column: str, meet_on: str, scope: Sequence[str] = ()
) -> DataFrame:
    """The cubes of ``left``, each replaced by disjoint cubes with what ``right`` has too."""
    met = parts_in_common(left, right, keys, id_column, meet_on, scope)
    return _opened(met.withColumn("parts", disjoint("parts", keys)), left.columns, keys)


def _opened(found: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    rest = [c for c in columns if c not in keys]
    cubes = found.select(*rest, F.explode("parts").alias("_cube"))
    return cubes.select(*[F.col(f"_cube.{c}").alias(c) if c in keys else F.col(c) for c in columns])


def without_repeated_fields(cubes: DataFrame, keys: Sequence[str], by: Sequence[str], most: int = 256) -> DataFrame:
    """Disjoint cubes with the fields of all cubes of a group, numbered by ``place``.

    Equal cubes are put together first, then about ``most`` of them at a time are made
    disjoint, and what that leaves is made disjoint once more.  So a list holds what the parts of a group
    come to, which repeated and overlapping cubes do not lengthen.
    """
    equal = cubes.select(*by, F.expr(box(keys)).alias("_cube")).distinct()
    counted = equal.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    part = F.pmod(F.xxhash64("_cube"), F.ceil(F.col("_n") / most))
    parted = equal.join(counted, list(by)).withColumn("_part", part)
    first = _disjoint_lists(parted, keys, [*by, "_part"]).select(*by, F.explode("_cubes").alias("_cube"))
    opened = _disjoint_lists(first, keys, by).select(*by, F.posexplode("_cubes").alias("place", "_cube"))
    return opened.select(*by, "place", *[F.col(f"_cube.{k}").alias(k) for k in keys])


def _disjoint_lists(cubes: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    listed = cubes.groupBy(*by).agg(F.array_sort(F.collect_set("_cube")).alias("_cubes"))
    return listed.withColumn("_cubes", disjoint("_cubes", keys))


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str], meet_on: str) -> DataFrame:
    """The fields of two sets as disjoint cubes with ``side``: those of both, of the left one only and of the right one only."""
    named = F.struct(*by, "place")
    lefts, rights = (without_repeated_fields(side, keys, by).withColumn("_id", named).drop("place") for side in (left, right))
    sides = {
        "both": common(lefts, rights, keys, "_id", meet_on, by),
        "left": subtract(lefts, rights, keys, "_id", meet_on, by),
        "right": subtract(rights, lefts, keys, "_id", meet_on, by),
    }
    found = [cubes.select(*by, *keys, F.lit(side).alias("side")) for side, cubes in sides.items()]
    return union_all(found)
