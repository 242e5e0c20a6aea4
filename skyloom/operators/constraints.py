"""Requests and forms against the allowed combinations of a dataset.

A constraint is a row with one array per key; NULL means the constraint says
nothing about the key.  Requests meet only the constraints of their own
dataset, and of those only the ones with a value in common on a chosen key, so
no join lists all pairs.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.dates import range_struct
from skyloom.operators.meetings import overlapping
from skyloom.operators.scale import ABSENT, matching_pairs, range_nodes, salted_join, union_all


def _con(key: str) -> str:
    return f"c_{key}"


def _named(constraints: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Constraint keys under names of their own."""
    return constraints.withColumnsRenamed({k: _con(k) for k in keys})


def _overlaps(key: str, ranges: Sequence[str]) -> Column:
    if key in ranges:
        met = F.exists(key, lambda a: F.exists(_con(key), lambda b: ranges_meet(range_struct(a), range_struct(b))))
        return F.coalesce(met, F.lit(False))
    return F.coalesce(F.arrays_overlap(F.col(key), F.col(_con(key))), F.lit(False))


def ranges_meet(a: Column, b: Column) -> Column:
    return F.coalesce((a["start"] <= b["end"]) & (b["start"] <= a["end"]), F.lit(False))


def _range_overlaps(asked: Column, allowed: Column) -> Column:
    """Overlap of every asked with every allowed range, as ``a/b`` text in the order asked."""

    def one(a: Column) -> Column:
        met = F.filter(allowed, lambda b: ranges_meet(range_struct(a), range_struct(b)))
        return F.transform(
            met,
            lambda b: F.concat_ws(
                "/",
                F.greatest(range_struct(a)["start"], range_struct(b)["start"]).cast("string"),
                F.least(range_struct(a)["end"], range_struct(b)["end"]).cast("string"),
            ),
        )

    return F.flatten(F.transform(asked, one))


def _range_tokens(texts: Column, asks: bool) -> Column:
    """Join tokens of date ranges as text, which ranges that overlap have in common."""

    def of(text: Column) -> Column:
        span = range_struct(text)
        nodes = F.transform(range_nodes(span["start"], span["end"], asks), lambda n: n.cast("string"))
        return F.coalesce(nodes, F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.transform(texts, of)))


def _tokens(columns: dict[str, Column], ranges: Sequence[str], absent_matches: bool, first: int | None) -> Column:
    """Join tokens ``key=value``: of all keys, or of the ``first`` so many keys that have values.

    Where an absent key matches too, it stands as a token of its own, which the
    other side carries next to its values.  Date ranges meet in blocks of days;
    the side with ``first`` is the one that asks.
    """
    per_key = []
    for key, values in columns.items():
        values = _range_tokens(values, bool(first)) if key in ranges else values
        absent = F.array(F.lit(f"{key}={ABSENT}"))
        named = F.transform(values, lambda v: F.concat(F.lit(f"{key}="), v))
        if first:
            per_key.append(F.concat(named, absent) if absent_matches else named)
        else:
            missing = absent if absent_matches else F.array().cast("array<string>")
            per_key.append(F.coalesce(named, missing))
    return F.flatten(F.slice(F.array_compact(F.array(*per_key)), 1, first)) if first else F.concat(*per_key)


def _pairs(
    requests: DataFrame,
    constraints: DataFrame,
    keys: Sequence[str],
    deciding: Sequence[str],
    scope: Sequence[str],
    absent_matches: bool,
    id_column: str,
    ranges: Sequence[str],
) -> DataFrame:
    """Pairs that agree on every deciding key the request has.

    A request meets constraints through the values of its first selected key
    only; the remaining keys are tested on the pair.
    """
    keep = F.lit(True)
    for key in deciding:
        absent = F.col(_con(key)).isNull() if absent_matches else F.lit(False)
        keep = keep & (F.col(key).isNull() | absent | _overlaps(key, ranges))
    return matching_pairs(
        requests,
        _named(constraints, keys),
        scope,
        _tokens({k: F.col(k) for k in deciding}, ranges, absent_matches, 1),
        _tokens({k: F.col(_con(k)) for k in deciding}, ranges, absent_matches, None),
        keep,
        spread_by=[id_column],  # a dataset may have a large part of all requests
    )


def intersect(
    requests: DataFrame,
    constraints: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
    ranges: Sequence[str] = (),
) -> DataFrame:
    """Each request cut down to what each constraint allows.

    Every key of the constraint must have a value in common with the request;
    a key the constraint lacks is dropped from the result.  Other columns pass
    through.  The values keep the order of the request.  ``ranges`` names keys
    that hold date ranges, which are cut to their overlap.
    """
    pairs = _pairs(requests, constraints, keys, keys, scope, True, id_column, ranges)
    for key in keys:  # a key the request lacks fails every constraint that has it
        pairs = pairs.where(F.col(_con(key)).isNull() | F.col(key).isNotNull())
    cut = {}
    for key in keys:
        cutter = _range_overlaps if key in ranges else F.array_intersect
        cut[key] = F.when(F.col(_con(key)).isNotNull(), cutter(F.col(key), F.col(_con(key))))
    return pairs.withColumns(cut).drop(*[_con(k) for k in keys])


def of_unconstrained_datasets(
    requests: DataFrame, constraints: DataFrame, scope: Sequence[str] = ("dataset",)
) -> DataFrame:
    """Requests of datasets that have no constraint at all: everything they ask for is valid."""
    return requests.join(constraints.select(*scope).distinct(), list(scope), "left_anti")


def intersect_or_pass(
    requests: DataFrame,
    constraints: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
    ranges: Sequence[str] = (),
) -> DataFrame:
    """:func:`intersect`, with the requests of datasets without constraints as they are.

    Other columns of the constraints are NULL there.
    """
    cut = intersect(requests, constraints, keys, scope, id_column, ranges)
    return cut.unionByName(of_unconstrained_datasets(requests, constraints, scope), allowMissingColumns=True)


def without_valid_combination(requests: DataFrame, intersected: DataFrame, id_column: str = "request_id") -> DataFrame:
    """Requests that no constraint allows any part of."""
    return requests.join(intersected.select(id_column).distinct(), id_column, "left_anti")


def intersect_date_ranges(requests: DataFrame, constraints: DataFrame, scope: Sequence[str] = ("dataset",)) -> DataFrame:
    """Overlap of requested and allowed date ranges, both ends included.

    ``requests`` has start and end, ``constraints`` has d_start and d_end.
    """
    return overlapping(requests, constraints, scope, ("start", "end"), ("d_start", "d_end"))


RULES = "_rules"
MOST_RULES = 256


def has(key: str) -> str:
    return f"_has_{key}"


def packed(
    constraints: DataFrame, keys: Sequence[str], scope: Sequence[str] = ("dataset",), most: int = MOST_RULES
) -> DataFrame:
    """The distinct constraints of each dataset as lists of about ``most`` structs, and which keys any of them has.

    A dataset with many constraints has many rows, so no list grows with them.
    """
    distinct = constraints.select(*scope, *keys).distinct()
    counted = distinct.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("_n"), *[F.bool_or(F.col(k).isNotNull()).alias(has(k)) for k in keys]
    )
    part = F.pmod(F.xxhash64(*keys), F.ceil(F.col("_n") / most)).alias("_part")
    placed = distinct.join(counted, list(scope)).withColumn("_part", part)
    listed = placed.groupBy(*scope, *[has(k) for k in keys], "_part").agg(F.collect_list(F.struct(*keys)).alias(RULES))
    return listed.drop("_part")


def unconstrained_values(allowed: DataFrame, constraint_keys: DataFrame, scope: Sequence[str] = ("dataset",)) -> DataFrame:
    """Form values of keys that no constraint of the dataset mentions: they stay valid."""
    return allowed.join(constraint_keys, [*scope, "key"], "left_anti")


def constrained_keys(constraints: DataFrame, keys: Sequence[str], scope: Sequence[str] = ("dataset",)) -> DataFrame:
    """Keys that some constraint of a dataset mentions."""
    used = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in keys]))
    return constraints.select(*scope, F.explode(used).alias("key")).distinct()


def form_of_constraints(constraints: DataFrame, keys: Sequence[str], scope: Sequence[str] = ("dataset",)) -> DataFrame:
    """All values a dataset's constraints allow, as (scope, key, value)."""
    return union_all(
        [constraints.select(*scope, F.lit(k).alias("key"), F.explode(k).alias("value")) for k in keys]
    ).distinct()
