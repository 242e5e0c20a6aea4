"""What a form still offers: values that agree with a selection, by votes of the constraints on bitmaps.

The values of each key of a dataset stand in one dictionary, where a value's place is its bit.  A constraint
is a bitmap of 64-bit words for each key it has, and so is a selection.  Whether two agree is a bitwise AND, the
values that a constraint opens are brought together by a bitwise OR, and only the result is looked up in the
dictionary.  A selection meets its dataset's constraints as lists of a few hundred, so no row is made for a pair or a value.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.dates import range_struct
from skyloom.operators.constraints import MOST_RULES, RULES, ranges_meet
from skyloom.operators.scale import salted_join

SELECTION = "_selection"
VALUES = "array<struct<key: string, value: string>>"


def possible_values(
    selections: DataFrame,
    constraints: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
) -> DataFrame:
    """Values still open, homogeneous rule: a constraint counts when it has every selected key with a common value."""

    def solve(asked: DataFrame) -> DataFrame:
        return _voted(asked, constraints, keys, scope, (), absent_agrees=False, own_key_decides=True)

    return _once_per_selection(selections, [*scope, *keys], id_column, solve)


def form_state(
    selections: DataFrame,
    constraints: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
) -> DataFrame:
    """Open values per key, homogeneous rule, with that key left out of the selection."""

    def solve(asked: DataFrame) -> DataFrame:
        return _voted(asked, constraints, keys, scope, (), absent_agrees=False)

    return _once_per_selection(selections, [*scope, *keys], id_column, solve)


def form_state_mixed(
    selections: DataFrame,
    constraints: DataFrame,
    keys: Sequence[str],
    form: DataFrame,
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
    ranges: Sequence[str] = (),
    on_map: Sequence[str] = ("location_x", "location_y"),
) -> DataFrame:
    """Open values per key, mixed rule.

    A key does not decide for itself.  Its values are open where every other
    selected key has a common value or is not in the constraint.  The only
    selected key gets its whole range, and so does every key when nothing is
    selected.  Coordinates picked on the map decide nothing; a selection of
    only them opens nothing.
    """

    def solve(asked: DataFrame) -> DataFrame:
        nothing = _nothing_selected(keys, ranges, [k for k in on_map if k in asked.columns])
        deciding = asked.where((_selected(keys) > 0) & ~nothing)
        opened = _voted(deciding, constraints, keys, scope, ranges, absent_agrees=True, others_needed=True)
        whole = {k: nothing | ((_selected(keys) == 1) & F.col(k).isNotNull()) for k in keys}
        return opened.unionByName(_whole_ranges(asked, form, whole, scope))

    columns = [*scope, *keys, *[k for k in on_map if k in selections.columns]]
    return _once_per_selection(selections, columns, id_column, solve)


def unknown_keys(
    selections: DataFrame,
    constraints: DataFrame,
    form: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
) -> DataFrame:
    """Rejects: selected keys that neither the dataset's form nor any of its constraints has, with the message for the user.

    Datasets without any form have no rejects.
    """
    named = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in keys if k in constraints.columns]))
    known = form.select(*scope, "key").unionByName(constraints.select(*scope, F.explode(named).alias("key")))
    listed = known.groupBy(*scope).agg(F.collect_set("key").alias("_known"))
    asked = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in keys]))
    met = salted_join(selections.select(*scope, id_column, asked.alias("_asked")), listed, scope, [id_column])
    found = met.select(id_column, F.explode(F.array_except("_asked", "_known")).alias("key"))
    # fixed wording, which users of the service may rely on
    return found.withColumn("message", F.concat(F.lit("invalid param '"), F.col("key"), F.lit("'")))


def _once_per_selection(
    selections: DataFrame, columns: Sequence[str], id_column: str, solve: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Solve each distinct selection once and give its values to every request that makes it.

    Requests repeat each other, so this is done before any constraint is met.
    The values of a selection travel as one row, which the form bounds.  A
    selection that most requests make is a skewed join key, which adaptive
    execution splits.
    """
    named = selections.select(id_column, *columns).withColumn(SELECTION, F.sha2(F.to_json(F.struct(*columns)), 256))
    solved = solve(named.select(SELECTION, *columns).dropDuplicates([SELECTION]))
    listed = solved.groupBy(SELECTION).agg(F.array_distinct(F.flatten(F.collect_list("_values"))).alias("_values"))
    joined = named.select(id_column, SELECTION).join(listed, SELECTION)
    return joined.select(id_column, F.explode("_values").alias("_v")).select(id_column, "_v.key", "_v.value")


def _selected(keys: Sequence[str]) -> Column:
    count = F.lit(0)
    for key in keys:
        count = count + F.col(key).isNotNull().cast("int")
    return count


def _nothing_selected(keys: Sequence[str], ranges: Sequence[str], on_map: Sequence[str]) -> Column:
    nothing = _selected([*keys, *on_map]) == 0
    if ranges:  # date ranges that are shown but left empty count as no selection at all
        blank = F.lit(True)
        for key in ranges:
            blank = blank & F.coalesce(F.col(key) == F.array(F.lit("")), F.lit(False))
        nothing = nothing | blank
    return nothing


def _whole_ranges(asked: DataFrame, form: DataFrame, wanted: dict[str, Column], scope: Sequence[str]) -> DataFrame:
    """All values that the form has for the wanted keys of each selection."""
    value = F.struct(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    listed = form.groupBy(*scope, "key").agg(F.collect_set(value).alias("_values"))
    keys = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in wanted.items()]))
    rows = asked.select(*scope, SELECTION, F.explode(keys).alias("key"))
    return salted_join(rows, listed, [*scope, "key"], [SELECTION]).select(SELECTION, "_values")


def _place(key: str) -> str:
    return f"_all_{key}"


def dictionary(constraints: DataFrame, keys: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """The values of each key over all constraints of a dataset, sorted; made distinct before they are listed."""
    entries = [F.transform(F.col(k).cast("array<string>"), _entry(k)) for k in keys]
    named = constraints.select(*scope, F.explode(F.flatten(F.array_compact(F.array(*entries)))).alias("_e"))
    values = named.select(*scope, "_e.key", "_e.value").distinct()
    lists = [F.array_sort(F.collect_set(F.when(F.col("key") == k, F.col("value")))).alias(_place(k)) for k in keys]
    return values.groupBy(*scope).agg(*lists)


def _entry(key: str) -> Callable[[Column], Column]:
    return lambda v: F.struct(F.lit(key).alias("key"), v.alias("value"))


def _listed(values: Column) -> Callable[[Column], Column]:
    return lambda v: F.coalesce(F.array_contains(values, v), F.lit(False))


def _meets(spans: Column) -> Callable[[Column], Column]:
    return lambda v: F.exists(spans, lambda a: ranges_meet(a, range_struct(v)))


def _with_bits(rows: DataFrame, keys: Sequence[str], ranges: Sequence[str], name: str) -> DataFrame:
    """Add ``name`` and key for each key: its values as bits of the dictionary, NULL where the key is absent.

    A range has the bits of all ranges that it meets.
    """
    flags = {}
    for key in keys:
        meets = _meets(F.transform(F.col(key), range_struct)) if key in ranges else _listed(F.col(key))
        flags[f"_flags_{key}"] = F.when(F.col(key).isNotNull(), F.transform(_place(key), meets))
    rows = rows.withColumns(flags)
    words = {}
    for key in keys:
        f = f"`_flags_{key}`"
        bits = f"transform(slice({f}, int(w) * 64 + 1, 64), (b, i) -> IF(b, shiftleft(1L, i), 0L))"
        word = f"aggregate({bits}, 0L, (x, y) -> x | y)"
        words[name + key] = F.expr(
            f"CASE WHEN {f} IS NULL THEN NULL WHEN size({f}) = 0 THEN array(0L) ELSE transform(sequence(0, (size({f}) - 1) div 64), w -> {word}) END"
        )
    return rows.withColumns(words).drop(*flags)


def coded(constraints: DataFrame, keys: Sequence[str], scope: Sequence[str], ranges: Sequence[str] = (), most: int = MOST_RULES) -> DataFrame:
    """Constraints of a dataset as lists of about ``most`` structs of bitmaps, each list with the dataset's dictionary."""
    distinct = constraints.select(*scope, *keys).distinct()
    counted = distinct.groupBy(*scope).agg(F.count(F.lit(1)).alias("_n"))
    known = dictionary(distinct, keys, scope).join(counted, list(scope))
    part = F.pmod(F.xxhash64(*keys), F.ceil(F.col("_n") / most))
    rows = distinct.join(known, list(scope)).withColumn("_part", part)
    rule = F.struct(*[F.col(f"_bits_{k}").alias(k) for k in keys])
    places = [F.first(_place(k)).alias(_place(k)) for k in keys]
    listed = _with_bits(rows, keys, (), "_bits_").groupBy(*scope, "_part")
    return listed.agg(F.collect_list(rule).alias(RULES), *places).drop("_part")


def _voted(
    selections: DataFrame,
    constraints: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str],
    ranges: Sequence[str],
    absent_agrees: bool,
    own_key_decides: bool = False,
    others_needed: bool = False,
) -> DataFrame:
    """(selection, values) that constraints open which agree with every selected key, or every one but the key they open.

    A constraint agrees in a key that is not selected, or has a value in common, or
    with ``absent_agrees`` where it does not have the key.  With ``others_needed`` a key
    opens only where another one is selected.
    """
    rows = salted_join(selections.select(SELECTION, *scope, *keys), coded(constraints, keys, scope), scope, [SELECTION])
    rows = _with_bits(rows, keys, ranges, "_asked_")
    against = ", ".join(
        f"`_asked_{k}` IS NOT NULL AND CASE WHEN c.`{k}` IS NULL THEN {str(not absent_agrees).lower()} "
        f"ELSE NOT exists(zip_with(`_asked_{k}`, c.`{k}`, (x, y) -> x & y), z -> z <> 0) END AS `not_{k}`"
        for k in keys
    )
    own = ", ".join(f"c.`{k}` AS `{k}`" for k in keys)
    rows = rows.withColumn("_judged", F.expr(f"transform({RULES}, c -> struct({own}, {against}))"))
    words = {}
    for key in keys:
        deciding = keys if own_key_decides else [k for k in keys if k != key]
        agrees = " AND ".join([f"r.`{key}` IS NOT NULL", *[f"NOT r.`not_{k}`" for k in deciding]])
        none = f"array_repeat(0L, int(greatest(1, ceil(size(`{_place(key)}`) / 64))))"
        voted = f"aggregate(filter(_judged, r -> {agrees}), {none}, (a, r) -> zip_with(a, r.`{key}`, (x, y) -> x | y))"
        there = " OR ".join(f"`{k}` IS NOT NULL" for k in keys if k != key) or "false"
        words[f"_open_{key}"] = F.expr(f"CASE WHEN {there} THEN {voted} END" if others_needed else voted)
    rows = rows.withColumns(words)
    lists = []
    for key in keys:
        bit = f"(get(`_open_{key}`, int(i div 64)) & shiftleft(1L, i % 64)) <> 0"
        lists.append(f"coalesce(transform(filter(`{_place(key)}`, (v, i) -> {bit}), v -> struct('{key}' AS key, v AS value)), array())")
    return rows.select(SELECTION, F.expr(f"flatten(array({', '.join(lists)}))").cast(VALUES).alias("_values"))
