"""Planning calls on tables of requests: what stays selectable, what it costs, which tags and whether it is valid.

Nothing here reads data of a dataset; each call is a bulk report over requests.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.errors import ConfigurationError
from skyloom.operators import catalogue, constraints, costs, forms
from skyloom.operators.scale import salted_join


def apply_constraints(
    selections: DataFrame,
    rules: DataFrame,
    form: DataFrame,
    keys: Sequence[str],
    method: str = "mixed",
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
    ranges: Sequence[str] = (),
) -> DataFrame:
    """(id, key, value) of everything that can still be selected.

    Form keys without any constraint in their dataset keep all their values,
    and what is selected of them does not count.
    """
    constrained = constraints.constrained_keys(rules, keys, scope)
    per_dataset = constrained.groupBy(*scope).agg(F.collect_set("key").alias("_constrained"))
    selections = salted_join(selections, per_dataset, scope, [id_column], "left")
    counts = {k: F.when(F.array_contains("_constrained", k), F.col(k)) for k in keys}
    selections = selections.withColumns(counts).drop("_constrained")
    own_form = form.join(constrained, [*scope, "key"], "left_semi")
    if method == "mixed":
        state = forms.form_state_mixed(selections, rules, keys, own_form, scope, id_column, ranges)
    elif method == "homogeneous":
        state = forms.form_state(selections, rules, keys, scope, id_column)
    else:
        raise ConfigurationError(f"{method} is not a recognised way to apply constraints")
    free = constraints.unconstrained_values(form, constrained, scope)
    asked = selections.select(*scope, id_column)
    always = salted_join(asked, free, scope, [id_column])
    return state.unionByName(always.select(id_column, "key", "value"))


@dataclass(frozen=True)
class Costing:
    """How a dataset prices requests."""

    weighted_values: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    weighted_keys: Mapping[str, int] = field(default_factory=dict)
    limits: Mapping[str, float] = field(default_factory=dict)
    bounds: Sequence[float] | Mapping[str, float] = ()
    last_class: str | None = None
    based_on: str = "size"  # a cost name, or highest_cost_limit_ratio
    resolution: tuple[float, float] = (0.25, 0.25)
    weight_by_area: bool = True


def estimate_costs(
    requests: DataFrame,
    rules: DataFrame,
    form: DataFrame,
    keys: Sequence[str],
    costing: Costing,
    counted: Sequence[str] = (),
    scope: Sequence[str] = ("dataset",),
    id_column: str = "request_id",
) -> DataFrame:
    """Size, precise size, the deciding cost and the cost class of every request.

    ``keys`` are the constrained keys, ``counted`` the others that make fields;
    those of them that the form has count in the precise size too.
    A request with north, west, south and east is weighted by its grid points.
    """
    boxed = {"north", "west", "south", "east"} <= set(requests.columns)
    edges = [F.col(e) if boxed else F.lit(None).cast("double") for e in ("north", "west", "south", "east")]
    weight = costs.grid_area_weight(*edges, *costing.resolution) if costing.weight_by_area else F.lit(1)
    fast = costs.estimate_fields([*keys, *counted], costing.weighted_values, costing.weighted_keys)
    sizes = requests.select(id_column, weight.alias("_weight"), fast.alias("_fields"))
    form_keys = [*keys, *counted]
    bare = requests.select(*scope, id_column, *[F.col(k).cast("array<string>").alias(k) for k in form_keys])
    precise = costs.precise_size(
        bare, rules, form, form_keys, 1, scope, id_column, costing.weighted_values, costing.weighted_keys
    )
    report = sizes.join(precise, id_column).select(
        id_column,
        (F.col("_fields") * F.col("_weight")).alias("size"),
        (F.col("precise_size") * F.col("_weight")).alias("precise_size"),
    )
    kinds = {"size": F.col("size"), "precise_size": F.col("precise_size")}
    if costing.based_on == "highest_cost_limit_ratio":
        deciding = costs.highest_ratio(kinds, costing.limits)
    else:
        deciding = F.lit(costing.based_on)
    report = report.withColumn("deciding_cost", deciding)
    basis = F.when(F.col("deciding_cost") == "precise_size", F.col("precise_size")).otherwise(F.col("size"))
    return report.withColumn("cost_class", costs.cost_class(basis, costing.bounds, costing.last_class))


def request_tags(
    requests: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    conditions: Mapping[str, Sequence[Mapping[str, Sequence]]],
    unfolded: Sequence[str] = (),
    id_column: str = "request_id",
) -> DataFrame:
    """Tags of requests after they are cut to the constraints."""
    cut = constraints.intersect(requests, rules, keys)
    for key in [*keys, *unfolded]:
        cut = cut.withColumn(key, F.explode_outer(key))
    return catalogue.conditional_tags(cut, conditions, [id_column])


def check_validity(areas: DataFrame, features: DataFrame) -> DataFrame:
    """Every request box and whether any feature lies in it."""
    found = catalogue.overlapping_features(areas, features, columns=["request_id"], counted="n")
    hits = found.select("request_id").distinct()
    return areas.select("request_id").join(hits.withColumn("valid", F.lit(True)), "request_id", "left").na.fill(
        False, ["valid"]
    )
