"""From raw requests to the backend requests of one dataset, for a whole table at once.

Rules, constraints, mapping, embargo and result reuse in that order; every
request ends either in ``prepared`` or in ``rejects``.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators import constraints, requests as translate
from skyloom.operators.rules import Rule, enforce
from skyloom.operators.scale import union_all
from skyloom.tables import REJECTS, conform


@dataclass(frozen=True)
class Preparation:
    """Configuration of one dataset: at least one of rules, constraints and embargo."""

    rules: Sequence[Rule] = ()
    constrained: Sequence[str] = ()
    ranges: Sequence[str] = ()
    mapping: Mapping = field(default_factory=dict)
    embargo: Mapping[str, int] | None = None
    avoid_cache: bool = False


@dataclass(frozen=True)
class Prepared:
    requests: DataFrame
    rejects: DataFrame


def reject(requests: DataFrame, rule: str, group: str, message: str) -> DataFrame:
    return requests.select(
        "request_id",
        F.lit(rule).alias("rule_id"),
        F.lit(group).alias("reason_group"),
        F.lit(0).alias("place"),
        F.lit(message).alias("message"),
    )


def prepare(
    raw: DataFrame,
    rules: DataFrame | None,
    config: Preparation,
    as_of: Column,
    date: str = "date",
    time: str = "time",
) -> Prepared:
    """Backend requests with their fingerprint, and what was turned down and why."""
    good, rejects = enforce(raw, config.rules) if config.rules else (raw, None)
    turned_down = [] if rejects is None else [rejects]
    if rules is not None and config.constrained:
        cut = constraints.intersect_or_pass(good, rules, config.constrained, ranges=config.ranges)
        nothing = constraints.without_valid_combination(good, cut)
        turned_down.append(
            reject(nothing, "constraints", "invalid request", "Request has not produced a valid combination of values")
        )
        good = cut
    mapped = translate.apply_mapping(good, config.mapping)
    if "mapping_problem" in mapped.columns:
        wrong = mapped.where("mapping_problem IS NOT NULL").select("request_id", "mapping_problem")
        turned_down.append(reject(wrong, "mapping", "invalid request", "The dates of the request are not valid"))
        mapped = mapped.where("mapping_problem IS NULL").drop("mapping_problem")
    if config.embargo is not None:
        limits = {k: v for k, v in config.embargo.items() if k in ("days", "hours", "months")}
        unread = translate.unreadable_times(mapped, as_of, date=date, time=time, **limits).select("request_id").distinct()
        turned_down.append(reject(unread, "embargo", "invalid request", "A time of the request cannot be read"))
        mapped = mapped.join(unread, "request_id", "left_anti")
        open_ = translate.embargo(mapped, as_of, date=date, time=time, **config.embargo)
        released = open_.select("request_id").distinct()
        held = mapped.select("request_id").distinct().join(released, "request_id", "left_anti")
        turned_down.append(
            reject(held, "embargo", "invalid request", "None of the data you have requested is available yet")
        )
        mapped = open_
    else:
        mapped = mapped.withColumn("cacheable", F.lit(True))
    keys = sorted(c for c, t in mapped.dtypes if t.startswith("array"))
    as_map = F.map_from_arrays(
        F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k).cast("array<string>") for k in keys])
    )
    reusable = F.col("cacheable") & F.lit(not config.avoid_cache)
    mapped = mapped.withColumn("fingerprint", translate.fingerprint(as_map, ~reusable))
    return Prepared(mapped, conform(union_all(turned_down), REJECTS))
