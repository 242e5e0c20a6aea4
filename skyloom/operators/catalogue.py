"""Matching requests with catalogues: boxes, features, stored fields, facets, tags and receipts."""

import re
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.dates import relative_range
from skyloom.functions.space import cell_of_point, cells_of_box, home_of_box, homes_of_point
from skyloom.operators.cubes import compare
from skyloom.operators.meetings import Columns, listed, meetings
from skyloom.operators.scale import group_ordinals, salted_join

EDGES = ("north", "west", "south", "east")
MOST_AT_HOME = 1 << 17  # points of one list that boxes are compared with
FIELDS_PER_CALL = 50  # fixed value: most fields of one backend call


def points_strictly_inside(
    areas: DataFrame, points: DataFrame, cell: float = 10.0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Pairs of a request box and a configured point strictly inside it, with all columns or those named.

    Points with malformed coordinates are dropped.  Boxes are laid over coarse
    cells, and points and boxes of a cell are compared in blocks; ``cell`` in degrees
    should be about the size of a box.
    """
    located = _located(points).withColumn("_cell", cell_of_point(F.col("latitude"), F.col("longitude"), cell))
    boxes = areas.where("north > south AND east > west").withColumn(
        "_cell", F.explode(cells_of_box(*[F.col(e) for e in EDGES], cell))
    )

    return meetings(boxes, located, ["_cell"], _inside, columns or _but_cell(boxes, located))


def _located(points: DataFrame) -> DataFrame:
    """Points with coordinates as numbers; malformed ones are dropped."""
    numbers = {c: F.col(c).try_cast("double") for c in ("latitude", "longitude")}
    return points.withColumns(numbers).where("latitude IS NOT NULL AND longitude IS NOT NULL")


def _inside(box: Columns, point: Columns) -> np.ndarray:
    met = point["latitude"] < box["north"]
    met &= point["longitude"] > box["west"]
    met &= point["latitude"] > box["south"]
    met &= point["longitude"] < box["east"]
    return met


def _but_cell(*sides: DataFrame) -> list[str]:
    return [c for side in sides for c in side.columns if not c.startswith("_")]


def map_areas_to_values(areas: DataFrame, points: DataFrame, value: str, order: str, most: int = MOST_AT_HOME) -> DataFrame:
    """Values of the points inside each request box, in the order of the configuration.

    A box has one home, the two by two cells of the smallest size that hold it, and a point goes to all homes it
    lies in.  So the list of a box is made in one place, and only boxes and points are shuffled, not their pairs.  Where a
    home has more than ``most`` points, or a request several boxes, pairs are put together to lists.
    """
    located = _located(points).select(*dict.fromkeys([order, value, "latitude", "longitude"]))
    several = F.count(F.lit(1)).over(Window.partitionBy("request_id")) > 1
    boxes = areas.where("north > south AND east > west").select("request_id", *EDGES)
    boxes = boxes.withColumns({"_several": several, "_home": home_of_box(*[F.col(e) for e in EDGES])})
    asked = boxes.select("_home").distinct()
    homes = F.explode(homes_of_point(F.col("latitude"), F.col("longitude")))
    placed = located.withColumn("_home", homes).join(asked, "_home", "left_semi")
    held = placed.groupBy("_home").agg((F.count(F.lit(1)) > most).alias("_crowded"))
    sorted_out = boxes.join(held, "_home")  # a box whose home has no points has no list
    apart = F.col("_several") | F.col("_crowded")
    at_home = sorted_out.where(~apart).select("request_id", *EDGES, "_home")
    few = placed.join(held.where("NOT _crowded"), "_home", "left_semi")
    lists = listed(at_home, few, ["_home"], _inside, "request_id", value, "values", most)
    pairs = points_strictly_inside(sorted_out.where(apart).select("request_id", *EDGES), located, columns=["request_id", order, value])
    put = pairs.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("_l"))
    return lists.unionByName(put.select("request_id", F.col(f"_l.{value}").alias("values")))


def append_values(requests: DataFrame, mapped: DataFrame, key: str) -> DataFrame:
    """Put the values found for a request after those it already has under a key."""
    joined = requests.join(mapped.select("request_id", F.col("values").alias("_found")), "request_id", "left")
    nothing = F.array().cast("array<string>")
    both = F.concat(F.coalesce(F.col(key), nothing), F.col("_found")) if key in requests.columns else F.col("_found")
    known = F.col(key) if key in requests.columns else F.lit(None).cast("array<string>")
    return joined.withColumn(key, F.when(F.col("_found").isNotNull(), both).otherwise(known)).drop("_found")


def overlapping_features(
    areas: DataFrame,
    features: DataFrame,
    cell: float = 10.0,
    columns: Sequence[str] | None = None,
    at_most: tuple[str, int] | None = None,
    counted: str | None = None,
) -> DataFrame:
    """Pairs of a request box and a feature whose bounding box meets it, with all columns or those named.

    Both boxes are laid over coarse cells, whose boxes are compared in blocks; a pair is kept in the cell of the
    corner where the overlap begins, so it appears once.  ``at_most`` and ``counted`` are those of
    :func:`skyloom.operators.meetings.meetings`, for what needs only some pairs of a request or their number.
    """
    boxes = areas.withColumn("_cell", F.explode(cells_of_box(*[F.col(e) for e in EDGES], cell)))
    boxes = boxes.withColumns({"_y": F.col("_cell.cy"), "_x": F.col("_cell.cx")})
    renamed = features.withColumnsRenamed({e: f"f_{e}" for e in EDGES})
    placed = renamed.withColumn("_cell", F.explode(cells_of_box(*[F.col(f"f_{e}") for e in EDGES], cell)))

    def meets(box: Columns, feature: Columns) -> np.ndarray:
        met = feature["f_south"] <= box["north"]
        met &= feature["f_north"] >= box["south"]
        met &= feature["f_west"] <= box["east"]
        met &= feature["f_east"] >= box["west"]
        for edge, at in (("south", "_y"), ("west", "_x")):  # the larger of both edges lies in this cell
            a, b = np.floor(box[edge] / cell), np.floor(feature[f"f_{edge}"] / cell)
            here = box[at][:1]
            met &= ((a == here) & (b <= here)) | ((a <= here) & (b == here))
        return met

    return meetings(boxes, placed, ["_cell"], meets, columns or _but_cell(boxes, placed), at_most, counted)


def first_features(pairs: DataFrame, by: Sequence[str], order: str, n: int) -> DataFrame:
    """At most ``n`` features per request, in a fixed order.

    Spark turns the limit on a row number into a limit per group before the
    shuffle, so a request that meets many features sends ``n`` rows per task.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return pairs.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def delivered_or_missing(wanted: DataFrame, delivered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every field once, with ``state`` delivered, missing or unexpected.

    Delivered and missing add up to what was wanted; a field that was not asked
    for is unexpected.
    """
    side = F.col("side")
    state = F.when(side == "right", "unexpected").when(side == "both", "delivered").otherwise("missing")
    sides = compare(wanted, delivered, keys)
    return sides.select(*keys, state.alias("state"), F.when(side == "left", "archived").alias("backend"))


def split_by_store(fields: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fields with the store that has them: the fast one or the archive."""
    known = stored.select(*keys).distinct().withColumn("_fast", F.lit(True))
    joined = fields.join(known, list(keys), "left")
    return joined.withColumn("backend", F.when(F.col("_fast"), "latest").otherwise("archived")).drop("_fast")


def backend_calls(
    fields: DataFrame, by: Sequence[str], order: Sequence[str], size: int = FIELDS_PER_CALL
) -> DataFrame:
    """Fields of a group numbered into calls of at most ``size``."""
    placed = group_ordinals(fields, by, order, "_place")
    return placed.withColumn("call", F.floor(F.col("_place") / size).cast("bigint")).drop("_place")


def conditional_tags(
    fields: DataFrame,
    conditions: Mapping[str, Sequence[Mapping[str, Sequence]]],
    by: Sequence[str],
    as_of: Column | None = None,
) -> DataFrame:
    """Tags that apply to a request: every field of it lies in some condition cube of the tag.

    Keys a condition lacks are ignored; a condition on a key the fields lack
    holds nowhere.  A text such as ``current-30/current`` is a range of dates
    as seen from ``as_of``, the current moment if not given.  Conditions are configuration, so
    they are tested as expressions and the fields are read once for all tags.
    """
    moment = F.current_timestamp() if as_of is None else as_of
    hits = {}
    for tag, cubes in conditions.items():
        hit = F.lit(False)
        for cube in cubes:
            inside = F.lit(True)
            for key, values in cube.items():
                inside = inside & (_in_condition(F.col(key), values, moment) if key in fields.columns else F.lit(False))
            hit = hit | inside
        hits[tag] = hit
    judged = fields.groupBy(*by).agg(*[F.bool_and(hit).alias(tag) for tag, hit in hits.items()])
    tags = F.array_compact(F.array(*[F.when(F.col(f"`{t}`"), F.lit(t)) for t in hits]))
    return judged.select(*by, F.explode(tags).alias("tag"))


def _in_condition(column: Column, values: Sequence, as_of: Column) -> Column:
    hit = F.lit(False)
    for value in values:
        if isinstance(value, str) and re.match(r" *current|.*/ *current", value):
            low, high = relative_range(value, as_of)
            hit = hit | column.cast("date").between(low, high)
        elif isinstance(value, tuple):
            low, high = value
            hit = hit | column.between(low, high)
        else:
            hit = hit | (column == value)
    return F.coalesce(hit, F.lit(False))


# --- facets --------------------------------------------------------------------


def facet_id(dashed: Sequence[Column], dotted: Sequence[Column]) -> Column:
    """Dash-joined parts, then everything dot-joined; absent parts are left out."""
    joined = F.nullif(F.concat_ws("-", *dashed), F.lit(""))
    return F.concat_ws(".", *dotted, joined)


def facet_candidates(
    requests: DataFrame,
    candidates: DataFrame,
    keys: Sequence[str],
    groups: Mapping[str, Mapping[str, Sequence[str]]],
    searches: Mapping[str, str] | None = None,
    summary: Sequence[Column] = (),
) -> DataFrame:
    """Candidates whose values, seen through their groups, hold every value a request names.

    A request may leave any key open.  Requests that ask for the same are looked
    up once.  ``searches`` gives patterns such as ``^{period}$`` that a facet
    must match once the request's value is put in.  With ``summary``, aggregates over
    candidates, a request comes once with those of its candidates; they are worked out once for all
    requests that ask for the same.
    """
    searches = searches or {}
    candidates = candidates.withColumnsRenamed({k: f"c_{k}" for k in searches})
    for key, named in groups.items():
        grouped = F.col(key)
        for group, members in named.items():
            grouped = F.when(F.col(key).isin(list(members)), group).otherwise(grouped)
        candidates = candidates.withColumn(key, grouped)
    asked = [*keys, *searches]
    requests = requests.withColumn("_asked", F.to_json(F.struct(*asked)))
    met = facet_meetings(requests.select("_asked", *asked).distinct(), candidates, keys)
    for key, template in searches.items():
        before, _, after = template.partition("{" + key + "}")
        pattern = F.concat(F.lit(before), F.col(key), F.lit(after))
        met = met.where(F.col(key).isNull() | F.rlike(F.col(f"c_{key}"), pattern))
    if summary:
        return requests.join(met.groupBy("_asked").agg(*summary), "_asked").drop("_asked")
    return requests.join(met.drop(*asked), "_asked").drop("_asked")


def facet_meetings(selections: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs of a selection and a candidate that agree on all keys the selection names; the candidate's are ``c_<key>``.

    A selection is looked up under all values it names together, and a candidate
    stands under its values for each set of keys that some selection names, so
    only pairs that agree meet.  The driver learns which sets of keys there are.
    """
    candidates = candidates.withColumnsRenamed({k: f"c_{k}" for k in keys})
    bits = [F.when(F.col(k).isNull(), 0).otherwise(1 << i) for i, k in enumerate(keys)]
    selections = selections.withColumn("_set", sum(bits, F.lit(0)))
    sets = [row["_set"] for row in selections.select("_set").distinct().collect()] or [0]

    def token(chosen: int, prefix: str = "") -> Column:
        values = [F.col(prefix + k).cast("string") for i, k in enumerate(keys) if chosen >> i & 1]
        whole = reduce(lambda a, b: a & b, [v.isNotNull() for v in values], F.lit(True))
        return F.when(whole, F.xxhash64(F.lit(chosen), *values))

    asking = selections.withColumn("_token", F.coalesce(*[F.when(F.col("_set") == s, token(s)) for s in sets]))
    standing = candidates.withColumn("_token", F.explode(F.array_compact(F.array(*[token(s, "c_") for s in sets]))))
    agree = F.lit(True)
    for key in keys:  # two values with one hash
        agree = agree & (F.col(key).isNull() | (F.col(key) == F.col(f"c_{key}")))
    met = salted_join(standing, asking, ["_token"], candidates.columns)
    return met.where(agree).drop("_token", "_set")


def subset_arguments(
    years: Column, months: Column, days: Column, levels: Column, area: Column
) -> dict[str, Column]:
    """Arguments of a subset: year range, date parts by name, whole levels, box as west, south, east, north."""
    level_numbers = F.filter(
        F.transform(levels, lambda v: v.try_cast("double").try_cast("bigint")), lambda v: v.isNotNull()
    )
    names = F.transform(
        months, lambda m: F.lower(F.date_format(F.make_date(F.lit(2000), m.cast("int"), F.lit(1)), "MMM"))
    )
    return {
        # years are text and are compared as text
        "time": F.concat_ws("/", F.array_min(years), F.array_max(years)),
        "time_components": F.concat_ws(
            "|",
            F.concat(F.lit("day:"), F.array_join(days, ",")),
            F.concat(F.lit("month:"), F.array_join(names, ",")),
            F.concat(F.lit("year:"), F.array_join(years, ",")),
        ),
        "level": F.nullif(F.array_join(F.transform(level_numbers, lambda v: v.cast("string")), ","), F.lit("")),
        "area": F.array_join(F.array(*[F.get(area, i) for i in (1, 2, 3, 0)]), ","),
    }


# --- receipts -------------------------------------------------------------------


def licence_text(title: Column, revision: Column) -> Column:
    return F.concat(title, F.lit(" (version "), revision.cast("string"), F.lit(")"))


def receipts(jobs: DataFrame, collections: DataFrame, results: DataFrame) -> DataFrame:
    """One receipt per job with what is known of its collection and result.

    Message and traceback appear only when the job has them, file name and size
    only when there is a result.
    """
    # a collection may have most of the jobs
    named = salted_join(jobs, collections, ["collection_id"], ["request_id"])
    joined = named.join(results, "request_id", "left")
    return joined.withColumn("licence", F.transform("licences", lambda l: licence_text(l["title"], l["revision"])))


def receipt_json(receipt: DataFrame) -> DataFrame:
    fields = [c for c in receipt.columns if c != "licences"]
    return receipt.select("request_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("receipt"))
