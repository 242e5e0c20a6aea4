"""Translating tables of requests: defaults, maps, names, formats, dates, delays and sources.

A key is a column, an array of strings unless said otherwise; an absent key is NULL.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.errors import ConfigurationError
from skyloom.functions import dates as D
from skyloom.functions import text as X
from skyloom.functions.space import RegularGrid, snap_inwards
from skyloom.operators.scale import salted_join
from skyloom.tables import literal_map

DOWNLOAD_FORMATS = ["zip", "tgz", "as_source"]  # fixed values


# --- value mapping -----------------------------------------------------------


def set_defaults(requests: DataFrame, defaults: Mapping[str, Sequence[str]]) -> DataFrame:
    """Give absent keys their default values."""
    columns = {}
    for key, values in defaults.items():
        default = F.array(*[F.lit(v) for v in values])
        columns[key] = F.coalesce(F.col(key), default) if key in requests.columns else default
    return requests.withColumns(columns)


def force_values(requests: DataFrame, forced: Mapping[str, Sequence[str]]) -> DataFrame:
    """Overwrite keys with fixed values."""
    return requests.withColumns({k: F.array(*[F.lit(v) for v in vs]) for k, vs in forced.items()})


def remap_list(values: Column, mapping: Mapping[str, str]) -> Column:
    """Map every element; unknown ones stay."""
    if not mapping:
        return values
    table = literal_map(dict(mapping))
    return F.transform(values, lambda v: F.coalesce(F.try_element_at(table, v), v))


def remap_scalar(value: Column, mapping: Mapping[str, str]) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dict(mapping)), value), value) if mapping else value


def remap_by_table(fields: DataFrame, key: str, mapping: DataFrame) -> DataFrame:
    """Map a scalar key through a table (old, new); a value that most fields share is spread over tasks."""
    table = mapping.select(F.col("old").alias(key), F.col("new").alias("_new"))
    joined = salted_join(fields, table, [key], fields.columns, "left")
    return joined.withColumn(key, F.coalesce("_new", key)).drop("_new")


def rename_keys(requests: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return requests.withColumnsRenamed(dict(names))


def add_patch(requests: DataFrame, source: str, target: str, mapping: Mapping[str, str]) -> DataFrame:
    """A new key made from another one through a value map."""
    return requests.withColumn(target, remap_scalar(F.col(source), mapping))


def as_list(value: Column) -> Column:
    """A scalar as a list of one; an absent key stays absent."""
    return F.when(value.isNotNull(), F.array(value))


def safe_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns at once; a taken name is fine only when it was renamed before."""
    freed: set[str] = set()
    for old, new in names.items():
        if new in df.columns and new not in freed and new != old:
            raise ConfigurationError(f"cannot rename {old} to {new}: the name is taken")
        freed.add(old)
    result = [names.get(c, c) for c in df.columns]
    if len(set(result)) != len(result):
        raise ConfigurationError(f"renaming gives the same name twice: {result}")
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def expand_dimensions(df: DataFrame, scalars: Mapping[str, object], order: Sequence[str]) -> DataFrame:
    """Scalar coordinates as columns, coordinates first and in the given order."""
    wide = df.withColumns({k: F.lit(v) for k, v in scalars.items() if k not in df.columns})
    return wide.select(*order, *[c for c in wide.columns if c not in order])


# The two sets of date keys that every dataset may use.
DATE_KEYS = (
    {"date": "date", "year": "year", "month": "month", "day": "day", "format": "date_format"},
    {"date": "hdate", "year": "hyear", "month": "hmonth", "day": "hday", "format": "hdate_format"},
)
DATE_FIELDS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%j": "DDD"}


def apply_mapping(requests: DataFrame, mapping: Mapping) -> DataFrame:
    """The whole translation of a dataset: defaults, lists, remap, patches, rename, force, dates.

    ``options`` may ask for lists (``wants_lists``), for dates made of years, months and days or of ranges
    (``wants_dates``, with a format for each set of date keys), for intervals (``wants_intervals``) and for seconds since an
    epoch (``seconds_since_epoch``, ``add_hours_to_date``).  Where dates are asked for, ``mapping_problem`` says what is wrong with
    a request's dates, else NULL.
    """
    options, rename = mapping.get("options", {}), mapping.get("rename", {})
    requests = set_defaults(requests, mapping.get("defaults", {}))
    for key in options.get("wants_lists", []):
        if key in requests.columns and not requests.schema[key].dataType.simpleString().startswith("array"):
            requests = requests.withColumn(key, as_list(F.col(key)))
    for key, values in mapping.get("remap", {}).items():
        if key in requests.columns:
            requests = requests.withColumn(key, remap_list(F.col(key), values))
    for patch in mapping.get("patches", []):
        requests = requests.withColumn(patch["to"], remap_list(F.col(patch["from"]), patch["mapping"]))
    requests = rename_keys(requests, rename)
    requests = force_values(requests, mapping.get("force", {}))
    problems = []
    for keys in options.get("date_keys", DATE_KEYS):
        parts = [k if k in mapping.get("force", {}) else rename.get(k, k) for k in (keys["year"], keys["month"], keys["day"])]
        if options.get("wants_dates"):
            requests, problem = _with_dates(requests, keys["date"], parts, options.get(keys["format"], "%Y-%m-%d"))
            problems += problem
        if keys["date"] not in requests.columns:
            continue
        date = F.col(keys["date"]).cast("array<string>")
        if options.get("wants_intervals"):
            requests = requests.withColumn(keys["date"], F.transform(date, D.to_interval))
        if options.get("seconds_since_epoch") is not None:
            epoch = F.lit(options["seconds_since_epoch"]).cast("date")
            hours = options.get("add_hours_to_date", 0)
            requests = requests.withColumn(keys["date"], F.transform(date, lambda v: D.seconds_since(D.parse_date(v), epoch, hours)))
    if options.get("wants_dates"):
        requests = requests.withColumn("mapping_problem", F.coalesce(*problems, F.lit(None).cast("string")))
        requests = requests.drop(*[c for c in requests.columns if c.startswith("_problem_")])
    return requests


def date_pattern(strftime: str) -> str:
    """A date format as configuration writes it, in Spark's letters."""
    pattern = strftime
    for field, letters in DATE_FIELDS.items():
        pattern = pattern.replace(field, letters)
    if "%" in pattern:
        raise ConfigurationError(f"{strftime} has a field that is no year, month or day")
    return pattern


def _with_dates(requests: DataFrame, date: str, parts: Sequence[str], strftime: str) -> tuple[DataFrame, list[Column]]:
    """Dates and ranges of ``date`` as sorted single dates; where it is absent, those of the years, months and days."""
    pattern, texts = date_pattern(strftime), "array<string>"
    made, problems = [], []
    if date in requests.columns:
        given = F.transform(F.col(date).cast(texts), lambda t: F.trim(t))

        def opened(text: Column) -> Column:
            ends = F.split(text, "/")
            first, last = D.parse_date(F.trim(ends[0])), D.parse_date(F.trim(F.element_at(ends, -1)))
            days = F.transform(D.date_range(first, last), lambda d: F.date_format(d, pattern))
            return F.when(text == "", F.array(text)).otherwise(F.coalesce(days, F.array().cast(texts)))

        def malformed(text: Column) -> Column:
            ends = F.transform(F.split(text, "/"), lambda e: D.parse_date(F.trim(e)))
            return (text != "") & ((F.size(ends) > 2) | F.exists(ends, lambda e: e.isNull()))

        made.append(F.array_sort(F.array_distinct(F.flatten(F.transform(given, opened)))))
        problems.append(F.when(F.exists(given, malformed), F.lit("a date or date range cannot be read")))
    if all(p in requests.columns for p in parts):
        kind = {p: requests.schema[p].dataType.simpleString().startswith("array") for p in parts}
        numbers = [F.transform(F.col(p) if kind[p] else F.array(p), lambda v: v.try_cast("int")) for p in parts]

        def of_month(y: Column, m: Column) -> Column:
            return F.transform(numbers[2], lambda d: D.valid_date(y, m, d))

        days = F.flatten(F.flatten(F.transform(numbers[0], lambda y: F.transform(numbers[1], lambda m: of_month(y, m)))))
        found = F.transform(F.array_sort(F.array_distinct(F.array_compact(days))), lambda d: F.date_format(d, pattern))
        asked = F.size(numbers[0]) * F.size(numbers[1]) * F.size(numbers[2]) > 0
        used = asked & F.col(date).isNull() if date in requests.columns else asked
        made.append(F.when(asked, found))
        problems.append(F.when(used & (F.size(found) == 0), F.lit("no valid dates from year, month and day")))
        cleared = {p: F.when(~F.coalesce(used, F.lit(False)), F.col(p)) for p in parts}
        rest = [F.col(f"`{c}`") for c in requests.columns if c not in (date, *parts)]
        changed = {"_new_" + k: v for k, v in {date: F.coalesce(*made), **cleared}.items()}
        changed[f"_problem_{date}"] = F.coalesce(*problems)
        made_of = requests.select(*rest, *[v.alias(k) for k, v in changed.items()])
        return made_of.withColumnsRenamed({k: k.removeprefix("_new_") for k in changed}), [F.col(f"_problem_{date}")]
    if made:
        rest = [F.col(f"`{c}`") for c in requests.columns if c != date]
        requests = requests.select(*rest, made[0].alias("_new"), problems[0].alias(f"_problem_{date}")).withColumnRenamed("_new", date)
        return requests, [F.col(f"_problem_{date}")]
    return requests, []


# --- formats -----------------------------------------------------------------


def one_data_format(requests: DataFrame, job: str, fmt: str) -> DataFrame:
    """The usual data format of a job and whether the job names exactly one."""
    return requests.groupBy(job).agg(
        F.min(X.data_format(F.col(fmt))).alias("data_format"),
        (F.count_distinct(X.data_format(F.col(fmt))) == 1).alias("valid"),
        F.bool_or(X.wants_zip(F.col(fmt))).alias("zipped"),
    )


def download_format(value: Column, default: str = "zip") -> Column:
    return F.when(value.isin(DOWNLOAD_FORMATS), value).otherwise(F.lit(default))


# --- shape -------------------------------------------------------------------


def adapt_parameters(requests: DataFrame) -> DataFrame:
    """Observation request: whole numbers for dates, and a box as two coverage pairs."""
    for key in ("year", "month", "day"):
        if key in requests.columns:
            requests = requests.withColumn(key, F.transform(key, lambda v: v.try_cast("int")))
    if "area" in requests.columns:
        area = F.transform("area", lambda v: v.try_cast("double"))
        requests = requests.withColumn("latitude_coverage", F.array(F.get(area, 2), F.get(area, 0)))
        requests = requests.withColumn("longitude_coverage", F.array(F.get(area, 1), F.get(area, 3)))
        requests = requests.drop("area")
    return requests


def single_valued(values: Column) -> Column:
    return F.coalesce(F.size(values) <= 1, F.lit(True))


def separate_processing(
    requests: DataFrame, processing: Mapping[str, str], id_column: str = "request_id"
) -> tuple[DataFrame, DataFrame]:
    """Selection keys and processing parameters apart; a parameter has one value or its default."""
    selection = requests.drop(*processing)
    values = [F.coalesce(F.get(F.col(k), 0), F.lit(v)).alias(k) for k, v in processing.items()]
    # Fixed value: wording of the error.
    text = "Multiple {} values in a single request is not supported."
    errors = F.array(*[F.when(~single_valued(F.col(k)), F.lit(text.format(k))) for k in processing])
    return selection, requests.select(id_column, *values, F.array_compact(errors).alias("errors"))


def form_values(widgets: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Allowed values of forms: (name, value) of their widgets by ``scope``, nested groups included.

    ``widgets`` has name, type, values, groups (array of arrays), min_start and
    max_end.  A date range gives one ``min/max`` value; other kinds are dropped.
    """
    listed = widgets.where(F.col("type").isin("StringListWidget", "StringChoiceWidget"))
    nested = widgets.where(F.col("type") == "StringListArrayWidget")
    ranges = widgets.where(F.col("type") == "DateRangeWidget")
    return (
        listed.select(*scope, "name", F.explode("values").alias("value"))
        .unionByName(nested.select(*scope, "name", F.explode(F.flatten("groups")).alias("value")))
        .unionByName(ranges.select(*scope, "name", F.concat_ws("/", "min_start", "max_end").alias("value")))
        .distinct()
    )


def unsupported_widgets(widgets: DataFrame) -> DataFrame:
    known = ["StringListWidget", "StringChoiceWidget", "StringListArrayWidget", "DateRangeWidget"]
    return widgets.where(~F.col("type").isin(known))


def fingerprint(keys: Column, avoid_cache: Column) -> Column:
    """One text per request whatever the order of its keys; random where the result must not be reused."""
    entries = F.array_sort(F.map_entries(keys))
    return F.when(avoid_cache, F.uuid()).otherwise(F.sha2(F.to_json(entries), 256))


def reusable_results(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests with the result already there for their fingerprint, if any."""
    return requests.join(results, "fingerprint", "left").withColumn("hit", F.col("result").isNotNull())


# --- dates and delays ---------------------------------------------------------


def dates_from_parts(requests: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Year x month x day to real dates; impossible ones are dropped."""
    for part in ("year", "month", "day"):
        requests = requests.withColumn(part, F.explode(part))
    date = D.valid_date(F.col("year"), F.col("month"), F.col("day"))
    return requests.select(*keep, date.alias("d")).where("d IS NOT NULL").distinct()


def drop_before_first_valid(dates: DataFrame, first_valid: str, ahead_of_utc: Column, date: str = "d") -> DataFrame:
    """Drop days before the first valid one, a day later where the clock is ahead of UTC."""
    first = F.lit(first_valid).cast("date")
    return dates.where(F.col(date) >= F.when(ahead_of_utc, F.date_add(first, 1)).otherwise(first))


def embargo(
    requests: DataFrame,
    as_of: Column,
    days: int = 0,
    hours: int = 0,
    months: int = 0,
    date: str = "d",
    time: str = "time",
    filter_times: bool = True,
) -> DataFrame:
    """Cut dates and times that are not out yet.

    Times that cannot be read are never out; :func:`unreadable_times` finds
    the requests that have some, which are to be rejected before.

    Each request gives up to two rows: the dates before the limit, and the day
    of the limit with the times up to its hour.  ``cacheable`` turns false as
    soon as something was held back or cut at the limit.  A request without any
    row left is found by an anti join.
    """
    requests = requests.withColumn("_limit", embargo_limit(as_of, days, hours, months)).withColumn("_day", F.to_date("_limit"))
    whole = F.filter(date, lambda d: (d < F.col("_day")) if filter_times else (d <= F.col("_day")))
    touched = F.exists(date, lambda d: (d >= F.col("_day")) if filter_times else (d > F.col("_day")))
    on_limit = F.lit(filter_times) & F.array_contains(date, F.col("_day"))
    # only requests that reach the limit have their times read
    early = F.when(
        on_limit, F.filter(X.split_all(F.col(time), "/"), lambda t: D.clock_seconds(t) / 3600 <= F.hour("_limit"))
    )
    pieces = F.array(
        F.struct(
            F.lit("before").alias("piece"),
            whole.alias("dates"),
            F.col(time).alias("times"),
            (F.size(whole) > 0).alias("keep"),
        ),
        F.struct(
            F.lit("limit").alias("piece"),
            F.array(F.col("_day")).alias("dates"),
            early.alias("times"),
            F.coalesce(F.size(early) > 0, F.lit(False)).alias("keep"),
        ),
    )
    rest = [c for c in requests.columns if c not in (date, time, "_limit", "_day")]
    return requests.select(
        *rest, (~touched).alias("cacheable"), F.explode(F.filter(pieces, lambda p: p["keep"])).alias("_p")
    ).select(*rest, "cacheable", F.col("_p.piece"), F.col("_p.dates").alias(date), F.col("_p.times").alias(time))


def unreadable_times(
    requests: DataFrame, as_of: Column, days: int = 0, hours: int = 0, months: int = 0, date: str = "d", time: str = "time"
) -> DataFrame:
    """Requests on the day of the limit with a time that cannot be read, as ``unreadable``.

    Times of requests that do not reach the limit are not looked at.
    """
    day = F.to_date(embargo_limit(as_of, days, hours, months))
    wrong = F.filter(X.split_all(F.col(time), "/"), lambda t: D.clock_seconds(t).isNull())
    return requests.where(F.array_contains(date, day)).withColumn("unreadable", wrong).where(F.size("unreadable") > 0)


def embargo_limit(as_of: Column, days: int, hours: int, months: int) -> Column:
    moment = as_of - F.make_dt_interval(days=F.lit(days), hours=F.lit(hours))
    return moment - F.make_dt_interval(days=D.months_back_in_days(F.to_date(as_of), months)) if months else moment


def clip_range_to_embargo(requests: DataFrame, start: str, end: str, limit: Column) -> DataFrame:
    """A single date range: ends put in order, the end cut at the limit, a start after it rejected."""
    low, high = F.least(start, F.coalesce(end, start)), F.greatest(start, F.coalesce(end, start))
    return (
        requests.withColumns({"_low": low, "_high": high})
        .withColumn("rejected", F.col("_low") > limit)
        .withColumn("clipped", ~F.col("rejected") & (F.col("_high") > limit))
        .withColumn(start, F.col("_low"))
        .withColumn(end, F.when(F.col("clipped"), limit).otherwise(F.col("_high")))
        .drop("_low", "_high")
    )


# --- sources, boxes, keys ------------------------------------------------------


def requests_for_sources(
    requests: DataFrame,
    sources: Sequence[dict],
    keys: Sequence[str],
    copied: Sequence[str] = ("area", "grid"),
    id_column: str = "request_id",
) -> DataFrame:
    """Each source's part of every request.

    A source is ``{"source": name, "values": {key: [...]}, "required": [...]}``.
    Values are compared as text; a source lacking a value of a required key
    gets nothing.
    """
    pieces = []
    for source in sources:
        columns = {}
        for key in keys:
            if key in copied:
                columns[key] = F.col(key)
                continue
            allowed = F.array(*[F.lit(str(v)) for v in source["values"].get(key, [])]).cast("array<string>")
            common = F.array_intersect(F.transform(key, lambda v: v.cast("string")), allowed)
            columns[key] = F.when(F.size(common) > 0, common)
        usable = F.lit(True)
        for key in source.get("required", []):
            usable = usable & columns[key].isNotNull()
        pieces.append(
            F.when(usable, F.struct(F.lit(source["source"]).alias("source"), *[c.alias(k) for k, c in columns.items()]))
        )
    exploded = requests.select(id_column, F.explode(F.array_compact(F.array(*pieces))).alias("_p"))
    return exploded.select(id_column, "_p.*")


def clean_selection(selections: DataFrame, key: str = "key") -> DataFrame:
    """Without the keys that constraints never look at: coordinates picked on the map."""
    return selections.where(~F.col(key).isin("location_x", "location_y"))


def box_problems(
    north: Column,
    west: Column,
    south: Column,
    east: Column,
    max_lat: float = 1.0,
    max_lon: float = 1.0,
    has_point: Column | None = None,
) -> Column:
    """What is wrong with a request's place, as text; NULL when it is fine."""
    has_box = north.isNotNull() & west.isNotNull() & south.isNotNull() & east.isNotNull()
    point = F.lit(False) if has_point is None else has_point
    # Wording of the problems.
    return (
        F.when(has_box == point, "either a box or a point is required, and not both")
        .when(has_box & ((north < south) | (east < west)), "area must be in the form [north, west, south, east]")
        .when(has_box & (F.abs(north - south) > max_lat), "latitude exceeds the maximum extent allowed")
        .when(has_box & (F.abs(west - east) > max_lon), "longitude exceeds the maximum extent allowed")
    )


def simulate_preinterpolation(requests: DataFrame, grid: RegularGrid, keys: str = "keys") -> DataFrame:
    """Open-keyed requests as if the data lay on a regular grid.

    A request that names a grid stays as it is.  Others get the grid's spacing,
    and their area, if any, is snapped inwards.  Key names are read by prefix;
    ``problem`` tells of two keys for one meaning, of an area that is not four
    numbers with latitudes up to 90 degrees, or of one without a point.
    """

    def named(key: str) -> Column:
        return F.filter(F.map_keys(keys), lambda k: X.is_key(k, key))

    # one step after the other: an expression put into others, or into a filter after them, is worked out in each place
    def step(df: DataFrame, **columns: Column) -> DataFrame:
        made = df.withColumn("_step", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
        return made.withColumns({n: F.col(f"_step.{n}") for n in columns}).drop("_step")

    found = step(requests, _areas=named("area"), _grids=F.size(named("grid")))
    area_key, n_areas, n_grids = F.get("_areas", 0), F.size("_areas"), F.col("_grids")
    found = step(found, _values=X.split_all(F.try_element_at(keys, area_key), "/"))
    found = step(found, _texts=F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.get("_values", i)))
    found = step(found, _edges=F.transform("_texts", X.number))
    edges = [F.get("_edges", i) for i in range(4)]
    not_numbers = edges[0].isNull() | edges[1].isNull() | edges[2].isNull() | edges[3].isNull()
    beyond = (F.abs(edges[0]) > 90) | (F.abs(edges[2]) > 90)
    snapped = snap_inwards(*edges, grid)
    box = F.array(*[snapped[e].cast("string") for e in ("north", "west", "south", "east")])
    spacing = F.create_map(F.lit("grid"), F.array(F.lit(str(grid.delta_lon)), F.lit(str(grid.delta_lat))))
    without_area = F.map_filter(keys, lambda k, _: ~X.is_key(k, "area"))
    changed = (
        F.when(area_key.isNotNull(), F.map_concat(without_area, F.create_map(area_key, box), spacing))
        .otherwise(F.map_concat(F.col(keys), spacing))
    )
    has_grid = n_grids > 0
    problem = (
        F.when(n_grids > 1, "request contains more than one grid key")
        .when(has_grid, None)
        .when(n_areas > 1, "request contains more than one area key")
        .when(area_key.isNotNull() & (F.size("_values") != 4), "area must have four items")
        .when(area_key.isNotNull() & not_numbers, "area must hold numbers")
        .when(area_key.isNotNull() & beyond, "area latitude must be from -90 to 90")
        .when(
            area_key.isNotNull() & ~F.coalesce(snapped["has_points"], F.lit(False)),
            "request area contains no grid points",
        )
    )
    judged = step(found, problem=problem)
    usable = F.col("problem").isNull() & ~has_grid
    ready = step(judged, _ready=F.when(usable, changed).otherwise(F.col(keys)))
    return ready.withColumn(keys, F.col("_ready")).drop("_areas", "_grids", "_values", "_texts", "_edges", "_ready")


def key_matches(keys: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """The key of a request that is read as the given one; two of them are an error."""
    hits = keys.where(X.is_key(F.col("key"), key))
    return hits.groupBy(*by).agg(
        F.min("key").alias("matched"), F.count(F.lit(1)).alias("n_matches"), (F.count(F.lit(1)) > 1).alias("ambiguous")
    )
