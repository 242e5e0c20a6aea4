"""Checking and repairing tables of requests.

A rule set is compiled once to Column expressions: the repaired value of every
key and the list of what is still wrong with it.  Good rows and rejects are two
filters on the same frame.  Repairs run in one fixed order, duplicates last, as
other repairs can make values equal.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions import text as X

# --- registries a user can add to ---------------------------------------------

TextCheck = Callable[[Column], Column]
Repair = Callable[[Column, "Rule"], Column]
Message = Callable[[Column, "Rule"], Column]

FORMATS: dict[str, TextCheck] = {
    "date": X.is_iso_date,
    "date range": X.is_date_range,
    "date or date range": X.is_date_or_range,
    "numeric string": X.is_numeric,
    "positive numeric string": X.is_positive_numeric,
}
REPAIRS: dict[str, Repair] = {}
MESSAGES: dict[str, Message] = {}


def register_format(name: str, check: TextCheck) -> None:
    FORMATS[name] = check


def register_repair(name: str, repair: Repair) -> None:
    REPAIRS[name] = repair


def register_message(format_name: str, message: Message) -> None:
    MESSAGES[format_name] = message


@dataclass(frozen=True)
class Rule:
    """What one key must look like.

    The column may hold lists or scalars, text or numbers; ``scalar`` and
    ``kind`` say what comes out.
    """

    key: str
    required: bool = False
    default: Sequence[str] | None = None
    scalar: bool = False
    kind: str = "string"  # string, number or integer
    format: str | None = None
    allowed_formats: Sequence[str] = ()  # patterns of dates that may be rewritten
    split_on: str | None = None
    min_items: int | None = None
    max_items: int | None = None
    unique: str | None = None  # remove or reject
    pattern: str | None = None
    show_pattern: bool = True
    min_length: int | None = None
    max_length: int | None = None
    delete_if_short: bool = False
    allowed: Sequence[str] | None = None
    minimum: Mapping[int, float] = field(default_factory=dict)  # by place
    maximum: Mapping[int, float] = field(default_factory=dict)
    repairs: Sequence[str] = ()  # names in REPAIRS


# --- single repairs -------------------------------------------------------------


def list_to_scalar(values: Column) -> Column:
    """The only element of a list; NULL for other lists."""
    return F.when(F.size(values) == 1, F.get(values, 0))


def scalar_to_list(value: Column) -> Column:
    return F.when(value.isNotNull(), F.array(value))


def reformat_dates(values: Column, patterns: Sequence[str]) -> Column:
    """Rewrite dates in other patterns as yyyy-mm-dd; what fits none stays."""

    def rewritten(v: Column) -> Column:
        parsed = F.coalesce(*[F.date_format(F.try_to_timestamp(v, F.lit(p)), "yyyy-MM-dd") for p in patterns])
        return F.when(FORMATS["date or date range"](v), v).otherwise(F.coalesce(parsed, v))

    return F.transform(values, rewritten) if patterns else values


def dates_to_ranges(values: Column) -> Column:
    """Single dates as ``d/d``."""
    return F.transform(values, lambda v: F.when(X.is_iso_date(v), F.concat_ws("/", v, v)).otherwise(v))


def drop_short(values: Column, length: int) -> Column:
    return F.filter(values, lambda v: F.length(v) >= length)


def number_text(value: Column) -> Column:
    return value.cast("string")


def remove_unknown_keys(
    request: Column, names: Sequence[str], patterns: Sequence[str] = (), removable: Sequence[str] | None = None
) -> Column:
    """A request as a map without the keys that are neither named nor match a pattern."""

    def stays(k: Column, _: Column) -> Column:
        known = k.isin(list(names))
        for pattern in patterns:
            known = known | k.rlike(pattern)
        return known if removable is None else known | ~k.isin(list(removable))

    return F.map_filter(request, stays)


def unknown_keys(request: Column, names: Sequence[str], patterns: Sequence[str] = ()) -> Column:
    """Sorted key names that are neither named nor match a pattern."""

    def unknown(k: Column) -> Column:
        known = k.isin(list(names))
        for pattern in patterns:
            known = known | k.rlike(pattern)
        return ~known

    return F.array_sort(F.filter(F.map_keys(request), unknown))


# --- compiling a rule -------------------------------------------------------------


def as_text_list(rule: Rule, dtype: T.DataType) -> Column:
    """A key of any declared type as a list of text: scalars are wrapped and numbers written out."""
    values = F.col(rule.key)
    element = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
    if not isinstance(dtype, T.ArrayType):
        values = scalar_to_list(values)
    if isinstance(element, T.StringType):
        return values

    def text(v: Column) -> Column:
        whole = X.integer_from_double(v)  # 1.0 may stand for an integer
        return F.coalesce(whole.cast("string"), number_text(v)) if rule.kind == "integer" else number_text(v)

    return F.transform(values, text)


def repaired(rule: Rule, dtype: T.DataType) -> Column:
    """The repaired list of a key, as text."""
    values = as_text_list(rule, dtype)
    if rule.default is not None:
        values = F.coalesce(values, F.array(*[F.lit(v) for v in rule.default]))
    if rule.split_on:
        values = X.split_all(values, rule.split_on)
    if rule.min_length is not None and rule.delete_if_short:
        values = drop_short(values, rule.min_length)
    for name in rule.repairs:
        values = REPAIRS[name](values, rule)
    if rule.format in ("date", "date range", "date or date range"):
        values = reformat_dates(values, rule.allowed_formats)
    if rule.format == "date range":
        values = dates_to_ranges(values)
    if rule.unique == "remove":
        values = F.array_distinct(values)
    return values


def typed(rule: Rule, values: Column) -> Column:
    """A repaired list in the type the rule asks for; a scalar rule gives its only element."""
    if rule.kind == "integer":
        values = F.transform(values, X.integer)
    elif rule.kind == "number":
        values = F.transform(values, X.number)
    return F.get(values, 0) if rule.scalar else values


def path(key: str, place: Column | None = None) -> Column:
    start = F.lit(f"request['{key}']")
    return start if place is None else F.concat(start, F.lit("["), place.cast("string"), F.lit("]"))


def quoted_list(values: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(values, "', '"), F.lit("']"))


def item_message(rule: Rule, value: Column, place: Column) -> Column:
    """What is wrong with one element, NULL when nothing is.  The wording is a set of fixed values."""
    tests: list[tuple[Column, Column]] = []  # the first that fails is reported
    if rule.kind in ("number", "integer"):
        number = X.number(value) if rule.kind == "number" else X.integer(value)
        tests.append((number.isNull(), _quoted(value, f"' is not a valid {rule.kind}")))
        for at, low in rule.minimum.items():
            text = F.concat(X.number(value).cast("string"), F.lit(f" is less than the minimum of {low}"))
            tests.append(((place == at) & (X.number(value) < low), text))
        for at, high in rule.maximum.items():
            text = F.concat(X.number(value).cast("string"), F.lit(f" is greater than the maximum of {high}"))
            tests.append(((place == at) & (X.number(value) > high), text))
    if rule.min_length is not None:
        text = f"': string is too short. Should have at least {rule.min_length} character(s)"
        tests.append((F.length(value) < rule.min_length, _quoted(value, text)))
    if rule.max_length is not None:
        text = f"': string is too long. Should have no more than {rule.max_length} character(s)"
        tests.append((F.length(value) > rule.max_length, _quoted(value, text)))
    if rule.allowed is not None:
        tests.append((~value.isin(list(rule.allowed)), _quoted(value, f"' is not one of {list(rule.allowed)}")))
    if rule.pattern is not None:
        text = F.concat(F.lit("invalid value: '"), value, F.lit("'"))
        if rule.show_pattern:
            text = F.concat(text, F.lit(f". Valid values must match regular expression '{rule.pattern}'"))
        tests.append((~value.rlike(rule.pattern), text))
    if rule.format is not None:
        valid = F.coalesce(FORMATS[rule.format](value), F.lit(False))
        tests.append((~valid, _format_message(rule, value)))
    if not tests:
        return F.lit(None).cast("string")
    message = F.lit(None).cast("string")
    for failed, text in reversed(tests):
        message = F.when(failed, text).otherwise(message)
    return F.concat(path(rule.key, None if rule.scalar else place), F.lit(": "), message)


def _quoted(value: Column, rest: str) -> Column:
    return F.concat(F.lit("'"), value, F.lit(rest))


def _format_message(rule: Rule, value: Column) -> Column:
    if rule.format in MESSAGES:
        return MESSAGES[rule.format](value, rule)
    if rule.format == "date":
        return F.concat(F.lit('"'), value, F.lit('" is not a valid date. Expected format is yyyy-mm-dd'))
    return _quoted(value, f"' is not a valid {rule.format}")


def length_text(rule: Rule, too_few: bool) -> str:
    word = "few" if too_few else "many"
    if rule.min_items is not None and rule.min_items == rule.max_items:
        return f": list has too {word} items. Should have exactly {rule.min_items}"
    if too_few:
        return f": list has too few items. Should have at least {rule.min_items}"
    return f" list has too many items. Should have no more than {rule.max_items}"


def problems(rule: Rule, values: Column) -> Column:
    """All messages about a repaired list: first about the list, then about its elements."""
    start = F.concat(path(rule.key), F.lit(": "))
    listed = F.concat(start, quoted_list(values))
    found: list[Column] = []
    if rule.required:
        found.append(F.when(values.isNull(), F.lit(f"request: missing mandatory key: '{rule.key}'")))
    if rule.min_items is not None:
        found.append(F.when(F.size(values) < rule.min_items, F.concat(listed, F.lit(length_text(rule, True)))))
    if rule.max_items is not None:
        found.append(F.when(F.size(values) > rule.max_items, F.concat(listed, F.lit(length_text(rule, False)))))
    if rule.unique == "reject":
        example = F.concat(start, F.lit("has repeated values in the list, e.g. '"), first_repeated(values), F.lit("'"))
        found.append(F.when(F.size(values) > F.size(F.array_distinct(values)), example))
    if rule.scalar:
        found.append(F.when(F.size(values) > 1, F.concat(listed, F.lit(" is not of type 'string'"))))
    nothing = F.array().cast("array<string>")
    items = F.transform(F.coalesce(values, nothing), lambda v, i: item_message(rule, v, i))
    return F.array_distinct(F.concat(F.array_compact(F.array(*found).cast("array<string>")), F.array_compact(items)))


def first_repeated(values: Column) -> Column:
    """The first element that occurs again.

    Equal elements lie side by side once the list is in order, so a long list is not searched for each of its elements.
    """
    ordered = F.array_sort(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    again = F.zip_with(ordered, F.slice(ordered, 2, F.size(ordered)), lambda a, b: F.when(a["v"] == b["v"], a["i"]))
    return F.get(values, F.array_min(again))


def check(requests: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Requests with repaired keys and ``errors``, the messages in order of the rules."""
    types = {f.name: f.dataType for f in requests.schema}
    fixed = requests.withColumns({f"_{r.key}": repaired(r, types[r.key]) for r in rules})
    fixed = fixed.withColumn("errors", F.array_distinct(F.concat(*[problems(r, F.col(f"_{r.key}")) for r in rules])))
    final = {r.key: typed(r, F.col(f"_{r.key}")) for r in rules}
    return fixed.withColumns(final).drop(*[f"_{r.key}" for r in rules])


def enforce(requests: DataFrame, rules: Sequence[Rule], id_column: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """Good requests, repaired, and rejects with one row per message."""
    checked = check(requests, rules)
    good = checked.where(F.size("errors") == 0).drop("errors")
    rejects = checked.select(id_column, F.posexplode("errors").alias("place", "message"))
    labels = [F.lit("rules").alias("rule_id"), F.lit("invalid request").alias("reason_group")]
    return good, rejects.select(id_column, *labels, "place", "message")


# --- rule sets --------------------------------------------------------------------

NON_BLANK = r"^[ \t]*[\S ]*\S[\S ]*[ \t]*$"


def archive_problems(
    request: Column,
    exempt: Sequence[str] = ("grid", "area"),
    key_pattern: str = NON_BLANK,
    value_pattern: str = NON_BLANK,
) -> Column:
    """Messages about an archive request, a map of key to list of text.

    At least one key, key names and values that are not blank, lists that are
    not empty, and no repeated values.  Keys that the archive may read as area
    or grid, by any leading part of the name, may repeat values.
    """
    first_letters = sorted({k[0].lower() for k in exempt})
    entries = F.map_entries(request)

    def about(entry: Column) -> Column:
        key, values = entry["key"], entry["value"]
        start = F.concat(F.lit("request['"), key, F.lit("']"))
        may_repeat = F.substring(F.lower(F.ltrim(key)), 1, 1).isin(first_letters)
        whole = F.array(
            F.when(~key.rlike(key_pattern), F.concat(F.lit("request: '"), key, F.lit("' is an invalid key name"))),
            F.when(F.size(values) < 1, F.concat(start, F.lit(": []: list has too few items. Should have at least 1"))),
            F.when(
                ~may_repeat & (F.size(F.array_distinct(values)) < F.size(values)),
                F.concat(start, F.lit(": has repeated values in the list, e.g. '"), first_repeated(values), F.lit("'")),
            ),
        )
        items = F.transform(
            values,
            lambda v, i: F.when(
                ~v.rlike(value_pattern),
                F.concat(start, F.lit("["), i.cast("string"), F.lit("]: invalid value: '"), v, F.lit("'")),
            ),
        )
        return F.concat(whole, items)

    empty = F.array(F.when(F.size(entries) == 0, F.lit("request: {} should be non-empty")))
    return F.array_distinct(F.array_compact(F.concat(empty, F.flatten(F.transform(entries, about)))))


REGIONAL_KEYS = ["variable", "model", "level", "date", "type", "time", "step", "format"]  # fixed values
REGIONAL_FORMATS = ["grib", "netcdf", "netcdf_zip"]  # fixed values


def regional_rules() -> list[Rule]:
    """Rules of a regional-forecast request: eight mandatory keys, a four-number area, one format of three."""
    rules = []
    for key in REGIONAL_KEYS:
        if key == "date":
            rules.append(Rule(key, required=True, min_items=1, format="date or date range"))
        elif key == "format":
            rules.append(Rule(key, required=True, default=["grib"], min_items=1, max_items=1, allowed=REGIONAL_FORMATS))
        else:
            rules.append(Rule(key, required=True, min_items=1))
    rules.append(
        Rule("area", kind="number", min_items=4, max_items=4, minimum={0: -90.0, 2: -90.0}, maximum={0: 90.0, 2: 90.0})
    )
    return rules


def unknown_key_message(request: Column, names: Sequence[str]) -> Column:
    """Message about keys outside a rule set; NULL when there are none."""
    keys = unknown_keys(request, names)
    listed = F.concat(F.lit("'"), F.array_join(keys, "', '"), F.lit("'"))
    plural = F.when(F.size(keys) > 1, "Invalid key names: ").otherwise("Invalid key name: ")
    return F.when(F.size(keys) > 0, F.concat(F.lit("request: "), plural, listed))
