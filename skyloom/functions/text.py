"""Expressions on the text of request values and names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accepted spellings
TRUE_WORDS = ["y", "yes", "t", "true", "on", "1"]
FALSE_WORDS = ["n", "no", "f", "false", "off", "0"]
NETCDF_NAMES = ["netcdf4", "netcdf", "nc"]
GRIB_NAMES = ["grib", "grib2", "grb", "grb2"]
ZIPPED_NETCDF_NAMES = ["netcdf.zip", "netcdf_zip", "netcdf4.zip"]

NUMBER = r"^\s*[-+]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][-+]?\d+)?\s*$"
NOT_FINITE = r"(?i)^\s*[-+]?(inf|infinity|nan)\s*$"
INTEGER = r"^\s*[-+]?\d+(_\d+)*\s*$"


def truth(text: Column) -> Column:
    """Truth-value text to a boolean, NULL when it is none."""
    word = F.lower(text)
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def number(text: Column) -> Column:
    """Numeric text to double, in the spellings Python reads; NULL for others."""
    plain = F.replace(F.trim(text), F.lit("_"), F.lit(""))
    word = F.lower(F.trim(text))
    return (
        F.when(text.rlike(NUMBER), plain.try_cast("double"))
        .when(text.rlike(NOT_FINITE) & word.contains("nan"), F.lit(float("nan")))
        .when(text.rlike(NOT_FINITE), F.when(word.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


def integer(text: Column) -> Column:
    """Integer text to bigint; NULL for anything else, also for 1.0."""
    plain = F.replace(F.trim(text), F.lit("_"), F.lit(""))
    return F.when(text.rlike(INTEGER), plain.try_cast("bigint"))


def integer_from_double(value: Column) -> Column:
    """A number as an integer, NULL when that would lose something."""
    whole = value.try_cast("bigint")
    return F.when(whole == value, whole)


def is_numeric(text: Column) -> Column:
    return text.rlike(NUMBER) | text.rlike(NOT_FINITE)


def is_positive_numeric(text: Column) -> Column:
    value = number(text)
    return F.coalesce(~F.isnan(value) & (value > 0), F.lit(False))


def is_iso_date(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & F.try_to_date(text, "yyyy-M-d").isNotNull()


def is_date_or_range(text: Column) -> Column:
    """yyyy-mm-dd, or two of them with a slash between and the ends in order."""
    parts = F.split(text, "/")
    days = F.transform(parts, lambda p: F.when(is_iso_date(p), F.try_to_date(p, "yyyy-M-d")))
    all_days = F.forall(days, lambda d: d.isNotNull())
    in_order = F.coalesce(F.get(days, 0) <= F.get(days, 1), F.lit(False))
    ordered = (F.size(parts) == 1) | ((F.size(parts) == 2) & in_order)
    return all_days & ordered


def is_date_range(text: Column) -> Column:
    return is_date_or_range(text) & text.contains("/")


def data_format(name: Column) -> Column:
    """The usual name of a data format."""
    return (
        F.when(name.isin(NETCDF_NAMES), "netcdf")
        .when(name.isin(GRIB_NAMES), "grib")
        .when(F.lower(name).isin(ZIPPED_NETCDF_NAMES), "netcdf")
        .otherwise(name)
    )


def wants_zip(name: Column) -> Column:
    """The older spellings that ask for a zipped file as well."""
    return F.lower(name).isin(ZIPPED_NETCDF_NAMES)


def extension(path: Column) -> Column:
    """File type from the name, ``unknown`` when it has none."""
    found = F.regexp_extract(path, r"[.]([^./]+)$", 1)
    return F.when(found == "", "unknown").otherwise(found)


def split_all(values: Column, separator: str) -> Column:
    """Every element split on a separator, in place."""
    return F.flatten(F.transform(values, lambda v: F.split(v, "\\Q" + separator + "\\E")))


def is_key(name: Column, key: str) -> Column:
    """Whether a key name is taken as the given key: its prefix after trimming, in any case."""
    return F.lower(F.trim(name)).startswith(key.lower().strip())
