"""Date and time expressions.  Every one is a plain Column expression.

Nothing reads the clock: whatever depends on "now" takes ``as_of``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd"
COMPACT = "yyyyMMdd"
JULIAN_DAY_OF_1970 = 2440588  # fixed value: Julian day number of 1970-01-01


def date_range(start: Column, end: Column, step_days: int = 1) -> Column:
    """Days from ``start`` to ``end``, both included; empty when start > end."""
    step = F.make_dt_interval(days=F.lit(step_days))
    days = F.sequence(F.least(start, end), end, step)
    return F.when(start <= end, days).otherwise(F.array().cast("array<date>"))


def valid_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or NULL when there is no such day."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), ISO)


def julian_day(date: Column) -> Column:
    return F.unix_date(date) + JULIAN_DAY_OF_1970


def date_from_julian_day(day: Column) -> Column:
    return F.date_from_unix_date((day - JULIAN_DAY_OF_1970).cast("int"))


def compact_integer(date: Column) -> Column:
    """The date as an integer yyyymmdd."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def date_from_compact_integer(value: Column) -> Column:
    """yyyymmdd to a date, NULL when it is not a real day."""
    return F.try_to_date(F.format_string("%08d", value.cast("bigint")), COMPACT)


def rolled_over_date(value: Column) -> Column:
    """yyyymmdd to a date where a day past the month's end runs on into the next month."""
    value = value.cast("bigint")
    first = F.make_date(
        F.floor(value / 10000).cast("int"), (F.floor(value / 100) % 100).cast("int"), F.lit(1)
    )
    return F.date_add(first, (value % 100).cast("int") - 1)


def days_since(date: Column, epoch: Column) -> Column:
    return F.datediff(date, epoch).cast("bigint")


def seconds_since(date: Column, epoch: Column, add_hours: int = 0) -> Column:
    """Seconds since the epoch plus whole hours, as text."""
    return (days_since(date, epoch) * 86400 + add_hours * 3600).cast("string")


def current_date_text(text: Column, as_of: Column) -> Column:
    """``current`` and ``current+N`` / ``current-N`` to a date; NULL for other text.

    N counts days and may have a fraction: it is added before the time of day
    is dropped, so that it can move the moment at which the date changes.
    """
    pattern = r"^ *current([-+][0-9]+(?:\.[0-9]*)?)?"
    offset = F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), F.lit("0")).cast("double")
    moment = as_of + F.make_dt_interval(secs=(offset * 86400).cast("decimal(18,6)"))
    return F.when(text.rlike(pattern), F.to_date(moment))


def parse_date(text: Column) -> Column:
    """yyyy-mm-dd or yyyymmdd text to a date; NULL when it is neither."""
    return F.coalesce(
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d")),
        F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, COMPACT)),
    )


def date_format_of(text: Column) -> Column:
    """Which of the two date formats the text has."""
    return F.when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & F.try_to_date(text, "yyyy-M-d").isNotNull(), ISO
    ).when(text.rlike(r"^\d{8}$") & F.try_to_date(text, COMPACT).isNotNull(), COMPACT)


def time_format_of(text: Column) -> Column:
    return F.when(text.rlike(r"^\d\d:\d\d$"), "HH:mm").when(text.rlike(r"^\d{4}$"), "HHmm")


def reformat_date(text: Column, to: str = ISO) -> Column:
    """A date or a ``a/b`` range in the other format; relative parts are left as they are."""
    return F.array_join(
        F.transform(
            F.split(text, "/"),
            lambda part: F.when(part.contains("current"), part).otherwise(F.date_format(parse_date(part), to)),
        ),
        "/",
    )


def clock_seconds(text: Column) -> Column:
    """H, HH, HHMM, HHMMSS, H:MM or H:MM:SS to seconds of the day; NULL when out of range or malformed."""
    colon = r"^(\d?\d)(?::(\d\d)(?::(\d\d))?)?$"
    plain = r"^(\d?\d)(?:(\d\d)(?:(\d\d))?)?$"

    def part(i: int) -> Column:
        found = F.when(text.contains(":"), F.regexp_extract(text, colon, i)).otherwise(
            F.regexp_extract(text, plain, i)
        )
        return F.coalesce(F.nullif(found, F.lit("")), F.lit("0")).cast("int")

    shaped = F.when(text.contains(":"), text.rlike(colon)).otherwise(text.rlike(plain))
    in_range = (part(1) <= 23) & (part(2) <= 59) & (part(3) <= 59)
    return F.when(shaped & in_range, part(1) * 3600 + part(2) * 60 + part(3))


def months_back_in_days(as_of: Column, months: int) -> Column:
    """Days from the same day (or month end) ``months`` ago to ``as_of``."""
    if months > 12:
        raise ValueError("a delay is at most 12 months")
    return F.datediff(as_of, F.add_months(as_of, -months))


def utc_offset_hours(text: Column) -> Column:
    """``UTC+05:30`` or ``-03:00`` to whole hours."""
    return F.regexp_replace(F.substring(F.replace(F.lower(text), F.lit("utc"), F.lit("")), 1, 3), ":", "").cast("int")


def sampling_hours(shift_hours: int, every_hours: int) -> list[int]:
    """Hours of the day to read so that a shifted day is sampled every few hours."""
    return sorted({(hour + shift_hours % every_hours) % 24 for hour in range(0, 24, every_hours)})


def sampled_hours(shift: Column, every: Column) -> Column:
    """The same as a column, for a table of requests."""
    hours = F.transform(F.sequence(F.lit(0), F.lit(23), every), lambda i: (i + F.pmod(shift, every)) % 24)
    return F.array_sort(F.array_distinct(hours))


def to_interval(text: Column) -> Column:
    """A single date as ``d/d``; a range stays a range."""
    return F.when(text.contains("/"), text).otherwise(F.concat_ws("/", text, text))


def range_struct(text: Column) -> Column:
    """``a/b``, ``a;b`` or ``a`` to struct<start,end>, both ends included; NULL when reversed or malformed."""
    parts = F.split(text, "[;/]")
    start = parse_date(parts[0])
    end = parse_date(F.coalesce(F.try_element_at(parts, F.lit(2)), parts[0]))
    return F.when(start <= end, F.struct(start.alias("start"), end.alias("end")))


def partial_date_bounds(start: str, end: str) -> tuple[Column, Column]:
    """Bounds of a label slice with partial dates: from the start's unit to the end of the end's unit.

    The unit follows from the text length: 4 is a year, 7 a month, 10 a day.
    Returns ``(first moment, first moment after)``.
    """
    units = {4: ("-01-01", F.make_ym_interval(years=F.lit(1))), 7: ("-01", F.make_ym_interval(months=F.lit(1)))}
    low = F.lit(start + units.get(len(start), ("",))[0]).cast("timestamp_ntz")
    if len(end) > 10:
        return low, F.lit(end).cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(0.000001))
    fill, unit = units.get(len(end), ("", F.make_dt_interval(days=F.lit(1))))
    return low, F.lit(end + fill).cast("timestamp_ntz") + unit


def clock_seconds_since_1970(time: Column) -> Column:
    """Seconds since 1970 on the clock the time is written in, whatever the session's zone."""
    day_seconds = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return F.unix_date(F.to_date(time)).cast("bigint") * 86400 + day_seconds


def relative_range(text: str, as_of: Column) -> tuple[Column, Column]:
    """Ends of a range such as ``current-30/current``, either end relative or a plain date."""
    first, _, last = text.partition("/")

    def end(part: str) -> Column:
        return F.coalesce(current_date_text(F.lit(part), as_of), parse_date(F.lit(part)))

    return end(first), end(last or first)
