"""Hours: parsing, summing, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DayTimeIntervalType, NumericType, StringType, TimestampNTZType

from wrenchline.functions.text import SPACE, number

# Sums go through a decimal, so the result does not depend on how rows are
# spread over partitions. Four places are a third of a second.
_SUM_TYPE = "decimal(28,8)"
_SUM_PLACES = 4

# "[n day[s]] [+]hh:mm:ss[.fff]"; hours and minutes alone are not a time.
_CLOCK = (
    rf"(?i)^[{SPACE}]*[+-]?(?:(\d+)\s*(?:days?|d),?\s*)?"
    rf"\+?(\d+):(\d{{1,2}}):(\d{{1,2}}(?:\.\d+)?)[{SPACE}]*$"
)


def minutes_to_hours(minutes: Column, dtype: DataType | None = None) -> Column:
    """Planned minutes to hours; null and unreadable values are 0."""
    return F.coalesce(number(minutes, dtype, digit_groups=True), F.lit(0.0)) / F.lit(60.0)


def as_decimal(hours: Column) -> Column:
    """Hours as a decimal; null where they do not fit, which ``quality.oversized_hours`` lists."""
    return hours.try_cast(_SUM_TYPE)


def decimal_sum(hours: Column) -> Column:
    return F.sum(as_decimal(hours))


def rounded(total: Column) -> Column:
    """Decimal total to a double with the places every hour total carries."""
    return F.round(total, _SUM_PLACES).cast("double")


def hours_sum(hours: Column) -> Column:
    """Order-independent sum of hours; 0 for no rows."""
    return F.coalesce(rounded(decimal_sum(hours)), F.lit(0.0))


def hours_to_hhmm(hours: Column) -> Column:
    """``HH:MM`` with half-even minutes; negative is ``00:00``, hours may exceed 99."""
    minutes = F.rint(hours * 60).try_cast("bigint")
    hour, minute = F.call_function("div", minutes, F.lit(60)), minutes % 60
    # At least two digits; lpad would cut longer hours and a formatter is slow.
    pad = lambda n: F.concat(F.when(n < 10, "0").otherwise(""), n.cast("string"))
    text = F.concat(pad(hour), F.lit(":"), pad(minute))
    return F.when(hours < 0, "00:00").when(hours.isNotNull(), text)


def time_to_hours(value: Column, dtype: DataType | None = None) -> Column:
    """Spreadsheet time cell to hours.

    Intervals give their length, numbers between 0 and 1 are a share of a day,
    other numbers are hours already, clock texts are parsed, all else is 0.
    """
    if isinstance(dtype, DayTimeIntervalType):
        seconds = value.cast("interval second").cast("decimal(20,6)").cast("double")
        return F.coalesce(seconds / 3600.0, F.lit(0.0))
    if isinstance(dtype, NumericType):
        plain = number(value, dtype)
        share = (plain > 0) & (plain < 1)
        return F.coalesce(F.when(share, plain * 24.0).otherwise(plain), F.lit(0.0))

    text = value.cast("string")

    def part(group: int) -> Column:
        # The zero in front keeps absent parts readable: a failing cast is slow.
        digits = F.concat(F.lit("0"), F.regexp_extract(text, _CLOCK, group))
        return digits.try_cast("double")

    def sign(pattern: str) -> Column:
        return F.when(text.rlike(pattern), -1.0).otherwise(1.0)

    # A sign before days belongs to the days: "-1 days 02:00:00" is -22 hours.
    # Texts that are no time have only empty parts and give 0.
    days = part(1) * 86400.0 * sign(rf"^[{SPACE}]*-")
    clock = (part(2) * 3600.0 + part(3) * 60.0 + part(4)) * sign(rf"^[{SPACE}]*-\d+:")
    return F.coalesce((days + clock) / 3600.0, F.lit(0.0))


# Day texts beside the ISO form; month first, as spreadsheets in US format write.
_DAY_FORMATS = ("M/d/yyyy[ H:mm[:ss]]", "d-MMM-yyyy[ H:mm[:ss]]", "d MMM yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]")


def to_timestamp(value: Column, dtype: DataType) -> Column:
    """Date and time without a zone; null where a text is no date."""
    if isinstance(dtype, TimestampNTZType):
        return value
    if not isinstance(dtype, StringType):
        return value.try_cast("timestamp_ntz")
    others = [F.try_to_timestamp(value, F.lit(f)).cast("timestamp_ntz") for f in _DAY_FORMATS]
    return F.coalesce(value.try_cast("timestamp_ntz"), *others)


def inclusive_days(start: Column, end: Column) -> Column:
    """Elapsed 24 h blocks + 1, rounded down also for negative spans.

    Calendar days apart, less one when the last of them is not complete; works
    on zone-free timestamps whatever the session time zone is.
    """
    apart = F.date_diff(end, start)
    incomplete = end < start + F.make_dt_interval(days=apart)
    return (apart + 1 - F.when(incomplete, 1).otherwise(0)).cast("int")
