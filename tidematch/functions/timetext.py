"""Dates as text, parts of dates, and window labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text patterns messages use.
SECONDS = "yyyy-MM-dd HH:mm:ss"
MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
COMPACT_SECONDS = "yyyyMMddHHmmss"
COMPACT_DAY = "yyyyMMdd"


def parse_time(text: Column, pattern: str = SECONDS) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def format_time(time: Column, pattern: str = SECONDS) -> Column:
    return F.date_format(time, pattern)


def now_text(pattern: str = SECONDS) -> Column:
    return F.date_format(F.current_timestamp(), pattern)


def minute_parity(time: Column) -> Column:
    """'0' in even minutes, '1' in odd ones: the switch between the two faces of
    a user's position."""
    return (F.minute(time) % 2).cast("string")


def minute_parity_of_text(text: Column) -> Column:
    return minute_parity(parse_time(text))


def current_minute() -> Column:
    return F.date_format(F.current_timestamp(), "mm")


def current_period() -> Column:
    """Parity of the current minute, one value per batch or micro-batch."""
    return minute_parity(F.current_timestamp())


def _compact_day(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit(COMPACT_DAY)))


def days_between(start: Column, end: Column) -> Column:
    """Days from one yyyyMMdd text to another."""
    return F.datediff(_compact_day(end), _compact_day(start)).cast("long")


def period_between(start: Column, end: Column) -> Column:
    """Calendar years, months and days from one date to another; all parts are
    negative or zero when ``end`` is the earlier one."""
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    day_gap = F.dayofmonth(end) - F.dayofmonth(start)
    unfinished = (months > 0) & (day_gap < 0)
    overdone = (months < 0) & (day_gap > 0)
    whole = F.when(unfinished, months - 1).when(overdone, months + 1).otherwise(months)
    days = (
        F.when(unfinished, F.datediff(end, F.add_months(start, whole)))
        .when(overdone, day_gap - F.dayofmonth(F.last_day(end)))
        .otherwise(day_gap)
    )
    return F.struct(
        (whole / 12).cast("int").alias("years"),
        (whole % 12).alias("months"),
        days.alias("days"),
    )


def period_until_today(start: Column) -> Column:
    return period_between(start, F.current_date())


def window_label(start: Column, end: Column) -> Column:
    return F.format_string(
        "start: %s end:%s", format_time(start), format_time(end)
    )


def epoch_micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))
