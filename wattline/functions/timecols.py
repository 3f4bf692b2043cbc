"""Time rules as column expressions.

All functions take and return columns, so they stay inside whole-stage code generation and fold
to constants on literals. They read wall-clock fields in the session zone; the jobs run in UTC.
Nothing reads the clock: "today" is always an ``as_of`` argument.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS = "yyyy-MM-dd HH:mm:ss"
MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"


def interval(days: int = 0, hours: int = 0, minutes: int = 0, seconds: int = 0) -> Column:
    """A constant day-time interval."""
    return F.make_dt_interval(*(F.lit(n) for n in (days, hours, minutes, seconds)))


# -- parse and format ---------------------------------------------------------------------------


def parse(text: Column, fmt: str = SECONDS) -> Column:
    return F.to_timestamp(text, fmt)


def parse_millis(text: Column, fmt: str = SECONDS) -> Column:
    """Text to epoch milliseconds."""
    return F.unix_millis(F.to_timestamp(text, fmt).cast("timestamp"))


def format_millis(millis: Column, fmt: str = SECONDS) -> Column:
    """Epoch milliseconds (number or numeric text) to text."""
    return F.date_format(F.timestamp_millis(millis.cast("bigint")), fmt)


def format_time(ts: Column, fmt: str = SECONDS) -> Column:
    return F.date_format(ts, fmt)


def reformat(text: Column, source: str, target: str) -> Column:
    return F.date_format(F.to_timestamp(text, source), target)


# -- shift and floor ----------------------------------------------------------------------------


def shift(ts: Column, days: int = 0, hours: int = 0, minutes: int = 0, seconds: int = 0) -> Column:
    return ts + interval(days, hours, minutes, seconds)


def shift_hours_zero_minute(ts: Column, hours: int) -> Column:
    """Shift by hours and set the minute to zero; the seconds stay."""
    moved = shift(ts, hours=hours)
    return moved - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(moved))


def shift_minutes_zero_second(ts: Column, minutes: int) -> Column:
    return F.date_trunc("minute", shift(ts, minutes=minutes))


def next_minute(ts: Column) -> Column:
    return shift_minutes_zero_second(ts, 1)


def next_ten_minutes(ts: Column) -> Column:
    """Ten minutes on with zero seconds; not rounded to a multiple of ten."""
    return shift_minutes_zero_second(ts, 10)


def next_hour(ts: Column) -> Column:
    return F.date_trunc("hour", shift(ts, hours=1))


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def minute_floor(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def epoch_minute(millis: Column) -> Column:
    """Milliseconds to whole minutes, toward zero."""
    return F.call_function("div", millis, F.lit(60000))


# -- keys ---------------------------------------------------------------------------------------


def dashed_time_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH-mm-ss")


def dashed_hour_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH")


def compact_hour_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHH")


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


# -- differences and comparisons ----------------------------------------------------------------


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def whole_hours_between(start: Column, end: Column) -> Column:
    """Whole hours toward zero."""
    return F.timestamp_diff("HOUR", start, end)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def days_since_anniversary(month: Column, day: Column, as_of: Column) -> Column:
    """Days from the latest occurrence of a month and day up to ``as_of``; 29 February of a
    common year counts as 1 March."""

    def occurrence(year: Column) -> Column:
        return F.date_add(F.make_date(year, month, F.lit(1)), day - 1)

    this_year = occurrence(F.year(as_of))
    return F.when(this_year <= F.to_date(as_of), F.datediff(as_of, this_year)).otherwise(
        F.datediff(as_of, occurrence(F.year(as_of) - 1))
    )


def within(ts: Column, start: Column, end: Column) -> Column:
    """Inclusive range test; false when anything is null."""
    return F.coalesce(ts.between(start, end), F.lit(False))


def not_after(start: Column, end: Column) -> Column:
    return start <= end


def before(start: Column, end: Column) -> Column:
    return start < end


# -- business days ------------------------------------------------------------------------------


def day_ending(ts: Column, cut_hour: int = 11) -> Column:
    """The date whose ``cut_hour`` ends the business day: strictly after hh:00:00 is the next date.

    Times count by whole seconds, so the day of second hh:00:01 starts at midnight once the time
    is moved forward by one second less than the rest of the day.
    """
    return F.to_date(ts + interval(hours=23 - cut_hour, minutes=59, seconds=59))


def day_starting(ts: Column, cut_hour: int = 12) -> Column:
    """The date whose ``cut_hour`` starts the business day: up to hh:00:00 is the previous date."""
    return F.to_date(ts - interval(hours=cut_hour, seconds=1))


def in_day_of(ts: Column, as_of: Column, cut_hour: int = 12) -> Column:
    """Strictly between the cut of the day before ``as_of`` and the cut of ``as_of``."""
    whole = F.date_trunc("second", ts)
    return (whole > cut_of(as_of, cut_hour, -1)) & (whole < cut_of(as_of, cut_hour))


def cut_of(day: Column, cut_hour: int, days: int = 0) -> Column:
    """The cut hour of a day, ``days`` later."""
    return F.date_trunc("day", day) + interval(days=days, hours=cut_hour)


def day_range(day: Column, cut_hour: int = 12) -> tuple[Column, Column]:
    """Half-open bounds of the day that ends at ``cut_hour`` of ``day``."""
    return cut_of(day, cut_hour, -1), cut_of(day, cut_hour)


# -- lists --------------------------------------------------------------------------------------


def dates_between(start: Column, end: Column, repeat_start: bool = False) -> Column:
    """Every date from start to end, each once; empty when start is after end.

    ``repeat_start`` gives the list with its start twice, and just both ends when start is not
    before end.
    """
    first, last = F.to_date(start), F.to_date(end)
    inner = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
    if not repeat_start:
        return inner
    return F.when(first < last, F.concat(F.array(first), inner)).otherwise(F.array(first, last))


def hours_of_day(day: Column) -> Column:
    """24 hour keys of a booking day: 13:00 up to 12:00 of the next date."""
    midnight = F.to_date(day).cast("timestamp")
    return F.sequence(shift(midnight, hours=13), shift(midnight, hours=36), interval(hours=1))


def steps_between(start: Column, end: Column, step: Column) -> Column:
    """start + step, start + 2 step, ... strictly before end; empty when there is none."""
    first = start + step
    return F.when(
        first < end, F.filter(F.sequence(first, end, step), lambda t: t < end)
    ).otherwise(F.array().cast("array<timestamp>"))


def hours_after(start: Column, count: Column) -> Column:
    """start + 1 h ... start + count h; empty when count is below one."""
    return F.when(
        count > 0,
        F.sequence(
            start + interval(hours=1), start + F.make_dt_interval(F.lit(0), count), interval(hours=1)
        ),
    ).otherwise(F.array().cast("array<timestamp>"))


def past_days(day: Column, count: int) -> Column:
    """``count`` dates, newest first, starting with ``day``."""
    first = F.to_date(day)
    return F.sequence(first, F.date_sub(first, count - 1), F.expr("interval -1 day"))


def past_hours(ts: Column, count: int, every: int = 1) -> Column:
    """``count`` times, newest first, ``every`` hours apart, starting with ``ts``."""
    return F.sequence(ts, shift(ts, hours=-(count - 1) * every), interval(hours=-every))
