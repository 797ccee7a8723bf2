"""Calendar and working-time arithmetic as closed-form column expressions.

Differences count *boundary crossings*: 00:00:59 to 00:01:01 is one minute, Friday to the
following Monday is one (Sunday-started) week.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.columns import c

SUNDAY_ZERO = "1970-01-04"  # the first Sunday after the epoch


def day(ts: Column | str) -> Column:
    return F.to_date(c(ts))


def month(ts: Column | str) -> Column:
    return F.trunc(c(ts), "month")


def week_monday(ts: Column | str) -> Column:
    return F.trunc(c(ts), "week")


def ntz(x: Column | str) -> Column:
    return c(x).cast("timestamp_ntz")


def epoch_s(ts: Column | str) -> Column:
    return F.unix_seconds(c(ts).cast("timestamp"))


def epoch_us(ts: Column | str) -> Column:
    return F.unix_micros(c(ts).cast("timestamp"))


def day_number(ts: Column | str) -> Column:
    return F.unix_date(day(ts))


def month_number(ts: Column | str) -> Column:
    return F.year(c(ts)) * 12 + F.month(c(ts)) - 1


def sunday_week_number(ts: Column | str) -> Column:
    return F.floor(F.datediff(day(ts), F.lit(SUNDAY_ZERO).cast("date")) / F.lit(7)).cast("int")


_INDEX = {
    "second": epoch_s,
    "minute": lambda x: F.floor(epoch_s(x) / F.lit(60)),
    "hour": lambda x: F.floor(epoch_s(x) / F.lit(3600)),
    "day": day_number,
    "week": sunday_week_number,
    "month": month_number,
    "quarter": lambda x: F.year(c(x)) * 4 + F.quarter(c(x)) - 1,
    "year": lambda x: F.year(c(x)),
}


def boundary_diff(start: Column | str, end: Column | str, part: str) -> Column:
    index = _INDEX[part]
    return (index(end) - index(start)).cast("long")


def add_part(ts: Column | str, n: Column | int, part: str) -> Column:
    """ts + n parts, n may be a column; the result is a timestamp without zone."""
    n = n if isinstance(n, Column) else F.lit(n)
    base = ntz(ts)
    n = n.cast("int")
    zero = F.lit(0)
    if part in ("second", "minute", "hour"):
        scale = {"second": 1, "minute": 60, "hour": 3600}[part]
        secs = (n.cast("long") * scale).cast("decimal(18,6)")
        return base + F.make_dt_interval(zero, zero, zero, secs)
    if part in ("day", "week"):
        days = n * (7 if part == "week" else 1)
        return base + F.make_dt_interval(days, zero, zero, zero)
    months = n * {"month": 1, "quarter": 3, "year": 12}[part]
    return base + F.make_ym_interval(zero, months)


def last_day_of(ts: Column | str, part: str) -> Column:
    months = {"month": 1, "quarter": 3, "year": 12}[part]
    start = F.trunc(c(ts), part)
    return F.date_sub(F.add_months(start, months), 1)


def iso_dow(ts: Column | str) -> Column:
    """Monday 1 .. Sunday 7."""
    return F.weekday(day(ts)) + 1


def is_weekend(ts: Column | str) -> Column:
    return F.weekday(day(ts)) >= 5


def weekdays_between(start: Column | str, end: Column | str) -> Column:
    """Monday-Friday midnights crossed: day boundaries minus weekend-day boundaries."""
    return boundary_diff(start, end, "day") - weekend_days_between(start, end)


def weekend_days_between(start: Column | str, end: Column | str) -> Column:
    """Sundays after the start day plus Saturdays from the start day on, both up to the end day."""
    first = F.datediff(day(start), F.lit(SUNDAY_ZERO).cast("date"))
    last = F.datediff(day(end), F.lit(SUNDAY_ZERO).cast("date"))
    sundays = F.floor(last / F.lit(7)) - F.floor(first / F.lit(7))
    saturdays = F.floor((last + 1) / F.lit(7)) - F.floor(first / F.lit(7))
    return (sundays + saturdays).cast("long")


def snap_to_opening(ts: Column | str, open_hour: int = 9, close_hour: int = 18) -> Column:
    """Move an off-hours timestamp forward to the next opening time of a working day."""
    ts = ntz(ts)
    d = day(ts)
    hour = F.hour(ts)
    dow = F.weekday(d)
    closed_today = (dow >= 5) | (hour >= close_hour)
    days_ahead = F.when(dow == 4, 3).when(dow == 5, 2).when(dow == 6, 1).otherwise(1)
    opening = add_part(F.when(closed_today, F.date_add(d, days_ahead)).otherwise(d), open_hour, "hour")
    return F.when((dow < 5) & (hour >= open_hour) & (hour < close_hour), ts).otherwise(opening)


def business_minutes(start: Column | str, end: Column | str, open_hour: int = 9, close_hour: int = 18) -> Column:
    """Working minutes between two timestamps that already lie inside working hours."""
    closed = 24 - (close_hour - open_hour)
    off_hours = weekdays_between(start, end) * closed + weekend_days_between(start, end) * 24
    return boundary_diff(start, end, "minute") - off_hours * 60
