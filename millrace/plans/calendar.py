"""Working-time calendar and durations in business minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import add_part, boundary_diff, business_minutes, day
from millrace.operators.ordered import backward_fill
from millrace.operators.spines import spine_per_row

OPEN_HOUR, CLOSE_HOUR = 9, 18


def working_days(first: Column, last: Column, bounds: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per day of a range with the day itself or the next one on which work is done.

    The range comes from a one-row frame; a few weeks beyond its end are added so that the last days have a successor.
    """
    span = bounds.select(day(first).cast("timestamp_ntz").alias("a"), add_part(day(last), 30, "day").alias("b"))
    days = spine_per_row(span, "a", "b", "day", "at").select(day("at").alias("date"))
    closed = holidays.select(F.col("date").alias("_holiday"))
    days = days.join(closed, F.col("date") == F.col("_holiday"), "left")
    works = (F.weekday("date") < 5) & F.col("_holiday").isNull()
    days = days.select("date", works.alias("is_working_day"), F.when(works, F.col("date")).alias("_open"))
    days = backward_fill(days, [], ["date"], "_open", "_this_or_next", F.trunc("date", "month"))
    after = days.select(F.date_sub("date", 1).alias("_before"), F.col("_this_or_next").alias("next_working_day"))
    return days.join(after, F.col("date") == F.col("_before"), "left").select("date", "is_working_day", "next_working_day")


def opening(is_working: Column, this_day: Column, next_day: Column, ts: Column) -> Column:
    """The timestamp itself inside working hours, else the next opening."""
    hour = F.hour(ts)
    inside = is_working & (hour >= OPEN_HOUR) & (hour < CLOSE_HOUR)
    early = is_working & (hour < OPEN_HOUR)
    return F.when(inside, ts).otherwise(add_part(F.when(early, this_day).otherwise(next_day), OPEN_HOUR, "hour"))


def business_calendar(events: DataFrame, ts: str, holidays: DataFrame) -> DataFrame:
    """Every hour between the first and last event day: is it a business hour, which business hour comes next, how many events fell into it."""
    bounds = events.agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    days = working_days(F.col("a"), F.col("b"), bounds, holidays)
    hours = days.withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn("date_hour", add_part("date", F.col("_h"), "hour"))
    start = opening(F.col("is_working_day"), F.col("date"), F.col("next_working_day"), F.col("date_hour"))
    hours = hours.select("date_hour", start.alias("business_hour")).withColumn("is_business_hour", F.col("business_hour") == F.col("date_hour"))
    counts = events.groupBy(add_part(day(ts), F.hour(ts), "hour").alias("_hour")).agg(F.count(F.lit(1)).alias("n"))
    joined = hours.join(counts, F.col("date_hour") == F.col("_hour"), "left")
    last_day = events.agg(F.to_date(F.max(ts))).scalar()
    return joined.filter(day("date_hour") <= last_day).select("date_hour", "business_hour", "is_business_hour", F.coalesce("n", F.lit(0)).alias("n_events"))


def snap_to_business_hours(df: DataFrame, cols: dict[str, str], days: DataFrame) -> DataFrame:
    """out -> timestamp column: moved forward to the next business hour when it lies outside."""
    for out, col in cols.items():
        side = days.select(F.col("date").alias("_date"), "is_working_day", "next_working_day")
        joined = df.withColumn("_day", day(col)).join(side, F.col("_day") == F.col("_date"), "left")
        df = joined.withColumn(out, opening(F.col("is_working_day"), F.col("_day"), F.col("next_working_day"), F.col(col)))
        df = df.drop("_day", "_date", "is_working_day", "next_working_day")
    return df


def business_minutes_job(intervals: DataFrame, start: str, end: str, holidays: DataFrame) -> DataFrame:
    """Plain and working minutes of every interval; both ends move to business hours first."""
    bounds = intervals.agg(F.min(start).alias("a"), F.max(end).alias("b"))
    days = working_days(F.col("a"), F.col("b"), bounds, holidays)
    snapped = snap_to_business_hours(intervals, {"business_start": start, "business_end": end}, days)
    return snapped.withColumns({
        "minutes": boundary_diff(start, end, "minute"),
        "business_minutes": business_minutes("business_start", "business_end", OPEN_HOUR, CLOSE_HOUR),
    })
