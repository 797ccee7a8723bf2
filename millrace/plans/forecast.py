"""Revenue forecasts from run rates and recognition delays. Amounts are whole cents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import ladder, sum_when
from millrace.functions.dates import add_part, boundary_diff, day, month
from millrace.operators.selection import exact_percentiles
from millrace.sources.session import cut_lineage

# Days of run rate, working days in them, share of sourced value that survives, months of recognition history.
RUN_RATE_DAYS, RUN_RATE_WORKDAYS, SURVIVAL = 42, 30, 0.98
HISTORY_FROM, HISTORY_TO = 15, 3
# Fixed values of the large-deal forecast: months of delay history, lead beyond the promise, look-ahead months.
DELAY_MONTHS, PROMISE_SLACK_DAYS, LOOK_AHEAD_MONTHS = 9, 7, 3


def now(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def whole(x: Column) -> Column:
    """Round half up to a whole cent: sums of the result do not depend on their order."""
    return F.floor(x + 0.5)


def on_business_days(df: DataFrame, first: Column, last: Column, holidays: DataFrame, out: str) -> DataFrame:
    """Every row once per working day of a range; the days are generated inside the row."""
    days = df.withColumn(out, F.explode(F.sequence(first, last, F.expr("interval 1 day")))).filter(F.weekday(out) < 5)
    return days.join(holidays.select(F.col("date").alias("_h")), F.col(out) == F.col("_h"), "left_anti")


def revenue_forecast(orders: DataFrame, holidays: DataFrame, as_of: str, large_cents: int) -> DataFrame:
    """Recognised revenue per day and segment: orders already sourced, orders still expected, and large deals as they are.

    orders: lead_time, technology, region, sourced_at, recognized_at, subtotal_cents, recognized_cents. Orders shrink to
    sums per sourcing day and segment before the recognition delays multiply them.
    """
    segment = ["lead_time", "technology", "region"]
    today = day(now(as_of))
    this_month = F.trunc(today, "month")
    sourced = orders.filter("sourced_at is not null").withColumn("sourced_day", day("sourced_at"))
    small = sourced.filter(F.col("subtotal_cents") < large_cents)
    lately = small.filter((F.col("sourced_day") >= F.date_sub(today, RUN_RATE_DAYS)) & (F.col("sourced_day") < today) & (F.weekday("sourced_day") < 5))
    rate = lately.groupBy(*segment).agg((F.sum("subtotal_cents") / F.lit(RUN_RATE_WORKDAYS)).alias("rate"))
    last = F.date_sub(F.trunc(F.add_months(today, 12), "month"), 1)
    expected = on_business_days(rate, today, last, holidays, "sourced_day").withColumnRenamed("rate", "amount")

    past = small.filter((F.col("sourced_at") >= add_part(now(as_of), -HISTORY_FROM, "month")) & (F.col("sourced_at") < add_part(now(as_of), -HISTORY_TO, "month")))
    lag = boundary_diff("sourced_at", "recognized_at", "day")
    delays = past.groupBy(*segment, lag.alias("lag_days")).agg(F.sum("subtotal_cents").alias("_sourced"), F.sum("recognized_cents").alias("_recognized"))
    share = F.col("_sourced") / F.sum("_sourced").over(Window.partitionBy("technology", "lead_time"))
    leakage = F.col("_recognized") / F.nullif("_sourced", F.lit(0))
    delays = delays.select(F.col("lead_time").alias("_lead"), F.col("technology").alias("_tech"), "lag_days", (share * leakage).alias("share"))
    delays = cut_lineage(delays, "recognition-delays")

    def spread(df: DataFrame) -> DataFrame:
        joined = df.join(delays, (F.col("lead_time") == F.col("_lead")) & (F.col("technology") == F.col("_tech")), "left")
        joined = joined.filter(F.trunc(F.date_add("sourced_day", F.col("lag_days").cast("int")), "month") >= this_month)
        at = F.date_add("sourced_day", F.coalesce("lag_days", F.col("lead_time") + 7).cast("int"))
        value = whole(F.col("amount") * F.coalesce("share", F.lit(1.0)) * F.lit(SURVIVAL))
        return joined.withColumns({"recognized_on": at, "_value": value})

    def summed(df: DataFrame, kind: str) -> DataFrame:
        return df.groupBy("recognized_on", *segment).agg(F.sum("_value").alias("cents")).withColumn("kind", F.lit(kind))

    booked = small.groupBy(*segment, "sourced_day").agg(F.sum("subtotal_cents").alias("amount"))
    large = sourced.filter((F.col("subtotal_cents") >= large_cents) & (month("recognized_at") >= this_month))
    large = large.withColumns({"recognized_on": day("recognized_at"), "_value": F.col("recognized_cents")})
    return reduce(DataFrame.unionByName, [
        summed(spread(booked).filter("share > 0"), "sourced"), summed(spread(expected), "expected"), summed(large, "large deals"),
    ])


def delay_statistics(orders: DataFrame, as_of: str, large_cents: int) -> DataFrame:
    """Per technology: mean, and high (median + deviation), recognition delay of large deals over the latest months with data."""
    due = orders.filter((F.col("subtotal_cents") >= large_cents) & F.col("closed_at").isNotNull())
    due = due.filter(F.col("promised_at") <= add_part(now(as_of), -PROMISE_SLACK_DAYS, "day"))
    late = F.abs(boundary_diff("promised_at", F.coalesce("recognized_at", now(as_of)), "day"))
    dated = due.select("technology", month("promised_at").alias("_m"), late.alias("late_days"))
    months = dated.select("technology", "_m").distinct()
    rank = F.row_number().over(Window.partitionBy("technology").orderBy(F.col("_m").desc()))
    recent = dated.join(months.withColumn("_r", rank).filter(F.col("_r") <= DELAY_MONTHS).select("technology", "_m"), ["technology", "_m"])
    facts = {"stddev": F.round(F.stddev_samp("late_days"), 4), "mean": F.sum("late_days") / F.count(F.lit(1))}
    spread = exact_percentiles(cut_lineage(recent.select("technology", "late_days"), "delays"), ["technology"], "late_days", {"median": 0.5}, facts)
    high = F.floor(F.col("median") + 0.5) + F.floor(F.col("stddev") + 0.5)
    return spread.select(
        "technology", F.floor("mean").cast("int").alias("mean_delay"), F.coalesce(high, F.floor(F.col("median") + 0.5)).cast("int").alias("high_delay")
    )


def scenario_dates(start: Column, as_of: str, slack: Column) -> dict[str, Column]:
    """First future date per scenario: optimistic tries the plan, the mean delay, the high delay; medium the last two; low the last."""
    at = {"plan": slack, "mean": F.date_add(start, F.col("mean_delay")), "high": F.date_add(start, F.col("high_delay"))}
    today = day(now(as_of))

    def first(*names: str) -> Column:
        return ladder([(at[n] >= today, at[n]) for n in names])

    return {"1 high": first("plan", "mean", "high"), "2 medium": first("mean", "high"), "3 low": first("high")}


def stacked(df: DataFrame, kind: str) -> DataFrame:
    """Monthly sums per scenario, as the steps between the scenarios."""
    sums = df.groupBy("month").agg(*[sum_when(F.col("scenario") == s, "cents").alias(n) for s, n in (("1 high", "_h"), ("2 medium", "_m"), ("3 low", "_l"))])
    h, m, low = (F.coalesce(n, F.lit(0)) for n in ("_h", "_m", "_l"))
    return sums.select(
        "month", F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("base"), F.when(h > m + low, h - m - low).otherwise(0).alias("high"),
        F.when(m > low, m - low).otherwise(0).alias("medium"), low.alias("low"),
    )


def large_deal_forecast(orders: DataFrame, base: DataFrame, as_of: str, large_cents: int) -> DataFrame:
    """Monthly base forecast, and large deals sold and expected in three scenarios.

    orders: technology, lead_time, promised_at, closed_at, sourced_at, recognized_at, subtotal_cents; base: recognized_on, cents.
    """
    delays = cut_lineage(delay_statistics(orders, as_of, large_cents), "delays")
    large = orders.filter(F.col("subtotal_cents") >= large_cents)

    def by_scenario(df: DataFrame, start: Column, slack: Column, kind: str) -> DataFrame:
        dates = scenario_dates(start, as_of, slack)
        each = F.array(*[F.struct(F.lit(s).alias("scenario"), F.trunc(d, "month").alias("month")) for s, d in dates.items()])
        rows = df.join(delays, "technology", "left").select("cents", F.inline(each))
        return stacked(rows.groupBy("month", "scenario").agg(F.sum("cents").alias("cents")), kind)

    unsold = large.filter((F.col("sourced_at") >= add_part(now(as_of), -24, "month")) & F.col("recognized_at").isNull())
    promised = day("promised_at")
    open_deals = unsold.groupBy("technology", promised.alias("start")).agg(F.sum("subtotal_cents").alias("cents"))
    sold = by_scenario(open_deals, F.col("start"), F.date_add("start", PROMISE_SLACK_DAYS), "sold")
    this_month = F.trunc(day(now(as_of)), "month")
    half_year = large.filter((promised >= F.add_months(this_month, -6)) & (promised < this_month))
    rate = half_year.groupBy("technology", "lead_time").agg(whole(F.sum("subtotal_cents") / F.lit(6)).alias("cents"))
    months = F.sequence(this_month, F.add_months(this_month, LOOK_AHEAD_MONTHS - 1), F.expr("interval 1 month"))
    coming = rate.withColumn("_m", F.explode(months)).withColumn("start", F.date_add("_m", (F.col("lead_time") + 21).cast("int")))
    forecast = by_scenario(coming, F.col("start"), F.col("start"), "forecast")
    known = base.groupBy(F.trunc("recognized_on", "month").alias("month")).agg(F.sum("cents").alias("base"))
    zero = F.lit(0).cast("long")
    known = known.select("month", F.lit("base").alias("kind"), "base", zero.alias("high"), zero.alias("medium"), zero.alias("low"))
    return known.unionByName(forecast).unionByName(sold)
