"""Data-quality checks. Each returns the failing rows (or groups); an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import is_true
from millrace.functions.dates import add_part, boundary_diff
from millrace.operators.joins import full_outer_reconcile
from millrace.operators.ordered import lag_delta, lead_values


def _where(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.filter(condition)


def _counts(**frames: DataFrame) -> DataFrame:
    """One row with a row count per frame, from one tagged union (no join of the counts)."""
    tagged = reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("_t")) for name, df in frames.items()])
    return tagged.agg(*[F.count(F.when(F.col("_t") == name, 1)).alias(name) for name in frames])


def dq_unique(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    kept = _where(df, where).filter(F.col(col).isNotNull())
    return kept.groupBy(col).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def dq_not_null(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    return _where(df, where).filter(F.col(col).isNull())


def dq_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Values outside the list, with their row counts; null is accepted."""
    counted = df.filter(~F.col(col).isin(values)).groupBy(F.col(col).alias("value"))
    return counted.agg(F.count(F.lit(1)).alias("n_records"))


def dq_not_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    counted = df.filter(F.col(col).isin(values)).groupBy(F.col(col).alias("value"))
    return counted.agg(F.count(F.lit(1)).alias("n_records"))


def dq_accepted_range(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the range; nulls are not judged."""
    x = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | ((x < lo) if inclusive else (x <= lo))
    if hi is not None:
        bad = bad | ((x > hi) if inclusive else (x >= hi))
    return df.filter(bad)


def dq_at_least_one(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(col).alias("n_values")).filter("n_values = 0")


def dq_not_constant(df: DataFrame, col: str) -> DataFrame:
    """min and max decide: no distinct set is built."""
    ends = df.agg(F.min(col).alias("lowest"), F.max(col).alias("highest"))
    return ends.filter(F.col("lowest") == F.col("highest")).select(F.lit(1).cast("long").alias("n_distinct"))


def dq_not_null_proportion(df: DataFrame, col: str, at_least: float, at_most: float = 1.0) -> DataFrame:
    share = df.agg((F.count(col) / F.count(F.lit(1))).alias("not_null_proportion"))
    return share.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def dq_expression_is_true(df: DataFrame, expression: Column, condition: Column | None = None) -> DataFrame:
    """Rows where the expression is false (unknown passes)."""
    return _where(df, condition).filter(~expression)


def dq_unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def dq_relationships_where(
    df: DataFrame, col: str, to: DataFrame, field: str, from_condition: Column | None = None, to_condition: Column | None = None
) -> DataFrame:
    """Child values without a parent, among the rows the conditions select."""
    child = _where(df, from_condition).filter(F.col(col).isNotNull()).select(F.col(col).alias("id"))
    parent = _where(to, to_condition).select(F.col(field).alias("_parent"))
    return child.join(parent, F.col("id") == F.col("_parent"), "left_anti")


def dq_cardinality_equality(df: DataFrame, col: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose row counts differ between the two tables; one row per differing side."""
    a = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    b = to.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    return a.subtract(b).unionAll(b.subtract(a))


def dq_equality(a: DataFrame, b: DataFrame, cols: list[str], keep_repeats: bool = False) -> DataFrame:
    """Rows of either table that the other lacks, with the side. One shuffle: counts per row and side."""
    tagged = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(b.select(*cols, F.lit(0), F.lit(1)))
    sides = tagged.groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    if keep_repeats:
        differs = sides.filter("_a <> _b").withColumn("n", F.abs(F.col("_a") - F.col("_b")).cast("int"))
        differs = differs.withColumn("_i", F.explode(F.sequence(F.lit(1), "n")))
    else:
        differs = sides.filter("(_a = 0) <> (_b = 0)")
    side = F.when(F.col("_a") > F.col("_b"), "a_minus_b").otherwise("b_minus_a")
    return differs.select(side.alias("which_diff"), *cols)


def dq_equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    out = _counts(count_a=a, count_b=b).withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))
    return out.filter("diff_count > 0")


def dq_fewer_rows_than(df: DataFrame, other: DataFrame) -> DataFrame:
    """Fails with the surplus, or with 1 when the counts are equal."""
    out = _counts(count_ours=df, count_other=other)
    gap = F.col("count_ours") - F.col("count_other")
    delta = F.when(gap > 0, gap).when(gap == 0, F.lit(1)).otherwise(F.lit(0))
    return out.withColumn("row_count_delta", delta).filter("row_count_delta > 0")


def dq_mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: list[str], chunk: Column | None, gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are empty, inverted, overlap the next one, or break the gap rule.

    ``chunk`` spreads a long partition over tasks (see operators.ordered); UNCHUNKED sorts each partition in one.
    """
    k = list(partition_by)
    nxt = lead_values(df, k, [lower, upper], {"next_lower": lower}, chunk)
    length_ok = F.col(lower) <= F.col(upper) if zero_length_range_allowed else F.col(lower) < F.col(upper)
    follows = {
        "allowed": F.col(upper) <= F.col("next_lower"),
        "not_allowed": F.col(upper) == F.col("next_lower"),
        "required": F.col(upper) < F.col("next_lower"),
    }[gaps]
    succession_ok = F.coalesce(follows, F.col("next_lower").isNull())
    return nxt.filter(~(is_true(length_ok) & is_true(succession_ok)))


def dq_sequential_values(
    df: DataFrame, col: str, partition_by: list[str], chunk: Column | None, interval: int = 1, datepart: str | None = None
) -> DataFrame:
    """Rows that do not follow their predecessor by exactly the interval. ``chunk`` as in dq_mutually_exclusive_ranges."""
    prev = lag_delta(df, list(partition_by), [col], {f"previous_{col}": col}, chunk)
    before = F.col(f"previous_{col}")
    if datepart:
        expected = add_part(before, interval, datepart)
        return prev.filter(F.col(col).cast("timestamp_ntz") != expected)
    return prev.filter(F.col(col) != before + interval)


def dq_recency(df: DataFrame, field: str, datepart: str, interval: int, as_of: str) -> DataFrame:
    newest = df.agg(F.max(field).cast("timestamp_ntz").alias("most_recent"))
    limit = add_part(F.lit(as_of).cast("timestamp_ntz"), -interval, datepart)
    return newest.withColumn("threshold", limit).filter(F.col("most_recent") < F.col("threshold"))


def dq_source_freshness(sources: list[tuple[str, DataFrame, str, int, int]], as_of: str) -> DataFrame:
    """(name, frame, loaded-at column, warn hours, error hours) -> age and status per source."""
    parts = []
    for name, df, loaded_at, warn, error in sources:
        newest = df.agg(F.max(loaded_at).cast("timestamp_ntz").alias("loaded_at"))
        parts.append(newest.select(F.lit(name).alias("source"), "loaded_at", F.lit(warn).alias("warn"), F.lit(error).alias("error")))
    age = boundary_diff("loaded_at", F.lit(as_of).cast("timestamp_ntz"), "hour")
    out = reduce(DataFrame.unionAll, parts).withColumn("age_hours", age)
    status = F.when(F.col("age_hours") > F.col("error"), "error").when(F.col("age_hours") > F.col("warn"), "warn").otherwise("pass")
    return out.select("source", "loaded_at", "age_hours", status.alias("status"))


def dq_daily_amount_sanity(ledger: DataFrame, days: DataFrame) -> DataFrame:
    """Weekdays without a negative cost and a positive revenue: neither side of the ledger moved."""
    daily = ledger.groupBy("date").agg(
        F.sum(F.when(F.col("type") == "cost", F.col("amount"))).alias("cost"),
        F.sum(F.when(F.col("type") == "revenue", F.col("amount"))).alias("revenue"),
    )
    weekdays = days.filter(F.weekday("date") < 5).select(F.col("date").alias("_date"))
    joined = weekdays.join(daily, F.col("_date") == F.col("date"), "left")
    cost, revenue = F.coalesce("cost", F.lit(0)), F.coalesce("revenue", F.lit(0))
    checked = joined.select(F.col("_date").alias("date"), cost.alias("cost"), revenue.alias("revenue"))
    return checked.filter(~((F.col("cost") < 0) | (F.col("revenue") > 0)))


def dq_weekday_freshness(df: DataFrame, ts: str, as_of: str, max_days: int = 2) -> DataFrame:
    """Newest day when it is too old; weekends are not judged."""
    now = F.lit(as_of).cast("date")
    newest = df.agg(F.to_date(F.max(ts)).alias("newest"))
    return newest.filter((F.datediff(now, "newest") > max_days) & (F.weekday(now) < 5))


def closed_month_limit(as_of: str, closing_day: int = 10) -> Column:
    """First day after the last closed month: books close on the tenth."""
    now = F.lit(as_of).cast("date")
    start = F.trunc(now, "month")
    return F.when(F.dayofmonth(now) >= closing_day, start).otherwise(F.add_months(start, -1))


def dq_backup_integrity(
    counts: Mapping[str, tuple[DataFrame, DataFrame, str, float]],
    records: Mapping[str, tuple[DataFrame, DataFrame, str, str, Mapping[str, float | None]]],
    as_of: str,
) -> DataFrame:
    """Production against backup up to the last closed month.

    counts: name -> (production, backup, date column, tolerated share): rows per day.
    records: name -> (production, backup, key, date column, columns with tolerances): row by row.
    """
    limit = closed_month_limit(as_of)
    parts = []
    for name, (prod, backup, ts, share) in counts.items():
        tagged = prod.select(F.to_date(ts).alias("date"), F.lit(1).alias("p"), F.lit(0).alias("b")).unionAll(
            backup.select(F.to_date(ts), F.lit(0), F.lit(1))
        )
        daily = tagged.filter(F.col("date") < limit).groupBy("date").agg(F.sum("p").alias("p"), F.sum("b").alias("b"))
        both = daily.filter("p > 0 and b > 0").filter(F.abs(F.col("b") - F.col("p")) / F.col("b") > share)
        parts.append(both.select(
            F.lit(name).alias("test"), F.col("date").cast("string").alias("identifier"), F.lit("count changed").alias("reason"),
        ))
    for name, (prod, backup, k, ts, cols) in records.items():
        before = F.col(ts) < limit
        diff = full_outer_reconcile(prod.filter(before), backup.filter(before), k, cols)
        parts.append(diff.select(F.lit(name).alias("test"), F.col(k).cast("string").alias("identifier"), "reason"))
    return reduce(DataFrame.unionAll, parts)


def failure_counts(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check, failures) for every check that failed."""
    tagged = reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("check")) for name, df in checks.items()])
    return tagged.groupBy("check").agg(F.count(F.lit(1)).alias("failures"))
