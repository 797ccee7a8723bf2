"""Many checks of one table in one scan.

Every row gives an entry for each check that looks at it: a failing row under its key, a group under its values, or a row counted for a check of the whole table. One
grouping of the entries, combined before the shuffle, then decides all checks. Checks that fail come back with what fails them, as the single checks of ``quality`` find it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import any_of
from millrace.functions.dates import add_part


@dataclass(frozen=True)
class Check:
    """``looks_at``: rows that count; ``key``: columns of a group (None: the row's own key; empty: the whole table); ``fails``: condition on the sums of a group.

    The sums are ``n`` (rows), ``present`` (rows with a value) and ``low`` and ``high`` (bounds of the value as a 64-bit number).
    """

    looks_at: Column
    key: list[str] | None
    fails: Column
    value: Column | None = None
    measure: Column | None = None


def _all() -> Column:
    return F.lit(True)


def unique(cols: list[str], where: Column | None = None) -> Check:
    """Rows where all the columns are null are groups like others when there are several columns; a single null is not judged."""
    known = F.col(cols[0]).isNotNull() if len(cols) == 1 else _all()
    return Check(known if where is None else known & where, cols, F.col("n") > 1)


def not_null(col: str, where: Column | None = None) -> Check:
    bad = F.col(col).isNull()
    return Check(bad if where is None else bad & where, None, _all())


def accepted_values(col: str, values: list) -> Check:
    return Check(~F.col(col).isin(values), [col], _all())


def not_accepted_values(col: str, values: list) -> Check:
    return Check(F.col(col).isin(values), [col], _all())


def accepted_range(col: str, lo=None, hi=None, inclusive: bool = True) -> Check:
    x, bad = F.col(col), [F.lit(False)]
    if lo is not None:
        bad.append((x < lo) if inclusive else (x <= lo))
    if hi is not None:
        bad.append((x > hi) if inclusive else (x >= hi))
    return Check(any_of(bad), None, _all())


def expression_is_true(expression: Column, condition: Column | None = None) -> Check:
    return Check(~expression if condition is None else ~expression & condition, None, _all())


def at_least_one(col: str) -> Check:
    return Check(_all(), [], F.col("present") == 0, F.when(F.col(col).isNotNull(), F.lit(0)), F.col("present").cast("double"))


def not_constant(col: str) -> Check:
    """Values are told apart by a 64-bit hash."""
    return Check(_all(), [], F.col("low") == F.col("high"), F.when(F.col(col).isNotNull(), F.xxhash64(col)), F.lit(1.0))


def not_null_proportion(col: str, at_least: float, at_most: float = 1.0) -> Check:
    share = F.try_divide(F.col("present"), F.col("n"))
    return Check(_all(), [], (share < at_least) | (share > at_most), F.when(F.col(col).isNotNull(), F.lit(0)), share)


def recency(field: str, datepart: str, interval: int, as_of: str) -> Check:
    """The measure is the newest time in seconds since 1970."""
    limit = F.unix_micros(add_part(F.lit(as_of).cast("timestamp_ntz"), -interval, datepart).cast("timestamp"))
    return Check(_all(), [], F.col("high") < limit, F.unix_micros(F.col(field).cast("timestamp")), F.col("high") / 1e6)


def run_checks(df: DataFrame, row_key: list[str], checks: Mapping[str, Check]) -> DataFrame:
    """``check_id``, ``key`` (JSON of the failing row's key or the failing group's values; null for the whole table), ``n_rows`` and ``measure``.

    A check that passes has no row. ``row_key`` names the columns that tell rows apart; rows that share it are one row with their number.
    """
    entries = []
    for name, check in checks.items():
        cols = row_key if check.key is None else check.key
        key = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}) if cols else F.lit(None).cast("string")
        value = F.lit(None).cast("long") if check.value is None else check.value.cast("long")
        entries.append(F.when(check.looks_at, F.struct(F.lit(name).alias("check_id"), key.alias("key"), F.lit(1).cast("long").alias("one"), value.alias("value"))))
    seen = df.select(F.inline(F.array_compact(F.array(*entries))))
    # A check of the whole table is asked of an empty one, too.
    whole = [(name, None, 0, None) for name, check in checks.items() if check.key == []]
    if whole:
        seen = seen.unionAll(df.sparkSession.createDataFrame(whole, "check_id string, key string, one bigint, value bigint"))
    sums = seen.groupBy("check_id", "key").agg(F.sum("one").alias("n"), F.count("value").alias("present"), F.min("value").alias("low"), F.max("value").alias("high"))
    fails, measure = F.lit(False), F.lit(None).cast("double")
    for name, check in checks.items():
        mine = F.col("check_id") == name
        fails = F.when(mine, check.fails).otherwise(fails)
        if check.measure is not None:
            measure = F.when(mine, check.measure).otherwise(measure)
    return sums.where(fails).select("check_id", "key", F.col("n").alias("n_rows"), measure.alias("measure"))
