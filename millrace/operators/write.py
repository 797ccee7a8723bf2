"""Write modes and slowly changing dimensions.

Every function returns the NEW STATE of the target as a DataFrame; persisting it (a new folder, or a
dynamic partition overwrite) is the writer's job. Nothing is collected: watermarks are
scalar subqueries inside the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import any_of
from millrace.operators.keyed import attach, only_matching
from millrace.operators.windows import first_rows


def after_watermark(target: DataFrame, new: DataFrame, ts: str) -> DataFrame:
    """Rows of new later than everything in the target; all rows when the target is empty."""
    high = target.agg(F.max(ts)).scalar()
    return new.filter(high.isNull() | (F.col(ts) > high))


def incremental_append_watermark(target: DataFrame, new: DataFrame, ts: str) -> DataFrame:
    return target.unionByName(after_watermark(target, new, ts))


def incremental_append_per_source(target: DataFrame, new: DataFrame, source: str, ts: str) -> DataFrame:
    """Append with one watermark per source value; unknown sources are taken whole."""
    high = target.groupBy(source).agg(F.max(ts).alias("_high"))
    fresh = attach(new, high, [source]).filter(F.col("_high").isNull() | (F.col(ts) > F.col("_high"))).drop("_high")
    return target.unionByName(fresh)


def incremental_append_antijoin(target: DataFrame, new: DataFrame, k: list[str]) -> DataFrame:
    return target.unionByName(only_matching(new, target, k, "left_anti"))


def incremental_merge(
    target: DataFrame, new: DataFrame, k: list[str], watermarks: list[str] = (), latest: list[str] | None = None
) -> DataFrame:
    """Upsert on k. Only rows at or after one of the target's watermarks are candidates.

    ``latest`` is the order that picks one candidate per key when new repeats keys.
    """
    if watermarks:
        # One value with all maxima: one scan of the target.
        highs = target.agg(F.struct(*[F.max(x).alias(x) for x in watermarks]).alias("highs")).scalar()
        new = new.filter(any_of([F.col(x) >= F.coalesce(highs[x], F.col(x)) for x in watermarks]))
    if latest:
        new = first_rows(new, k, latest)
    return only_matching(target, new, k, "left_anti").unionByName(new)


def trailing_window_reload(
    target: DataFrame, source: DataFrame, k: list[str], ts: str, days: int, as_of: str, latest: list[str]
) -> DataFrame:
    """Pull the last days again, keep one row per key, and upsert them."""
    return incremental_merge(target, trailing_window(source, ts, days, as_of), k, latest=latest)


def trailing_window(source: DataFrame, ts: str, days: int, as_of: str) -> DataFrame:
    return source.filter(F.col(ts) >= F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz"))


def sync_schema_append(target: DataFrame, new: DataFrame) -> DataFrame:
    """Append by name; columns only one side has are null on the other."""
    return target.unionByName(new, allowMissingColumns=True)


def sync_hard_deletes(target: DataFrame, source: DataFrame, k: list[str]) -> DataFrame:
    return only_matching(target, source, k, "left_semi")


def archive_missing_rows(archive: DataFrame, source: DataFrame, k: list[str]) -> DataFrame:
    return archive.unionByName(only_matching(source, archive, k, "left_anti"))


def delete_duplicates(df: DataFrame, k: list[str], o: list[str]) -> DataFrame:
    """Keep the first row per key in the given total order."""
    return first_rows(df, k, o)


def update_from_join(target: DataFrame, src: DataFrame, k: list[str], cols: list[str]) -> DataFrame:
    """Set columns from the matching source row; unmatched rows and null updates keep their values."""
    side = src.select(*k, *[F.col(x).alias(f"_new_{x}") for x in cols])
    joined = attach(target, side, k)
    return joined.select(*[F.coalesce(f"_new_{x}", x).alias(x) if x in cols else F.col(x) for x in target.columns])


def backfill_by_period(target: DataFrame, source: DataFrame, ts: str, start: str, stop: str, period: str) -> DataFrame:
    """Rows after the target's newest row (or start) and before stop, labelled with their period.

    All missing periods load in one job; the ``period`` label is the partition column for a
    dynamic partition overwrite.
    """
    begin = F.coalesce(target.agg(F.max(ts)).scalar(), F.lit(start).cast("timestamp_ntz"))
    fresh = source.filter((F.col(ts) > begin) & (F.col(ts) < F.lit(stop).cast("timestamp_ntz")))
    label = F.to_date(ts) if period == "day" else F.trunc(F.col(ts), period)
    return target.unionByName(fresh).withColumn("period", label)


@dataclass(frozen=True)
class VersionRule:
    """When an open version of a key is replaced, and which times go into the versions. Conditions see the open version as ``_old``, the current row as ``_new``."""

    changed: Column
    closes_at: Column
    opens_at: Column
    deletes_at: Column
    adds: bool = True


def _never() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def timestamp_rule(updated_at: str, as_of: str, hard_deletes: bool = False) -> VersionRule:
    """New version when updated_at grows; versions start and end at the source's update time."""
    starts = F.col(f"_new.{updated_at}").cast("timestamp_ntz")
    return VersionRule(F.col(f"_new.{updated_at}") > F.col(f"_old.{updated_at}"), starts, starts, F.lit(as_of).cast("timestamp_ntz") if hard_deletes else _never())


def check_rule(check_cols: list[str], as_of: str, hard_deletes: bool = False) -> VersionRule:
    """New version as of now when any check column differs, null-safe."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return VersionRule(any_of([~F.col(f"_new.{x}").eqNullSafe(F.col(f"_old.{x}")) for x in check_cols]), now, now, now if hard_deletes else _never())


def delete_rule(as_of: str) -> VersionRule:
    """Versions only end, when their key leaves the source."""
    return VersionRule(F.lit(False), _never(), _never(), F.lit(as_of).cast("timestamp_ntz"), adds=False)


def version_changes(opened: DataFrame, current: DataFrame, k: list[str], rule: VersionRule) -> DataFrame:
    """Open versions and current rows side by side: the key, ``_old``, ``_new``, ``_ends`` (when the open version ends, if it does) and ``_starts`` (whether a version begins).

    One full join; both sides hold one row per key, so no key can be hot here.
    """
    # Columns of the current rows that a rule which adds nothing never reads stay out of the join.
    rest = [x for x in current.columns if x not in k and (rule.adds or x in opened.columns)] or [F.lit(True).alias("_here")]
    old = opened.select(*[F.col(x).alias(f"_o_{x}") for x in k], F.struct(*[x for x in opened.columns if x not in k]).alias("_old"))
    new = current.select(*[F.col(x).alias(f"_n_{x}") for x in k], F.struct(*rest).alias("_new"))
    both = old.join(new, [F.col(f"_o_{x}").eqNullSafe(F.col(f"_n_{x}")) for x in k], "full")
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    replaced = is_old & is_new & rule.changed
    ends = F.when(replaced, rule.closes_at).when(is_old & ~is_new, rule.deletes_at)
    starts = F.coalesce(replaced | ~is_old, F.lit(False)) & F.lit(rule.adds)
    return both.select(*[F.coalesce(f"_o_{x}", f"_n_{x}").alias(x) for x in k], "_old", "_new", ends.alias("_ends"), starts.alias("_starts"))


def old_version(columns: list[str], k: list[str], end: Column) -> Column:
    """The open version with its end, as a struct of the table's columns."""
    return F.struct(*[F.col(x) if x in k else end.alias(x) if x == "valid_to" else F.col(f"_old.{x}").alias(x) for x in columns])


def new_version(columns: list[str], k: list[str], rule: VersionRule) -> Column:
    """The version that begins, as a struct of the table's columns."""
    times = {"valid_from": rule.opens_at, "valid_to": _never()}
    return F.struct(*[F.col(x) if x in k else times[x].alias(x) if x in times else F.col(f"_new.{x}").alias(x) for x in columns])


def _next_versions(history: DataFrame, current: DataFrame, k: list[str], rule: VersionRule) -> DataFrame:
    """All versions after a look at the current rows; closed versions pass through."""
    is_open = F.col("valid_to").isNull()
    both = version_changes(history.filter(is_open), current, k, rule)
    rows = [F.when(F.col("_old").isNotNull(), old_version(history.columns, k, F.col("_ends")))]
    if rule.adds:
        rows.append(F.when(F.col("_starts"), new_version(history.columns, k, rule)))
    return history.filter(~is_open).unionByName(both.select(F.inline(F.array_compact(F.array(*rows)))))


def snapshot_timestamp(
    history: DataFrame, current: DataFrame, k: list[str], updated_at: str, as_of: str, hard_deletes: bool = False
) -> DataFrame:
    return _next_versions(history, current, k, timestamp_rule(updated_at, as_of, hard_deletes))


def snapshot_check(
    history: DataFrame, current: DataFrame, k: list[str], check_cols: list[str], as_of: str, hard_deletes: bool = False
) -> DataFrame:
    return _next_versions(history, current, k, check_rule(check_cols, as_of, hard_deletes))


def snapshot_hard_deletes(history: DataFrame, current: DataFrame, k: list[str], as_of: str) -> DataFrame:
    """Close the open versions whose key left the source."""
    return _next_versions(history, current.select(*k).distinct(), k, delete_rule(as_of))


def first_snapshot(current: DataFrame, starts: Column) -> DataFrame:
    """History of a table snapshotted for the first time."""
    return current.withColumn("valid_from", starts.cast("timestamp_ntz")).withColumn("valid_to", _never())
