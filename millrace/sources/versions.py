"""Snapshot history on disk, written in proportion to what changes.

Open versions lie in buckets by hash of their key, closed ones apart from them. A run joins the open versions with the current rows, writes only the changes it finds,
appends the versions that end, and writes again the buckets in which a version ends or begins. Closed versions are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keyed import only_matching
from millrace.operators.write import VersionRule, new_version, old_version, version_changes
from millrace.sources.manifest import ManifestTable
from millrace.sources.session import cut_lineage

CLOSED = -1


def _placed(versions: DataFrame, k: list[str], buckets: int) -> DataFrame:
    """``bucket`` of every version: CLOSED, or by its key."""
    bucket = F.when(F.col("valid_to").isNotNull(), F.lit(CLOSED)).otherwise(key_bucket(k, buckets))
    return versions.withColumn("bucket", bucket)


def key_bucket(k: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*k), F.lit(buckets)).cast("int")


def create_history(history: DataFrame, path: str, k: list[str], buckets: int) -> ManifestTable:
    """Store a history for the first time. A bucket should fit a task well, and there should be more of them than keys that change in a run touch."""
    rows = _placed(history, k, buckets)
    table = ManifestTable(history.sparkSession, path, rows.schema, ["bucket"])
    table.commit(rows)
    return table


def update_history(table: ManifestTable, current: DataFrame, k: list[str], rule: VersionRule, buckets: int) -> list[int]:
    """Bring the history up to the current rows. Returns the buckets written again."""
    opened = table.read(_open(table)).drop("bucket")
    both = version_changes(opened, current, k, rule).where(F.col("_ends").isNotNull() | F.col("_starts"))
    changes = cut_lineage(both.withColumn("_bucket", key_bucket(k, buckets)), "changes")
    touched = [r[0] for r in changes.select("_bucket").distinct().collect()]
    if not touched:
        return []
    ended = changes.where("_ends is not null").select(F.inline(F.array(old_version(opened.columns, k, F.col("_ends")))))
    kept = only_matching(table.read([(b,) for b in touched]).drop("bucket"), changes.where("_ends is not null"), k, "left_anti")
    rows = kept.unionByName(ended)
    if rule.adds:
        rows = rows.unionByName(changes.where("_starts").select(F.inline(F.array(new_version(opened.columns, k, rule)))))
    table.commit(_placed(rows, k, buckets).repartition("bucket"), [(b,) for b in touched])
    return sorted(touched)


def _open(table: ManifestTable) -> list[tuple]:
    return [(r["bucket"],) for r in table.entries() if r["bucket"] != CLOSED]


def read_history(table: ManifestTable) -> DataFrame:
    return table.read().drop("bucket")
