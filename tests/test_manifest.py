"""Tables under a manifest: merges and snapshots that write only what changes."""

import os
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import write as M
from millrace.sources.manifest import ManifestTable, merge
from millrace.sources.versions import create_history, read_history, update_history
from tests.helpers import plan, rows, ts

SCHEMA = "k long, p string, at timestamp_ntz, v string"


def frame(spark, data):
    return spark.createDataFrame([(k, p, ts(at), v) for k, p, at, v in data], SCHEMA)


def files(path):
    """Relative names and sizes of all data files."""
    return {os.path.relpath(os.path.join(d, f), path): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    data = frame(spark, [(i, "abcd"[i % 4], f"2024-01-{1 + i % 20:02d}", "old") for i in range(80)] + [(900, None, "2024-01-01", "old"), (901, "lone / =x", "2024-01-01", "old")])
    made = ManifestTable(spark, str(tmp_path / "t"), data.schema, ["p"], ["k"], ["at"])
    made.commit(data)
    return made


def state(table):
    return {r.k: (r.p, r.v) for r in table.read().collect()}


def test_first_commit(table):
    assert table.version() == 0 and len(state(table)) == 82 and table.read([(None,)]).count() == 1 and table.read([("lone / =x",)]).count() == 1
    assert table.highest("at") == ts("2024-01-20") and {r.p: r.n for r in table.entries()}["a"] == 20


def test_merge_touches_only_partitions_with_the_batch(spark, table):
    before = files(f"{table.path}/data")
    touched = merge(table, frame(spark, [(1, "b", "2024-02-01", "new"), (500, "d", "2024-02-01", "new")]))
    assert sorted(touched) == [("b",), ("d",)]
    after = files(f"{table.path}/data")
    assert set(before) <= set(after) and {n.split("/")[1] for n in set(after) - set(before)} == {"p=b", "p=d"}
    got = state(table)
    assert len(got) == 83 and got[1] == ("b", "new") and got[5] == ("b", "old") and table.highest("at") == ts("2024-02-01")
    read = table.read([("a",)])
    assert read.count() == 20 and re.search(r"DataFilters: \[\].*PartitionFilters: \[[^]]*p#", plan(read))


def test_a_key_that_moves_leaves_its_partition_even_empty(spark, table):
    touched = merge(table, frame(spark, [(901, "a", "2024-02-01", "moved"), (900, "b", "2024-02-01", "moved"), (2, None, "2024-02-01", "moved")]))
    assert set(touched) == {("lone / =x",), ("a",), (None,), ("b",), ("c",)}
    got = state(table)
    assert len(got) == 82 and got[901] == ("a", "moved") and got[900] == ("b", "moved") and got[2] == (None, "moved")
    assert "lone / =x" not in {r.p for r in table.entries()} and sum(r.n for r in table.entries()) == 82


def test_merges_equal_the_whole_rewrite(spark, table):
    target = table.read().cache()
    new = frame(spark, [(3, "a", "2024-01-25", "x"), (3, "b", "2024-01-26", "y"), (4, "a", "2023-12-01", "stale"), (700, "e", "2024-01-20", "z")])
    want = rows(M.incremental_merge(target, new, ["k"], ["at"], ["-at"]), "k", "p", "at", "v")
    merge(table, new, ["at"], ["-at"])
    assert rows(table.read(), "k", "p", "at", "v") == want
    merge(table, new, ["at"], ["-at"])
    assert rows(table.read(), "k", "p", "at", "v") == want
    version = table.version()
    assert merge(table, new.limit(0)) == [] and table.version() == version


def test_a_commit_that_failed_is_not_seen(spark, table):
    before = state(table)
    broken = frame(spark, [(1, "b", "2024-02-01", "new")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.commit(broken, [("b",)])
    frame(spark, [(1, "b", "2024-02-01", "half")]).write.mode("overwrite").partitionBy("p").parquet(f"{table.path}/data/commit={table.version() + 1}")
    assert state(table) == before
    merge(table, frame(spark, [(1, "b", "2024-02-01", "new")]))
    assert state(table) == before | {1: ("b", "new")}


def test_all_rows_can_leave(spark, table):
    table.commit(table.read().limit(0), [(r.p,) for r in table.entries()])
    assert table.read().count() == 0 and table.entries() == []
    merge(table, frame(spark, [(1, "b", "2024-02-01", "new")]))
    assert state(table) == {1: ("b", "new")}


def test_snapshot_writes_in_proportion_to_changes(spark, tmp_path):
    schema = "k long, v string, w string"
    base = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("w").alias("w"))
    history = create_history(M.first_snapshot(base, F.lit("2024-01-01")).repartition("k"), str(tmp_path / "h"), ["k"], 64)
    first = files(f"{history.path}/data")
    whole = sum(first.values())
    changed = F.col("k").isin(5, 77)
    later = base.where("k <> 9").withColumn("w", F.when(changed, "changed").otherwise(F.col("w"))).unionByName(spark.createDataFrame([(50_000, "n", "w")], schema))
    touched = update_history(history, later, ["k"], M.check_rule(["v", "w"], "2024-02-01", hard_deletes=True), 64)
    second = files(f"{history.path}/data")
    written = sum(size for name, size in second.items() if name not in first)
    assert 1 <= len(touched) <= 4 and written < whole * len(touched) / 64 * 2 + 20_000 and set(first) <= set(second)
    want = M.snapshot_check(M.first_snapshot(base, F.lit("2024-01-01")), later, ["k"], ["v", "w"], "2024-02-01", hard_deletes=True)
    assert rows(read_history(history), *want.columns) == rows(want)
    assert update_history(history, later, ["k"], M.check_rule(["v", "w"], "2024-03-01", hard_deletes=True), 64) == []
    assert files(f"{history.path}/data") == second


def test_history_over_runs_equals_the_frames(spark, tmp_path):
    schema = "k int, v string, updated_at timestamp_ntz"
    states = [
        [(1, "a", "2020-01-01"), (2, "b", "2020-01-01"), (3, "c", "2020-01-01"), (None, "n", "2020-01-01")],
        [(1, "a2", "2020-02-01"), (2, "b", "2020-01-01"), (None, "n2", "2020-02-02")],
        [(1, "a2", "2020-02-01"), (3, "c3", "2020-04-01")],
        [],
    ]
    made = [spark.createDataFrame([(k, v, ts(t)) for k, v, t in s], schema) for s in states]
    want = M.first_snapshot(made[0], F.col("updated_at"))
    table = create_history(want, str(tmp_path / "h"), ["k"], 3)
    for current, as_of in zip(made[1:], ["2020-03-01", "2020-05-01", "2020-06-01"]):
        want = M.snapshot_timestamp(want, current, ["k"], "updated_at", as_of, hard_deletes=True)
        update_history(table, current, ["k"], M.timestamp_rule("updated_at", as_of, hard_deletes=True), 3)
        assert rows(read_history(table), "k", "v", "valid_from", "valid_to") == rows(want, "k", "v", "valid_from", "valid_to")
    gone = create_history(M.first_snapshot(made[0], F.col("updated_at")), str(tmp_path / "g"), ["k"], 3)
    update_history(gone, made[1].select("k"), ["k"], M.delete_rule("2020-09-01"), 3)
    assert rows(read_history(gone).where("valid_to is not null"), "k") == [(3,)]
