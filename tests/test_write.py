"""Write modes and snapshots: idempotence, incremental equals full, exclusive versions."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality as Q
from millrace.operators import write as M
from millrace.sources import sinks
from millrace.sources.session import cut_lineage, remove_scratch, run_folder, scratch_path
from tests.helpers import d, rows, ts


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame([(i, f"s{i % 3}", ts(f"2024-01-{1 + i:02d}"), i * 10) for i in range(20)], "id int, src string, at timestamp_ntz, v int").cache()


def test_watermark_append_equals_full(log):
    target = log.filter("id < 8")
    once = M.incremental_append_watermark(target, log, "at")
    assert rows(once) == rows(log)
    assert rows(M.incremental_append_watermark(once, log, "at")) == rows(log)
    assert rows(M.incremental_append_watermark(log.limit(0), log, "at")) == rows(log)


def test_per_source_watermarks(log):
    target = log.filter("(src = 's0' and id < 10) or (src = 's1' and id < 3)")
    assert rows(M.incremental_append_per_source(target, log, "src", "at")) == rows(log)


def test_merge_replaces_and_is_idempotent(log):
    new = log.filter("id >= 15").withColumn("v", F.lit(-1)).unionByName(log.filter("id = 19").withColumn("id", F.lit(20)))
    once = M.incremental_merge(log, new, ["id"])
    twice = M.incremental_merge(once, new, ["id"])
    assert rows(once) == rows(twice) and once.count() == 21 and once.filter("v = -1").count() == 5


def test_merge_takes_one_candidate_per_key_after_the_watermark(spark, log):
    new = spark.createDataFrame([(5, "s2", ts("2024-03-01"), 1), (5, "s2", ts("2024-03-02"), 2), (6, "s0", ts("2023-01-01"), 3)], log.schema)
    out = M.incremental_merge(log, new, ["id"], ["at"], ["-at"])
    assert {r.id: r.v for r in out.collect()}[5] == 2
    assert {r.id: r.v for r in out.collect()}[6] == 60


def test_antijoin_archive_and_hard_deletes(log):
    part = log.filter("id % 2 = 0")
    assert rows(M.incremental_append_antijoin(part, log, ["id"])) == rows(log)
    assert rows(M.archive_missing_rows(part, log, ["id"])) == rows(log)
    assert rows(M.sync_hard_deletes(log, part, ["id"])) == rows(part)


def test_update_from_join_keeps_unmatched(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    src = spark.createDataFrame([(1, "x"), (2, None), (9, "z")], "k int, v string")
    assert rows(M.update_from_join(target, src, ["k"], ["v"])) == [(1, "x"), (2, "b"), (3, "c")]


def test_backfill_resumes_after_the_newest_row(spark):
    dates = ["2017-12-02", "2018-01-02", "2018-02-02", "2018-03-02", "2018-04-02", "2018-05-02", "2018-06-02", "2018-07-02", "2018-08-02"]
    source = spark.createDataFrame([(i + 1, ts(x)) for i, x in enumerate(dates)], "id int, at timestamp_ntz")
    first = M.backfill_by_period(source.limit(0), source, "at", "2018-01-01", "2018-06-01", "month")
    assert rows(first, "id") == [(2,), (3,), (4,), (5,), (6,)]
    more = M.backfill_by_period(first.drop("period"), source, "at", "2018-01-01", "2018-08-01", "month")
    assert rows(more, "id") == [(2,), (3,), (4,), (5,), (6,), (7,), (8,)]
    assert rows(more.filter("id = 7"), "period") == [(d("2018-06-01"),)]


def test_snapshot_life_of_a_key(spark):
    schema = "k int, v string, updated_at timestamp_ntz"
    states = [
        [(1, "a", ts("2020-01-01")), (2, "b", ts("2020-01-01")), (3, "c", ts("2020-01-01"))],
        [(1, "a2", ts("2020-02-01")), (2, "b", ts("2020-01-01"))],
        [(1, "a2", ts("2020-02-01")), (2, "b", ts("2020-01-01")), (3, "c3", ts("2020-04-01"))],
    ]
    history = M.first_snapshot(spark.createDataFrame(states[0], schema), F.col("updated_at"))
    for state, as_of in zip(states[1:], ["2020-03-01", "2020-05-01"]):
        current = spark.createDataFrame(state, schema)
        history = cut_lineage(M.snapshot_timestamp(history, current, ["k"], "updated_at", as_of, hard_deletes=True))
        again = M.snapshot_timestamp(history, current, ["k"], "updated_at", as_of, hard_deletes=True)
        assert rows(again.select(history.columns)) == rows(history)
    got = rows(history, "k", "v", "valid_from", "valid_to")
    assert got == sorted([
        (1, "a", ts("2020-01-01"), ts("2020-02-01")), (1, "a2", ts("2020-02-01"), None), (2, "b", ts("2020-01-01"), None),
        (3, "c", ts("2020-01-01"), ts("2020-03-01")), (3, "c3", ts("2020-04-01"), None),
    ], key=lambda r: tuple((x is not None, str(x)) for x in r))
    closed = history.withColumn("valid_to", F.coalesce("valid_to", F.lit("9999-01-01").cast("timestamp_ntz")))
    assert Q.dq_mutually_exclusive_ranges(closed, "valid_from", "valid_to", ["k"], None).count() == 0


def test_snapshot_check_is_null_safe(spark):
    old = M.first_snapshot(spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "k int, v string"), F.lit("2020-01-01"))
    new = spark.createDataFrame([(1, None), (2, None), (3, "c"), (4, "d")], "k int, v string")
    out = M.snapshot_check(old, new, ["k"], ["v"], "2020-06-01")
    assert rows(out, "k", "v", "valid_to") == [(1, None, None), (2, None, None), (2, "b", ts("2020-06-01")), (3, "c", None), (4, "d", None)]


def test_snapshot_hard_deletes(spark):
    old = M.first_snapshot(spark.createDataFrame([(1,), (2,)], "k int"), F.lit("2020-01-01"))
    out = M.snapshot_hard_deletes(old, spark.createDataFrame([(2,)], "k int"), ["k"], "2020-02-02")
    assert rows(out, "k", "valid_to") == [(1, ts("2020-02-02")), (2, None)]


def test_sinks_round_trip(spark, log):
    path = scratch_path(spark, "t")
    assert rows(sinks.write_full_refresh(log, path, ("src",)), *log.columns) == rows(log)
    change = log.filter("src = 's1'").withColumn("v", F.lit(0))
    sinks.overwrite_partitions(change, path, ("src",))
    back = spark.read.schema(log.schema).parquet(path)
    assert back.filter("v = 0 and src = 's1'").count() == change.count() and back.count() == log.count()
    out = sinks.export_parquet(log.coalesce(1), scratch_path(spark, "e"), "log", "2024-02-03 04:05:06")
    assert out.endswith("/log/20240203040506") and len(spark.read.parquet(out).inputFiles()) == 1 and rows(spark.read.parquet(out)) == rows(log)
    assert sinks.backup_table(log, "2024-02-03").columns[0] == "backup_date"


@pytest.mark.parametrize("wide", [0, 3, 40])
def test_export_keeps_every_file_below_the_limit(spark, wide):
    """Narrow rows with some wide ones among them, which the sample may miss."""
    text = F.when(F.col("id") % 1000 < wide, F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: F.sha2((F.col("id") * 5000 + i).cast("string"), 256)), "")).otherwise("x")
    df = spark.range(20_000, numPartitions=3).withColumn("text", text)
    out = sinks.export_parquet(df, scratch_path(spark, "e"), "mixed", "2024-02-03", max_bytes=2**20, sample_rows=500)
    sizes = [size for _, size in sinks.file_sizes(spark, out)]
    assert max(sizes) <= 2**20 and spark.read.parquet(out).count() == 20_000 and (wide or len(sizes) == 1)
    assert rows(spark.read.parquet(out).agg(F.sum("id"), F.sum(F.length("text")))) == rows(df.agg(F.sum("id"), F.sum(F.length("text"))))


def test_export_of_nothing_and_of_one_huge_row(spark):
    assert spark.read.schema("id long").parquet(sinks.export_parquet(spark.range(0), scratch_path(spark, "e"), "none", "2024-02-03")).count() == 0
    huge = spark.range(3).withColumn("t", F.repeat(F.sha2(F.col("id").cast("string"), 256), 50_000))
    out = sinks.export_parquet(huge, scratch_path(spark, "e"), "huge", "2024-02-03", max_bytes=1000)
    assert spark.read.parquet(out).count() == 3 and len(sinks.file_sizes(spark, out)) in (3, 4)


def test_nothing_is_left_in_the_shared_folder(spark):
    cut_lineage(spark.range(3), "left")
    assert os.path.isdir(run_folder(spark).removeprefix("file:"))
    remove_scratch(spark)
    assert not os.path.exists(run_folder(spark).removeprefix("file:"))
