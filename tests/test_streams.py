"""Streams over a growing folder: several runs, late rows, repeats."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.windows import first_rows
from millrace.sources.session import scratch_path
from millrace.streaming import streams as T
from tests.helpers import rows, ts

SCHEMA = "event_id long, k int, ts timestamp_ntz, v int"


@pytest.fixture
def folder(spark):
    base = scratch_path(spark, "stream")
    return f"{base}/in", f"{base}/out", f"{base}/checkpoint"


def arrive(spark, path, data):
    df = spark.createDataFrame([(i, k, ts(t), v) for i, k, t, v in data], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(path)
    return df


def test_append_takes_each_file_once(spark, folder):
    src, sink, checkpoint = folder
    schema = arrive(spark, src, [(1, 1, "2024-01-01", 1)]).schema
    assert T.stream_incremental_append(spark, src, schema, "ts", sink, checkpoint).count() == 1
    arrive(spark, src, [(2, 1, "2024-01-02", 1), (3, 1, "2024-01-01", 1)])
    assert T.stream_incremental_append(spark, src, schema, "ts", sink, checkpoint).count() == 3
    assert T.stream_incremental_append(spark, src, schema, "ts", sink, checkpoint).count() == 3


def test_upsert_over_runs_equals_batch(spark, folder):
    src, sink, checkpoint = folder
    parts = [[(1, 1, "2024-01-01", 1), (2, 2, "2024-01-01", 2), (3, 1, "2024-01-03", 3)], [(4, 1, "2024-01-02", 4), (5, 2, "2024-01-05", 5)], [(6, 3, "2024-01-01", 6)]]
    for i, part in enumerate(parts):
        schema = arrive(spark, src, part).schema
        stream = T.event_stream(spark, src, schema, "ts", files_per_batch=1)
        got = T.stream_upsert_batch(stream, sink, checkpoint, ["k"], ["-ts", "-event_id"])
        batch = first_rows(spark.read.parquet(src), ["k"], ["-ts", "-event_id"])
        assert rows(got, "k", "event_id", "v") == rows(batch, "k", "event_id", "v")


def test_repeats_are_dropped(spark, folder):
    src, sink, checkpoint = folder
    schema = arrive(spark, src, [(1, 1, "2024-01-01", 1), (1, 1, "2024-01-01", 1), (2, 1, "2024-01-01", 1)]).schema
    T.run_append(T.stream_dedupe_late(T.event_stream(spark, src, schema, "ts"), ["event_id"], "ts", "2 days"), sink, checkpoint)
    arrive(spark, src, [(2, 1, "2024-01-02", 1), (3, 1, "2024-01-02", 1)])
    got = T.run_append(T.stream_dedupe_late(T.event_stream(spark, src, schema, "ts"), ["event_id"], "ts", "2 days"), sink, checkpoint)
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3]


def daily(spark, folder, schema, files_per_batch=None):
    src, sink, checkpoint = folder
    table = T.store_daily_counts(T.event_stream(spark, src, schema, "ts", files_per_batch), sink, checkpoint, "ts", ["k"], "6 hours", {"total": F.col("v")})
    return table, T.daily_counts(table, ["k"], "6 hours", ["total"])


def test_daily_counts_wait_for_the_watermark_and_take_corrections_once(spark, folder):
    schema = arrive(spark, folder[0], [(1, 1, "2024-01-01 10:00:00", 2), (2, 1, "2024-01-02 12:00:00", 3)]).schema
    assert rows(daily(spark, folder, schema)[1], "k", "n_events", "n_late", "total") == [(1, 1, 0, 2)]
    arrive(spark, folder[0], [(3, 1, "2024-01-02 09:00:00", 5), (4, 1, "2024-01-01 23:00:00", 100), (5, 1, "2024-01-04 00:00:00", 1)])
    want = [(1, 2, 0, 8), (1, 2, 1, 102)]
    assert rows(daily(spark, folder, schema)[1], "k", "n_events", "n_late", "total") == want
    assert rows(daily(spark, folder, schema)[1], "k", "n_events", "n_late", "total") == want


def test_replayed_batches_change_nothing(spark, folder):
    """A lost checkpoint makes every batch come again under its number."""
    src, sink, checkpoint = folder
    for i in range(6):
        schema = arrive(spark, src, [(i, i % 2, f"2024-01-{1 + i:02d}", i)]).schema
    first = [rows(x) for x in (daily(spark, folder, schema, 1)[1],)]
    again = daily(spark, (src, sink, checkpoint + "-2"), schema, 1)
    assert [rows(again[1])] == first and again[0].read().agg(F.sum("n_events")).first()[0] == 6
    upserts = [rows(T.stream_upsert_batch(T.event_stream(spark, src, schema, "ts", 1), sink + "-u", checkpoint + name, ["k"], ["-ts"])) for name in ("-3", "-4")]
    assert upserts[0] == upserts[1] and len(upserts[0]) == 2


def test_many_batches_stay_in_a_few_runs(spark, folder):
    src, sink, checkpoint = folder
    schema = "k long, at long, v string"
    table = T._levels(spark.createDataFrame([], schema), sink, [])

    def newest(rows):
        return first_rows(rows, ["k"], ["-at", "-batch_id"])

    for i in range(22):
        T._append(table, spark.createDataFrame([(i % 7, i, f"a{i}"), (i % 3, 200 - i, f"b{i}")], schema).coalesce(1), i, newest)
    levels = [r["level"] for r in table.entries()]
    assert sorted(levels) == [0, 0, 1, 2]  # 22 = 16 + 4 + 1 + 1
    got = {r.k: (r.at, r.v) for r in T.upserted(table, ["k"], ["-at"]).collect()}
    want = {}
    for i in range(22):
        for k, at, v in ((i % 7, i, f"a{i}"), (i % 3, 200 - i, f"b{i}")):
            if k not in want or at >= want[k][0]:
                want[k] = (at, v)
    assert got == want


def test_a_failed_merge_leaves_the_table(spark, folder):
    sink = folder[1]
    table = T._levels(spark.createDataFrame([], "k long"), sink, [])
    for i in range(T.FAN - 1):
        T._append(table, spark.createDataFrame([(i,)], "k long"), i, lambda rows: rows)
    with pytest.raises(ZeroDivisionError):
        T._append(table, spark.createDataFrame([(9,)], "k long"), T.FAN - 1, lambda rows: 1 / 0)
    assert sorted(r.k for r in table.read().collect()) == [0, 1, 2, 9] and {r["level"] for r in table.entries()} == {0}
    T._append(table, spark.createDataFrame([(9,)], "k long"), T.FAN - 1, lambda rows: rows)
    assert sorted(r.k for r in table.read().collect()) == [0, 1, 2, 9] and {r["level"] for r in table.entries()} == {1}


def test_late_rows_are_those_the_watermark_drops(spark, folder):
    """Rows kept, repeats and late rows add up to all rows that arrived."""
    src, sink, checkpoint = folder
    parts = [
        [(1, 1, "2024-01-10", 1), (2, 1, "2024-01-09", 1)], [(3, 1, "2024-01-08", 1), (4, 1, "2024-01-07 23:59:59", 1), (1, 1, "2024-01-10", 1)],
        [(5, 1, "2024-01-20", 1), (6, 1, "2024-01-08", 1)], [(7, 1, "2024-01-17", 1), (8, 1, "2024-01-18", 1), (9, 1, "2024-01-18 00:00:01", 1)],
    ]
    for part in parts:
        schema = arrive(spark, src, part).schema
        kept = T.run_append(T.stream_dedupe_late(T.event_stream(spark, src, schema, "ts", 1), ["event_id"], "ts", "2 days"), sink, checkpoint)
        table = T.store_late_rows(T.event_stream(spark, src, schema, "ts", 1), f"{sink}-late", f"{checkpoint}-late", "ts", "2 days")
    late = sorted(r.event_id for r in T.late_rows(table).collect())
    assert late == [3, 4, 6, 7, 8] and sorted(r.event_id for r in kept.collect()) == [1, 2, 5, 9]
