"""Streaming queries: each drains a stream over the event table and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import register
from millrace.functions.columns import cents
from millrace.sources.session import scratch_path
from millrace.streaming import streams as T


def _paths(t, name):
    base = scratch_path(t.spark, name)
    return f"{base}/data", f"{base}/checkpoint"


def _source(t):
    # a glob, so that the table may be one file or a folder of files
    return f"{t.root}/{{events}}.parquet"


def _events(t):
    return T.event_stream(t.spark, _source(t), t["events"].schema, "ts")


@register("stream_incremental_append", "select event_id, ts, user_id, event_type, value, props from events")
def stream_incremental_append(t):
    sink, checkpoint = _paths(t, "append")
    return T.stream_incremental_append(t.spark, _source(t), t["events"].schema, "ts", sink, checkpoint)


@register("stream_dedupe_late", "select event_id, ts, user_id, event_type from events")
def stream_dedupe_late(t):
    twice = _events(t).select("event_id", "ts", "user_id", "event_type").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return T.run_append(T.stream_dedupe_late(twice, ["event_id"], "ts", "2 days"), *_paths(t, "dedupe"))


@register("stream_upsert_batch", """
    select user_id, event_type, event_id, ts, value from (
      select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1""")
def stream_upsert_batch(t):
    stream = _events(t).select("user_id", "event_type", "event_id", "ts", "value")
    return T.stream_upsert_batch(stream, *_paths(t, "upsert"), ["user_id", "event_type"], ["-ts", "-event_id"])


@register("stream_daily_counts", """
    with d as (select event_type, date_trunc('day', ts)::timestamp as day, count(*) as n_events, sum(round(value * 100)::bigint)::bigint as cents
               from events group by 1, 2)
    select * from d where day + interval 1 day <= (select max(ts) - interval 6 hour from events)""")
def stream_daily_counts(t):
    table = T.store_daily_counts(_events(t), *_paths(t, "daily"), "ts", ["event_type"], "6 hours", {"cents": cents("value")})
    return T.daily_counts(table, ["event_type"], "6 hours", ["cents"]).drop("n_late")


@register("stream_late_rows", """
    with arrived as (select event_id, ts, user_id, event_type, 1 as run from events where event_id % 10 <> 3 union all select event_id, ts, user_id, event_type, 2 from events where event_id % 10 = 3)
    select event_id, ts, user_id, event_type from arrived where run = 2 and ts <= (select max(ts) from arrived where run = 1) - interval 2 day""")
def stream_late_rows(t):
    """Rows that arrive in a second run, a tenth of all, where the watermark of a two-day delay has passed most of them."""
    base = scratch_path(t.spark, "late")
    events = t["events"].select("event_id", "ts", "user_id", "event_type")
    for part in (F.col("event_id") % 10 != 3, F.col("event_id") % 10 == 3):
        events.where(part).write.mode("append").parquet(f"{base}/in")
        table = T.store_late_rows(T.event_stream(t.spark, f"{base}/in", events.schema, "ts"), f"{base}/late", f"{base}/checkpoint", "ts", "2 days")
    return T.late_rows(table)
