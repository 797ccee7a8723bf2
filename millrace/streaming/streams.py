"""Streams over growing event folders.

Every run uses trigger(availableNow): it takes what has arrived, commits it exactly once through the
checkpoint folder, and stops; the next run goes on from there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.windows import first_rows
from millrace.sources.manifest import ManifestTable

#: Runs of a level that are merged into one of the next.
FAN = 4


def event_stream(spark: SparkSession, path: str, schema: StructType, ts: str, files_per_batch: int | None = None) -> DataFrame:
    """File stream with the event time as an instant, as watermarks need it."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def run_append(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Drain a stream into Parquet and hand back a scan of the sink."""
    query = (
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(sink)


def stream_incremental_append(
    spark: SparkSession, src: str, schema: StructType, ts: str, sink: str, checkpoint: str, files_per_batch: int | None = None
) -> DataFrame:
    """Exactly-once ingest of an event log."""
    return run_append(event_stream(spark, src, schema, ts, files_per_batch), sink, checkpoint)


def stream_dedupe_late(stream: DataFrame, k: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the delay; state older than that is released."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(k)


def store_late_rows(stream: DataFrame, sink: str, checkpoint: str, ts: str, delay: str) -> ManifestTable:
    """Keep the rows that a watermark drops: those not newer than the newest row of all batches before theirs, less the delay.

    Started with the same source and options as the stream that drops them, it sees the same batches. Every batch is stored once, whatever is replayed; ``kind``
    tells late rows from the one row a batch that carries its newest time.
    """
    table = _levels(stream, sink, [ts])

    def store(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max(ts).alias(ts))
        high = table.highest(ts)
        late = batch.where(F.col(ts) <= _less(F.lit(high), delay)) if high is not None else batch.limit(0)
        marks = newest.where(F.col(ts).isNotNull()).withColumn("kind", F.lit("newest"))
        _append(table, late.withColumn("kind", F.lit("late")).unionByName(marks, allowMissingColumns=True), batch_id, lambda rows: rows)

    _drain(stream, store, checkpoint)
    return table


def late_rows(table: ManifestTable) -> DataFrame:
    """The dropped rows that ``store_late_rows`` has kept."""
    return table.read().where("kind = 'late'").drop("kind", "level", "batch_id")



def store_daily_counts(stream: DataFrame, sink: str, checkpoint: str, ts: str, k: list[str], delay: str, sums: dict[str, Column]) -> ManifestTable:
    """Counts and sums per key and day as mergeable partials: a batch adds only its own, so no row is ever too late.

    Rows that come when their day is closed already (it ends before the newest row of earlier batches, less the delay) are corrections: they are counted in
    ``n_late`` as well. Partials are merged level by level; a batch that is replayed is not added again.
    """
    names = ["n_events", "n_late", *sums]
    counted = stream.groupBy(F.window(ts, "1 day").start.alias("day"), *k).agg(
        F.count(F.lit(1)).alias("n_events"), F.count(F.lit(1)).alias("n_late"), *[F.sum(x).alias(name) for name, x in sums.items()], F.max(ts).alias("newest"))
    table = _levels(counted, sink, ["newest"], mark=False)

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day", *k).agg(*[F.sum(x).alias(x) for x in names], F.max("newest").alias("newest"), F.max("batch_id").alias("batch_id"))

    def store(batch: DataFrame, batch_id: int) -> None:
        high = table.highest("newest")
        day = F.date_trunc("day", F.col(ts))
        closed = (day + F.expr("interval 1 day") <= _less(F.lit(high), delay)) if high is not None else F.lit(False)
        partial = batch.groupBy(day.alias("day"), *k).agg(
            F.count(F.lit(1)).alias("n_events"), F.count_if(closed).alias("n_late"), *[F.sum(x).alias(name) for name, x in sums.items()], F.max(ts).alias("newest"))
        _append(table, partial, batch_id, merged)

    _drain(stream, store, checkpoint)
    return table


def daily_counts(table: ManifestTable, k: list[str], delay: str, sums: list[str]) -> DataFrame:
    """The days that are closed, corrections included: ``day``, key, ``n_events``, ``n_late`` and sums."""
    high = table.highest("newest")
    rows = table.read().groupBy("day", *k).agg(*[F.sum(x).alias(x) for x in ("n_events", "n_late", *sums)])
    return rows.where(F.col("day") + F.expr("interval 1 day") <= _less(F.lit(high), delay)) if high is not None else rows.limit(0)


def stream_upsert_batch(stream: DataFrame, sink: str, checkpoint: str, k: list[str], latest: list[str]) -> DataFrame:
    """Upsert micro-batches into a merge-on-read table.

    A batch adds its own newest row per key and rewrites nothing else. ``FAN`` batches are merged into one run of the next level, ``FAN`` runs of that into one of
    the level above: after n batches a reader ranks fewer than FAN runs for each of log(n) levels. A replayed batch is not added again; a merge that fails leaves
    the table as it was.
    """
    table = _levels(stream, sink, [])

    def newest(rows: DataFrame) -> DataFrame:
        return first_rows(rows, k, [*latest, "-batch_id"])

    _drain(stream, lambda batch, batch_id: _append(table, first_rows(batch, k, latest), batch_id, newest), checkpoint)
    return upserted(table, k, latest)


def upserted(table: ManifestTable, k: list[str], latest: list[str]) -> DataFrame:
    """Current state of a merge-on-read table: newest row per key, later batches first on ties."""
    return first_rows(table.read(), k, [*latest, "-batch_id"]).drop("batch_id", "level")


def _levels(rows: DataFrame, sink: str, maxima: list[str], mark: bool = True) -> ManifestTable:
    """A table of runs by level; ``batch_id`` tells what is stored already."""
    schema = StructType([*rows.schema])
    if mark and maxima:
        schema = schema.add("kind", "string")
    return ManifestTable(rows.sparkSession, sink, schema.add("batch_id", "long").add("level", "integer"), ["level"], [], [*maxima, "batch_id"])


def _append(table: ManifestTable, rows: DataFrame, batch_id: int, merged: Callable[[DataFrame], DataFrame]) -> None:
    """Store a batch as a run of level 0 unless it is there, then merge levels that are full."""
    stored = table.highest("batch_id")
    if stored is None or batch_id > stored:
        table.commit(rows.withColumns({"batch_id": F.lit(batch_id).cast("long"), "level": F.lit(0)}))
    compact(table, merged)


def compact(table: ManifestTable, merged: Callable[[DataFrame], DataFrame]) -> None:
    """While a level holds FAN runs, make one run of the next level of them. Every merge is one commit."""
    while full := sorted(level for level, n in Counter(r["level"] for r in table.entries()).items() if n >= FAN):
        table.commit(merged(table.read([(full[0],)])).withColumn("level", F.lit(full[0] + 1)), [(full[0],)])


def _drain(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _less(at: Column, delay: str) -> Column:
    return at - F.expr(f"interval {delay}")
