"""Ordered per-key computations that do not put a whole key into one task.

A plain ordered window sends every row of a key to one task, which fails when a single key
holds a large share of the table. Each function here takes ``chunk``: a column that never
decreases along the order (a month, a day, a value band). Rows are windowed inside
(key, chunk); one summary row per (key, chunk) is carried along the chunks; the carried value
is joined back. Results equal the plain window. ``chunk`` has no default: ``UNCHUNKED`` asks for the plain window,
for inputs whose groups are bounded by construction (for example monthly aggregates).

Key and chunk travel as one struct column: the local window, the summary and the join all partition by it, so
the rows are shuffled and sorted once, and structs with equal fields are equal even where fields are null.
The input is evaluated twice (rows and summary); write an expensive one once before (cut_lineage).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.operators.keyed import attach, order_struct

GROUP, CHUNK = "_group", "_chunk"
UNCHUNKED = None
BEFORE = (Window.unboundedPreceding, -1)
AFTER = (1, Window.unboundedFollowing)
SO_FAR = (Window.unboundedPreceding, Window.currentRow)
FROM_HERE = (Window.currentRow, Window.unboundedFollowing)


def plain_window(k: list[str], o: list[str]) -> WindowSpec:
    return Window.partitionBy(*k).orderBy(*[F.col(name) for name in o])


def in_chunks(df: DataFrame, k: list[str], chunk: Column) -> DataFrame:
    """Add the (key, chunk) group of every row."""
    return df.withColumn(GROUP, F.struct(*[F.col(name) for name in k], chunk.alias(CHUNK)))


def inside(o: list[str]) -> WindowSpec:
    """Rows of one (key, chunk) in order."""
    return Window.partitionBy(GROUP).orderBy(*[F.col(name) for name in o])


def across(k: list[str]) -> WindowSpec:
    """Summaries of the chunks of one key in order."""
    return Window.partitionBy(*[F.col(f"{GROUP}.{name}") for name in k]).orderBy(F.col(f"{GROUP}.{CHUNK}"))


def carry_over(rows: DataFrame, summaries: dict[str, Column], carried: dict[str, Column]) -> DataFrame:
    """Per (key, chunk) summaries, then ``carried`` window columns over the chunks of a key."""
    per_chunk = rows.groupBy(GROUP).agg(*[agg.alias(name) for name, agg in summaries.items()])
    return per_chunk.select(GROUP, *[col.alias(name) for name, col in carried.items()])


def lag_delta(df: DataFrame, k: list[str], o: list[str], cols: dict[str, str], chunk: Column | None) -> DataFrame:
    """Add for each out -> col the value of col on the previous row of the key."""
    values = F.struct(*[F.col(col).alias(out) for out, col in cols.items()])
    if chunk is None:
        out = df.withColumn("_prev", F.lag(values).over(plain_window(k, o)))
    else:
        rows = in_chunks(df, k, chunk)
        carry = carry_over(rows, {"_end": F.max_by(values, order_struct(o))}, {"_from_before": F.lag("_end").over(across(k))})
        local = rows.withColumn("_inner", F.lag(values).over(inside(o)))
        out = local.join(carry, GROUP, "left").withColumn("_prev", F.coalesce("_inner", "_from_before"))
    return out.select(*df.columns, *[F.col(f"_prev.{name}").alias(name) for name in cols])


def lead_values(df: DataFrame, k: list[str], o: list[str], cols: dict[str, str], chunk: Column | None) -> DataFrame:
    """Add for each out -> col the value of col on the next row of the key."""
    values = F.struct(*[F.col(col).alias(out) for out, col in cols.items()])
    if chunk is None:
        out = df.withColumn("_next", F.lead(values).over(plain_window(k, o)))
    else:
        rows = in_chunks(df, k, chunk)
        carry = carry_over(rows, {"_start": F.min_by(values, order_struct(o))}, {"_from_after": F.lead("_start").over(across(k))})
        local = rows.withColumn("_inner", F.lead(values).over(inside(o)))
        out = local.join(carry, GROUP, "left").withColumn("_next", F.coalesce("_inner", "_from_after"))
    return out.select(*df.columns, *[F.col(f"_next.{name}").alias(name) for name in cols])


def forward_fill(df: DataFrame, k: list[str], o: list[str], col: str, out: str, chunk: Column | None) -> DataFrame:
    """Last non-null value of col up to and including the row."""
    if chunk is None:
        return df.withColumn(out, F.last(col, True).over(plain_window(k, o).rowsBetween(*SO_FAR)))
    rows = in_chunks(df, k, chunk)
    known = F.when(F.col(col).isNotNull(), order_struct(o))
    carry = carry_over(rows, {"_end": F.max_by(col, known)}, {"_from_before": F.last("_end", True).over(across(k).rowsBetween(*BEFORE))})
    local = rows.withColumn("_inner", F.last(col, True).over(inside(o).rowsBetween(*SO_FAR)))
    return local.join(carry, GROUP, "left").select(*df.columns, F.coalesce("_inner", "_from_before").alias(out))


def backward_fill(df: DataFrame, k: list[str], o: list[str], col: str, out: str, chunk: Column | None) -> DataFrame:
    """First non-null value of col from the row on."""
    if chunk is None:
        return df.withColumn(out, F.first(col, True).over(plain_window(k, o).rowsBetween(*FROM_HERE)))
    rows = in_chunks(df, k, chunk)
    known = F.when(F.col(col).isNotNull(), order_struct(o))
    carry = carry_over(rows, {"_start": F.min_by(col, known)}, {"_from_after": F.first("_start", True).over(across(k).rowsBetween(*AFTER))})
    local = rows.withColumn("_inner", F.first(col, True).over(inside(o).rowsBetween(*FROM_HERE)))
    return local.join(carry, GROUP, "left").select(*df.columns, F.coalesce("_inner", "_from_after").alias(out))


def running_total(df: DataFrame, k: list[str], o: list[str], col: str, out: str, chunk: Column | None) -> DataFrame:
    """Sum of col over the key's rows up to and including the row; nulls add nothing."""
    if chunk is None:
        return df.withColumn(out, F.sum(col).over(plain_window(k, o).rowsBetween(*SO_FAR)))
    rows = in_chunks(df, k, chunk)
    carry = carry_over(rows, {"_total": F.sum(col)}, {"_from_before": F.sum("_total").over(across(k).rowsBetween(*BEFORE))})
    local = rows.withColumn("_inner", F.sum(col).over(inside(o).rowsBetween(*SO_FAR)))
    total = F.when(
        F.col("_inner").isNotNull() | F.col("_from_before").isNotNull(),
        F.coalesce("_inner", F.lit(0)) + F.coalesce("_from_before", F.lit(0)),
    )
    return local.join(carry, GROUP, "left").select(*df.columns, total.alias(out))


def sequence_number_in_group(
    df: DataFrame, k: list[str], o: list[str], cond: Column, out: str, chunk: Column | None
) -> DataFrame:
    """Number the rows of a key that satisfy cond 1, 2, ...; other rows get null."""
    flagged = df.withColumn("_hit", F.when(cond, F.lit(1)).otherwise(F.lit(0)))
    counted = running_total(flagged, k, o, "_hit", "_n", chunk)
    return counted.select(*df.columns, F.when(F.col("_hit") == 1, F.col("_n")).alias(out))


def status_duration(
    df: DataFrame, k: list[str], ts: str, state: str, tiebreak: list[str], chunk: Column | None
) -> DataFrame:
    """Next non-null state and its time, and the seconds spent in the current state."""
    stated = df.filter(F.col(state).isNotNull())
    nxt = lead_values(stated, k, [ts, *tiebreak], {f"next_{state}": state, "next_at": ts}, chunk)
    seconds = F.unix_seconds(F.col("next_at").cast("timestamp")) - F.unix_seconds(F.col(ts).cast("timestamp"))
    return nxt.withColumn("seconds_in_state", seconds)


def rank_in_group(df: DataFrame, k: list[str], col: str, out: str, chunk: Column | None) -> DataFrame:
    """rank() of col inside the key: 1 + rows with a smaller value, from counts per value."""
    counts = df.groupBy(*k, col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(counts, k, [col], "_n", "_upto", chunk)
    return attach(df, ranked.select(*k, col, (F.col("_upto") - F.col("_n") + 1).alias(out)), [*k, col])
