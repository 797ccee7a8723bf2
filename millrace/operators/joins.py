"""Joins.

All joins are equi joins on materialised key columns, so that Spark may shuffle, split skewed
partitions (AQE) or broadcast a side below spark.sql.autoBroadcastJoinThreshold. No operator forces a
broadcast of a table; only literal lookups built in code are hinted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.keyed import attach
from millrace.operators.ordered import forward_fill


def join_inner_equi(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    return left.join(right, [F.col(a) == F.col(b) for a, b in on], "inner")


def join_left_equi(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    return left.join(right, [F.col(a) == F.col(b) for a, b in on], "left")


def semi_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    return left.join(right, [F.col(a) == F.col(b) for a, b in on], "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """NOT EXISTS: null keys on the right never hide rows."""
    return left.join(right, [F.col(a) == F.col(b) for a, b in on], "left_anti")


def lookup_broadcast(df: DataFrame, key: Column, lookup: DataFrame, lookup_key: str, values: list[str]) -> DataFrame:
    """Left join a seed lookup on a trimmed, lower-case key."""
    side = lookup.select(F.lower(F.trim(lookup_key)).alias("_lk"), *values)
    return df.withColumn("_k", F.lower(F.trim(key))).join(side, F.col("_k") == F.col("_lk"), "left").drop("_k", "_lk")


def role_playing_dims(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str]) -> DataFrame:
    """Join the same dimension once per role: foreign key -> column prefix."""
    for fk, prefix in roles.items():
        side = dim.select(*[F.col(n).alias(f"{prefix}_{n}") for n in dim.columns])
        fact = fact.join(side, F.col(fk) == F.col(f"{prefix}_{dim_key}"), "left").drop(f"{prefix}_{dim_key}")
    return fact


def wide_fact_assembly(base: DataFrame, k: str, sides: list[DataFrame]) -> DataFrame:
    """Left join many entity-level frames on one key.

    Each side is a grouped frame (one row per key), so the row count of the base is kept and
    every join asks for the same hash partitioning: the base is shuffled once.
    """
    for side in sides:
        base = base.join(side, k, "left")
    return base


def repeated_keys(df: DataFrame, k: list[str]) -> DataFrame:
    """Keys that occur more than once: must be empty for a side of wide_fact_assembly."""
    return df.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def self_join_lineage(df: DataFrame, id_: str, parent: str, cols: Mapping[str, str]) -> DataFrame:
    """Attach columns of the parent row (same table) to every row that names a parent."""
    side = df.select(F.col(id_).alias("_pid"), *[F.col(src).alias(out) for out, src in cols.items()])
    return df.join(side, F.col(parent) == F.col("_pid"), "left").drop("_pid")


def asof_scd2_join(
    fact: DataFrame, history: DataFrame, k: list[tuple[str, str]], ts: str, values: list[str], chunk: Callable[[Column], Column]
) -> DataFrame:
    """The version of a keyed history that was valid at the time of each fact row (null if none).

    Facts and version starts are laid on one time line per key and the latest version is filled
    forward, chunk by chunk (``chunk`` maps the time to a month, a day, ...). Work is linear in
    facts + versions: no fact x version pairs, and a hot key is spread over its chunks.
    """
    names = [f"_k{i}" for i in range(len(k))]
    facts = fact.select(
        *[F.col(a).alias(n) for n, (a, _) in zip(names, k)], F.col(ts).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*fact.columns).alias("_fact"),
    )
    versions = history.select(
        *[F.col(b).alias(n) for n, (_, b) in zip(names, k)], F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"),
        F.struct("valid_to", *values).alias("_version"),
    )
    line = facts.unionByName(versions, allowMissingColumns=True)
    filled = forward_fill(line, names, ["_at", "_kind"], "_version", "_v", chunk(F.col("_at"))).filter("_kind = 1")
    valid = F.col("_v.valid_to").isNull() | (F.col("_at") < F.col("_v.valid_to"))
    return filled.select("_fact.*", *[F.when(valid, F.col(f"_v.{name}")).alias(name) for name in values])


def interval_expand_join(df: DataFrame, start: str, end: str, unit: str = "day", out: str = "date") -> DataFrame:
    """One row per unit covered by [start, end): the sequence is built inside the row, no theta join."""
    step = F.expr(f"interval 1 {unit}")
    first = F.trunc(F.col(start), unit) if unit != "day" else F.to_date(start)
    last = F.date_sub(F.to_date(end), 1)
    covered = df.filter(F.to_date(start) <= last)
    return covered.withColumn(out, F.explode(F.sequence(first, last, step)))


def interval_overlap_load(df: DataFrame, start: str, end: str, group: list[str], value: Column) -> DataFrame:
    """Entities and value in progress per group and day, for days with any load.

    A sweep: every interval gives a +1 on its first day and a -1 on its end day. These are summed
    per (group, day) before the shuffle, so the running sum sees one row per group and day
    with a change, however many intervals a group has.
    """
    change = F.array(
        F.struct(F.to_date(start).alias("date"), F.lit(1).alias("n"), value.alias("v")),
        F.struct(F.to_date(end).alias("date"), F.lit(-1).alias("n"), (-value).alias("v")),
    )
    steps = df.filter(F.to_date(start) < F.to_date(end)).select(*group, F.inline(change))
    steps = steps.groupBy(*group, "date").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    w = Window.partitionBy(*group).orderBy("date")
    level = steps.select(
        *group, "date", F.sum("n").over(w).alias("in_progress"), F.sum("v").over(w).alias("load"),
        F.lead("date").over(w).alias("_until"),
    ).filter("in_progress > 0")
    days = F.explode(F.sequence(F.col("date"), F.date_sub("_until", 1)))
    return level.select(*group, days.alias("date"), "in_progress", "load")


def fx_convert(df: DataFrame, rates: DataFrame, amount: str, ccy: str, date: Column, out: str) -> DataFrame:
    """amount / rate of the row's currency on the row's day; null when no rate is known."""
    side = rates.select(F.col("currency").alias("_ccy"), F.col("date").alias("_day"), F.col("rate").alias("_rate"))
    dated = df.withColumn("_rate_date", F.to_date(date))
    joined = dated.join(side, (F.col(ccy) == F.col("_ccy")) & (F.col("_rate_date") == F.col("_day")), "left")
    return joined.withColumn(out, F.col(amount) / F.col("_rate")).drop("_ccy", "_day", "_rate", "_rate_date")


def fx_convert_effective_date(df: DataFrame, rates: DataFrame, amount: str, ccy: str, date_rule: Column, out: str) -> DataFrame:
    """fx_convert where a rule over the row picks the rate date; the date is kept as rate_date."""
    dated = df.withColumn("rate_date", F.to_date(date_rule))
    return fx_convert(dated, rates, amount, ccy, F.col("rate_date"), out)


def disjunctive_join(left: DataFrame, right: DataFrame, ons: list[tuple[str, str]], values: list[str]) -> DataFrame:
    """Left join on on1 OR on2 ...: one equi join per alternative, the first that matches wins.

    Each alternative key of the right side is reduced to one row first.
    """
    out = left
    for i, (a, b) in enumerate(ons):
        side = right.filter(F.col(b).isNotNull()).select(F.col(b).alias(f"_k{i}"), F.struct(*values).alias(f"_v{i}"))
        side = side.groupBy(f"_k{i}").agg(F.min(f"_v{i}").alias(f"_v{i}"))
        out = out.join(side, F.col(a) == F.col(f"_k{i}"), "left")
    picked = F.coalesce(*[F.col(f"_v{i}") for i in range(len(ons))])
    return out.withColumn("_v", picked).select(*left.columns, *[F.col(f"_v.{name}").alias(name) for name in values])


def waterfall_resolve(df: DataFrame, steps: list[tuple[DataFrame, str, str, str]], out: str) -> DataFrame:
    """Resolve a value from the first lookup that knows the row.

    Each step is (lookup, row key, lookup key, value); lookups are reduced to one value per key.
    """
    work = df
    for i, (lookup, row_key, key, value) in enumerate(steps):
        side = lookup.groupBy(F.col(key).alias(f"_k{i}")).agg(F.min(value).alias(f"_v{i}"))
        work = work.join(side, F.col(row_key) == F.col(f"_k{i}"), "left")
    return work.select(*df.columns, F.coalesce(*[F.col(f"_v{i}") for i in range(len(steps))]).alias(out))


def full_outer_reconcile(
    prod: DataFrame, backup: DataFrame, k: str, cols: Mapping[str, float | None]
) -> DataFrame:
    """Rows that differ between production and backup, with the reason.

    cols: column -> tolerance (None: any change counts).
    """
    p = prod.select(F.col(k).alias("_pk"), *[F.col(n).alias(f"_p_{n}") for n in cols])
    b = backup.select(F.col(k).alias("_bk"), *[F.col(n).alias(f"_b_{n}") for n in cols])
    both = p.join(b, F.col("_pk") == F.col("_bk"), "full")
    reason = F.when(F.col("_pk").isNull(), "missing in production").when(F.col("_bk").isNull(), "missing in backup")
    for name, tolerance in cols.items():
        pv, bv = F.col(f"_p_{name}"), F.col(f"_b_{name}")
        if tolerance is None:
            changed = ~pv.eqNullSafe(bv)
        else:
            changed = (pv.isNull() != bv.isNull()) | F.coalesce(F.abs(pv - bv) > tolerance, F.lit(False))
        reason = reason.when(changed, f"{name} changed")
    out = both.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    values = [x for n in cols for x in (F.col(f"_p_{n}").alias(f"production_{n}"), F.col(f"_b_{n}").alias(f"backup_{n}"))]
    return out.select(F.coalesce("_pk", "_bk").alias(k), "reason", *values)


def scaffold(dims: DataFrame, k: list[str], start: Column, end: Column, unit: str, out: str) -> DataFrame:
    """Every distinct key with every period of a range, generated inside the row."""
    periods = F.sequence(F.trunc(start, unit), F.trunc(end, unit), F.expr(f"interval 1 {unit}"))
    return dims.select(*k).distinct().withColumn(out, F.explode(periods))


def cross_join_scaffold(
    dims: DataFrame, k: list[str], facts: DataFrame, start: Column, end: Column, unit: str, period: str, values: list[str]
) -> DataFrame:
    """Dense key x period grid with facts where there are any and 0 elsewhere."""
    grid = scaffold(dims, k, start, end, unit, period)
    return attach(grid, facts, [*k, period]).fillna(0, subset=values)


def lateral_explode(df: DataFrame, arr: str, out: str, outer: bool = False, pos: str | None = None) -> DataFrame:
    if pos:
        gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
        return df.select("*", gen.alias(pos, out)).drop(arr)
    return df.withColumn(out, F.explode_outer(arr) if outer else F.explode(arr)).drop(arr)


def split_to_rows(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    """Delimited text to one row per non-empty trimmed piece, without a limit on pieces."""
    pieces = F.filter(F.transform(F.split(F.col(col), sep), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn(out, F.explode(pieces))


def multi_list_product(df: DataFrame, lists: Mapping[str, Column]) -> DataFrame:
    """Per record, all combinations of several lists; an empty list counts as one null."""
    for out, arr in lists.items():
        df = df.withColumn(out, F.explode_outer(arr))
    return df


def computed_key_join(left: DataFrame, right: DataFrame, lkey: Column, rkey: Column, how: str = "inner") -> DataFrame:
    """Equi join on keys computed from each side."""
    return left.withColumn("_lk", lkey).join(right.withColumn("_rk", rkey), F.col("_lk") == F.col("_rk"), how).drop("_lk", "_rk")


def coalesced_exception_override(df: DataFrame, exceptions: DataFrame, k: str, cols: list[str]) -> DataFrame:
    """Values listed in the exception lookup replace the derived ones."""
    side = exceptions.select(F.col(k).alias("_ek"), *[F.col(n).alias(f"_e_{n}") for n in cols])
    joined = df.join(side, F.col(k) == F.col("_ek"), "left")
    return joined.select(*[F.coalesce(f"_e_{n}", n).alias(n) if n in cols else F.col(n) for n in df.columns])
