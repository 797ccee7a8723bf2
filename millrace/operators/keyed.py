"""Helpers to match frames on key columns, nulls matching nulls."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "_key"


def attach(df: DataFrame, side: DataFrame, k: list[str], how: str = "left", null_keys: bool = True) -> DataFrame:
    """Join a keyed side (one row per key) back to the rows it was derived from.

    Nulls in the key match each other, as they do in a grouping; ``null_keys=False`` where the key has none saves the
    extra join columns that this costs. A hot key stays splittable: the side holds one row per key, so adaptive skew
    handling may cut the big side at will. Both inputs are evaluated: write an expensive ``df`` once (cut_lineage) before.
    """
    if not null_keys:
        return df.join(side, k, how)
    renamed = side.withColumnsRenamed({name: f"_r_{name}" for name in k})
    cond = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in k])
    return df.join(renamed, cond, how).drop(*[f"_r_{name}" for name in k])


def packed(df: DataFrame, k: list[str]) -> DataFrame:
    """Add the key as one struct column. Structs with equal fields are equal even where fields are null, so an aggregate by it joins back
    with plain equality, and rows shuffled by it once stay where they are."""
    return df.withColumn(KEY, F.struct(*[F.col(name) for name in k]))


def attach_aggs(df: DataFrame, k: list[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregates over the rows of the key, attached to every row: one shuffle for the partial aggregates, one for the rows."""
    rows = packed(df, k)
    return rows.join(rows.groupBy(KEY).agg(*[agg.alias(name) for name, agg in aggs.items()]), KEY, "left").drop(KEY)


def attach_spread(rows: DataFrame, facts: DataFrame, k: list[str], part: str = "part") -> DataFrame:
    """Inner join with one fact row a key, where a key may hold any share of the rows: rows are dealt by key and ``part``, and a fact goes to the parts that have its key."""
    parts = rows.select(*k, part).distinct().join(facts, k)
    return rows.join(parts, [*k, part])


def only_matching(df: DataFrame, keys: DataFrame, k: list[str], how: str) -> DataFrame:
    """left_semi / left_anti on key columns."""
    renamed = keys.select(*[F.col(name).alias(f"_r_{name}") for name in k])
    cond = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in k])
    return df.join(renamed, cond, how)


def order_struct(o: list[str]):
    return F.struct(*[F.col(name) for name in o])


def join_known(df: DataFrame, side: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on a key that many left rows lack.

    Unknown keys match nothing, yet would all hash to one partition; a part of the key, derived from ``spread_by``, spreads them.
    Key and part are one struct: a constant second column on the side would be folded out of the join keys. The side holds no null keys.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(1024)) + 1).otherwise(F.lit(0).cast("long"))
    left = df.withColumn("_spread", F.struct(F.col(key).alias("known"), spread.alias("part")))
    right = side.withColumn("_known", F.struct(F.col(key).alias("known"), F.lit(0).cast("long").alias("part"))).drop(key)
    return left.join(right, F.col("_spread") == F.col("_known"), "left").drop("_spread", "_known")
