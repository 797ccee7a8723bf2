"""Exact order statistics per key by radix refinement.

Values are read as 64-bit integers of the same order. A pass counts the rows of every key by the next 16 bits below what is known of the wanted values, at most 65,536
counters for a key and wanted value, and keeps the counter that holds the wanted rank. As many passes are made as the bits in which the values differ ask for:
two for amounts up to 43 million cents, four at most. The table is read once a pass; its rows are never sorted, and no key's rows come together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.keyed import KEY, packed
from millrace.sources.session import cut_lineage

DIGIT = 16
_FLIP = 2**63 - 1


def as_ordered(df: DataFrame, col: str) -> Column:
    """A bigint in the order of the column's values."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("long")
    if not isinstance(kind, T.FractionalType) or isinstance(kind, T.DecimalType):
        raise TypeError(f"{col} is {kind.simpleString()}: order statistics take integers and floating-point numbers")
    # The bits of a double are in its order, but for the sign.
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.col(col).cast("double") + F.lit(0.0)).cast("long")
    return F.when(F.col(col).isNotNull(), F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(_FLIP))))


def from_ordered(df: DataFrame, col: str, value: Column) -> Column:
    if isinstance(df.schema[col].dataType, T.IntegralType):
        return value
    bits = F.when(value >= 0, value).otherwise(value.bitwiseXOR(F.lit(_FLIP)))
    return F.when(value.isNotNull(), F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double"))


def exact_percentiles(df: DataFrame, k: list[str], col: str, points: Mapping[str, float], beside: Mapping[str, Column] = {}) -> DataFrame:
    """Exact interpolated percentiles (out -> p in [0, 1]) per key, null where a key has no value, and the aggregates ``beside`` them."""
    source = (packed(df, k) if k else df.withColumn(KEY, F.struct(F.lit(0).alias("_all")))).withColumn("_v", as_ordered(df, col))
    sizes = source.groupBy(KEY).agg(F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *[agg.alias(name) for name, agg in beside.items()])
    sizes = cut_lineage(sizes, "sizes")
    low, high = sizes.agg(F.min("_low"), F.max("_high")).first()
    rows = source.where("_v is not null").select(KEY, "_v")
    wanted = []
    for i, p in enumerate(points.values()):
        place = F.lit(float(p)) * (F.col("_n") - 1)
        wanted += [F.struct(F.lit(2 * i + j).alias("t"), F.floor(place) if j == 0 else F.ceil(place)) for j in (0, 1)]
    targets = sizes.where("_n > 0").select(KEY, F.inline(F.array(*[w.cast("struct<t:int,rank:bigint>") for w in wanted])))
    differing = 0 if low is None else (low ^ high).bit_length() if (low < 0) == (high < 0) else 64
    shifts = list(range(max(0, -(-differing // DIGIT) * DIGIT - DIGIT), -1, -DIGIT))
    for i, shift in enumerate(shifts):
        seen = rows.withColumn("_digit", F.shiftright("_v", shift))
        on = [KEY]
        if i:
            on = [KEY, "_prefix"]
            seen = seen.withColumn("_prefix", F.shiftright("_v", shifts[i - 1])).join(targets.select(*on).distinct(), on)
        counts = seen.groupBy(*on, "_digit").agg(F.count(F.lit(1)).alias("_rows"))
        so_far = F.sum("_rows").over(Window.partitionBy(*on).orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        reached = counts.withColumn("_upto", so_far).join(targets, on)
        hit = reached.where("rank < _upto and rank >= _upto - _rows")
        targets = hit.select(KEY, "t", F.col("_digit").alias("_prefix"), (F.col("rank") - F.col("_upto") + F.col("_rows")).alias("rank"))
        if shift:
            targets = cut_lineage(targets, "targets")
    found = targets.groupBy(KEY).agg(*[F.max(F.when(F.col("t") == t, F.col("_prefix"))).alias(f"_t{t}") for t in range(2 * len(points))])
    outs = []
    for i, (name, p) in enumerate(points.items()):
        place = F.lit(float(p)) * (F.col("_n") - 1)
        at, after = (from_ordered(df, col, F.col(f"_t{2 * i + j}")) for j in (0, 1))
        outs.append((at + (after - at) * (place - F.floor(place))).alias(name))
    return sizes.join(found, KEY, "left").select(f"{KEY}.*", *outs, *beside).drop("_all")
