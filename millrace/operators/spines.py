"""Spines, series and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.functions.dates import add_part, boundary_diff
from millrace.operators.keyed import attach
from millrace.sources.session import cut_lineage


def date_spine(spark: SparkSession, part: str, start: str, end: str) -> DataFrame:
    """Consecutive starts of ``part`` from start up to, not including, end; built on executors."""
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    steps = spark.range(1).select(boundary_diff(first, last, part).alias("n"))
    numbers = steps.filter("n > 0").select(F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("i"))
    return numbers.select(add_part(first, F.col("i"), part).alias(f"date_{part}"))


def spine_per_row(df: DataFrame, start: str, end: str, part: str, out: str) -> DataFrame:
    """The date spine of every row's own [start, end)."""
    n = boundary_diff(start, end, part).cast("int")
    numbers = df.withColumn("_n", n).filter("_n > 0").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return numbers.withColumn(out, add_part(start, F.col("_i"), part)).drop("_n", "_i")


def generate_series(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).toDF("generated_number")


def series_per_row(df: DataFrame, upper: Column, out: str = "generated_number") -> DataFrame:
    """1..upper for every row; none when upper is below 1."""
    return df.withColumn("_u", upper.cast("int")).filter("_u >= 1").withColumn(out, F.explode(F.sequence(F.lit(1), F.col("_u")))).drop("_u")


def add_surrogate_key(df: DataFrame, cols: list[str], out: str = "surrogate_key") -> DataFrame:
    return df.withColumn(out, C.surrogate_key(cols))


def assign_unified_ids(df: DataFrame, choices: list[tuple[str, str]], out: str) -> DataFrame:
    """md5(prefix + id) of the first id that is known."""
    return df.withColumn(out, F.coalesce(*[F.md5(F.concat(F.lit(p), F.col(x).cast("string"))) for p, x in choices]))


def dense_ids_for_labels(df: DataFrame, col: str, out: str) -> DataFrame:
    """Stable ids 1.. in label order, numbered over the distinct labels.

    The labels are range-partitioned and written once with their partition; each is numbered inside its partition, plus the
    labels of all partitions before. Labels that share a long prefix spread as evenly as others.
    """
    ranged = df.select(col).filter(F.col(col).isNotNull()).distinct().repartitionByRange(col)
    labels = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()), "labels")
    sizes = labels.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the only window without a key.
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = labels.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(col)))
    ids = inside.join(before, "_part").select(col, (F.col("_rank") + F.col("_before")).cast("long").alias(out))
    return attach(df, ids, [col])


def null_safe_totals(df: DataFrame, k: list[str], cols: list[str], out: str = "total") -> DataFrame:
    """Row total with nulls as 0, summed per key."""
    row = sum((F.coalesce(F.col(x), F.lit(0)) for x in cols[1:]), F.coalesce(F.col(cols[0]), F.lit(0)))
    return df.groupBy(*k).agg(F.sum(row).alias(out))
