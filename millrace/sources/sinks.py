"""Writers: thin persistence around the frames that operators return."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.session import scratch_path


def write_full_refresh(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Rebuild a whole table and hand back a scan of what was written."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace only the partitions present in df."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files below a folder and their bytes, largest first. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return [tuple(r) for r in files.select("path", "length").orderBy(F.col("length").desc()).collect()]


def export_parquet(df: DataFrame, root: str, table: str, as_of: str, max_bytes: int = 100 * 2**20, sample_rows: int = 100_000) -> str:
    """Dated export folder whose files hold at most ``max_bytes`` each. Returns the folder written.

    A sample of at most about ``sample_rows`` rows is written first, to see how many bytes a row takes once encoded; the rows are then dealt evenly, wide and narrow
    ones alike, to as many files as three quarters of the limit need. The folder is listed afterwards and, should a file still be too large, dealt to more
    files. Only a row that is larger than the limit by itself keeps a larger file.
    """
    spark = df.sparkSession
    stamp = "".join(ch for ch in as_of if ch.isdigit())
    path = f"{root}/{table}/{stamp}"
    rows = df.count()
    sampled = scratch_path(spark, "sample")
    df.sample(min(1.0, sample_rows / max(rows, 1)), seed=1).write.parquet(sampled)
    seen = spark.read.schema(df.schema).parquet(sampled).count()
    a_row = sum(size for _, size in file_sizes(spark, sampled)) / max(seen, 1)
    files = max(1, min(rows, math.ceil(rows * a_row / (0.75 * max_bytes))))
    while files < rows or not rows:
        df.repartition(files).write.mode("overwrite").parquet(path)
        largest = max((size for _, size in file_sizes(spark, path)), default=0)
        if largest <= max_bytes:
            return path
        files = math.ceil(files * max(largest / (0.75 * max_bytes), 1.25))
    df.write.mode("overwrite").option("maxRecordsPerFile", 1).parquet(path)
    return path


def backup_table(df: DataFrame, as_of: str) -> DataFrame:
    """The rows to keep as the backup of this table, stamped with the backup date."""
    return df.select(F.lit(as_of).cast("timestamp_ntz").alias("backup_date"), "*")
