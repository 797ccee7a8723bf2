"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession

UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "Universal", "Etc/Universal", "Etc/Zulu"}

# What a cluster should run these jobs with. Only the time zone bears on results; queries set none of them in a session they are given.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Static, hence for the builder only: no call-site capture per Column call, which triples the time to build deep plans.
BUILDER_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "millrace") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = CLUSTER_SETTINGS | BUILDER_SETTINGS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def in_utc(spark: SparkSession) -> SparkSession:
    """The caller's session where it runs in UTC, else a sibling of it that does: the caller's settings stay as they are."""
    if spark.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return spark
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    return sibling


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return folder


def run_folder(spark: SparkSession) -> str:
    """One folder for everything that this application writes on the way to its results."""
    return f"{shared_folder(spark).rstrip('/')}/millrace-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what the application's jobs have left in the shared folder. To be called once results are written: frames that were not written yet read from there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a hub frame to the shared folder and read it back: later stages restart from the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """cut_lineage into buckets of the key, as many as the session has shuffle partitions: joins and groupings by the key need no shuffle of this frame any more.

    Meant for frames that are grouped or joined by the key already: their partitions are the buckets, and a bucket is one file. Bucketing is known from the
    catalog only; the frame is resolved, so the entry goes at once.
    """
    spark = df.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).option("compression", "zstd").option("path", scratch_path(spark, name)).saveAsTable(table)
    hub = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return hub


def cut_all(builds: dict[str, Callable[[], DataFrame]], at_once: int = 4, bucketed_by: str | None = None) -> list[DataFrame]:
    """cut_lineage (or cut_bucketed) for independent hub frames, a few jobs at a time so that small ones do not wait for each other."""
    cut = partial(cut_bucketed, key=bucketed_by) if bucketed_by else cut_lineage
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda item: cut(item[1](), item[0]), builds.items()))
