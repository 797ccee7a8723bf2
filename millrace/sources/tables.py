"""Registered sources: where each table lives and how fresh it has to be."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Source:
    name: str
    key: tuple[str, ...]
    loaded_at: str | None = None
    warn_hours: int | None = None
    error_hours: int | None = None


SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source("region", ("r_regionkey",)),
        Source("nation", ("n_nationkey",)),
        Source("customer", ("c_custkey",)),
        Source("supplier", ("s_suppkey",)),
        Source("part", ("p_partkey",)),
        Source("orders", ("o_orderkey",), "o_orderdate", 24, 24 * 60),
        Source("lineitem", (), "l_shipdate", 12, 24),
        Source("events", ("event_id",), "ts", 12, 24),
        Source("documents", ("doc_id",)),
        Source("embeddings", ("vec_id",)),
        Source("pages", ("page_id",)),
        Source("benchmark", ("item_id",)),
        Source("labels", ("doc_id",)),
        Source("conversations", ("conv_id", "turn")),
    )
}


def read_source(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Scan one registered table; filters and column choice reach the Parquet reader."""
    if table not in SOURCES:
        raise KeyError(f"unregistered source {table!r}")
    return spark.read.parquet(f"{root}/{SOURCES[table].name}.parquet")


def read_seed(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A small typed lookup given inline; its size is fixed by the caller's literal."""
    return spark.createDataFrame(rows, schema)


def read_seed_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A small typed lookup kept as CSV with a header; no type inference pass."""
    return spark.read.csv(path, header=True, schema=schema)


def read_tables_by_pattern(
    frames: Mapping[str, DataFrame], pattern: str, exclude: str | None = None, source_col: str = "_source"
) -> DataFrame:
    """Union of all frames whose name matches, over the superset of their columns, with lineage."""
    names = [n for n in frames if re.search(pattern, n) and not (exclude and re.search(exclude, n))]
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    out = None
    for name in names:
        part = frames[name].withColumn(source_col, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def catalog_tables(spark: SparkSession, pattern: str) -> dict[str, DataFrame]:
    """Session tables and views by name pattern, ready for read_tables_by_pattern."""
    return {t.name: spark.table(t.name) for t in spark.catalog.listTables(pattern=pattern)}


class Tables(Mapping):
    """The registered tables under one folder, listed once when first asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = read_source(self.spark, self.root, name)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)


class Derived(Tables):
    """Tables with frames in place of some: ``dealt`` ones hold their rows in buckets of the order, ``more`` are frames that the job has written once."""

    def __init__(self, tables: Tables, dealt: Mapping[str, DataFrame], more: Mapping[str, DataFrame]):
        super().__init__(tables.spark, tables.root)
        self._frames.update({**dealt, **more})
        self.dealt = frozenset(dealt)


def is_dealt(t: Mapping[str, DataFrame], name: str) -> bool:
    """Whether the rows of an order lie in one task."""
    return name in getattr(t, "dealt", ())
