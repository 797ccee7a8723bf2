"""Partitioned Parquet tables whose current files are listed by a manifest.

A commit writes its rows to a folder of its own, ``data/commit=N/<partitions>``, and then one small file, ``manifest/v=N``, that lists for every partition the
commits whose folders hold its rows, with their number and the maxima of chosen columns. Readers take the newest manifest, so a commit is seen whole or not at all:
what a failed one left behind is never listed, and the next one of that number overwrites it. A partition that loses its last row is listed no more.

Beside the data lies, in the same folders below ``keys``, a 64-bit hash of every row's key: which partitions a batch of keys can touch is read from there, at
eight bytes a row, and from no other column. One writer at a time; any number of readers.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.functions.columns import any_of
from millrace.operators.keyed import only_matching
from millrace.operators.windows import first_rows
from millrace.sources.session import cut_lineage


@dataclass(frozen=True)
class ManifestTable:
    spark: SparkSession
    path: str
    schema: StructType
    part: list[str]
    k: list[str] = field(default_factory=list)
    #: Columns whose maxima the manifest keeps for each partition.
    maxima: list[str] = field(default_factory=list)

    def version(self) -> int:
        """Number of the newest commit; -1 before the first. Manifests are listed, not read."""
        try:
            listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.path}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1
        return max((int(re.search(r"/v=(\d+)/", file)[1]) for file in listed.inputFiles()), default=-1)

    def entries(self) -> list[Row]:
        """The newest manifest: one row for each partition and commit that holds rows of it. As many rows as the table has folders."""
        newest = self.version()
        if newest < 0:
            return []
        return self.spark.read.schema(self.entry_schema).parquet(f"{self.path}/manifest/v={newest}").where("commit is not null").collect()

    @property
    def entry_schema(self) -> StructType:
        fields = [self.schema[x] for x in self.part] + [StructField("n", LongType())] + [StructField(f"max_{x}", self.schema[x].dataType) for x in self.maxima]
        return StructType([*fields, StructField("commit", LongType())])

    def highest(self, column: str):
        """The column's maximum over the table, from the manifest alone."""
        return max((r[f"max_{column}"] for r in self.entries() if r[f"max_{column}"] is not None), default=None)

    def read(self, only: Iterable[tuple] | None = None) -> DataFrame:
        """The rows of the table, or of some partitions: no other folder is opened."""
        return self._scan("data", self.schema, self._listed(only)).select(*self.schema.names)

    def touched(self, batch: DataFrame) -> list[tuple]:
        """Partitions that hold a key of the batch (or a key of the same hash), and those the batch has rows for."""
        parts = StructType([f for f in self.schema if f.name in self.part])
        keys = self._scan("keys", StructType([*parts]).add("key_hash", "long"), self._listed(None))
        held = keys.join(batch.select(self._hash().alias("key_hash")).distinct(), "key_hash", "left_semi").select(*self.part)
        return [tuple(r) for r in held.union(batch.select(*self.part)).distinct().collect()]

    def commit(self, rows: DataFrame, replaced: Iterable[tuple] = ()) -> None:
        """Add rows; the partitions in ``replaced`` hold nothing but what ``rows`` has for them afterwards."""
        number, gone = self.version() + 1, set(replaced)
        kept = [r for r in (self.entries() if number else []) if self._values(r) not in gone]
        rows.select(*self.schema.names).write.mode("overwrite").partitionBy(*self.part).parquet(f"{self.path}/data/commit={number}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/commit={number}")
        if self.k:
            hashed = written.select(*self.part, self._hash().alias("key_hash"))
            hashed.write.mode("overwrite").partitionBy(*self.part).parquet(f"{self.path}/keys/commit={number}")
        facts = [F.count(F.lit(1)).alias("n"), *[F.max(x).alias(f"max_{x}") for x in self.maxima]]
        added = written.groupBy(*self.part).agg(*facts).withColumn("commit", F.lit(number).cast("long"))
        # One file, which is there or is not. A table without rows has one, too: of one row without a commit.
        names = self.entry_schema.names
        listed = [tuple(r) for r in kept] + [tuple(r) for r in added.select(*names).collect()] + [(None,) * len(names)]
        nullable = StructType([StructField(f.name, f.dataType) for f in self.entry_schema])
        manifest = self.spark.createDataFrame(listed, nullable).withColumn("v", F.lit(number).cast("long"))
        manifest.coalesce(1).write.mode("append").partitionBy("v").parquet(f"{self.path}/manifest")

    def _values(self, entry: Row) -> tuple:
        return tuple(entry[x] for x in self.part)

    def _listed(self, only: Iterable[tuple] | None) -> list[Row]:
        wanted = None if only is None else set(only)
        return [r for r in self.entries() if wanted is None or self._values(r) in wanted]

    def _hash(self) -> Column:
        return F.xxhash64(*self.k)

    def _scan(self, kind: str, schema: StructType, listed: list[Row]) -> DataFrame:
        if not listed:
            return self.spark.createDataFrame([], schema)
        commits: dict[int, list[tuple]] = {}
        for r in listed:
            commits.setdefault(r["commit"], []).append(self._values(r))
        folders = [f"{self.path}/{kind}/commit={c}" for c in sorted(commits)]
        rows = self.spark.read.schema(StructType([*schema]).add("commit", "long")).option("basePath", f"{self.path}/{kind}").parquet(*folders)
        # Only partition columns: folders that are not listed are not opened.
        return rows.where(any_of([(F.col("commit") == c) & self._among(values) for c, values in commits.items()])).drop("commit")

    def _among(self, values: list[tuple]) -> Column:
        if len(self.part) == 1:
            some = [v for (v,) in values if v is not None]
            tests = ([F.col(self.part[0]).isin(some)] if some else []) + ([F.col(self.part[0]).isNull()] if len(some) < len(values) else [])
            return any_of(tests)
        return any_of([reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.lit(v)) for x, v in zip(self.part, value, strict=True)]) for value in values])


def merge(table: ManifestTable, new: DataFrame, watermarks: list[str] = (), latest: list[str] | None = None) -> list[tuple]:
    """Upsert on the table's key. Returns the partitions that were read and written again; no other data was.

    Only rows at or after one of the table's maxima of ``watermarks`` are candidates; ``latest`` is the order that picks one of several candidates of a key.
    A row whose partition changes leaves its old one.
    """
    if watermarks:
        highs = {x: table.highest(x) for x in watermarks}
        new = new.where(any_of([F.col(x) >= (F.col(x) if high is None else F.lit(high)) for x, high in highs.items()]))
    if latest:
        new = first_rows(new, table.k, latest)
    batch = cut_lineage(new.select(*table.schema.names), "batch")
    touched = table.touched(batch)
    if touched:
        table.commit(only_matching(table.read(touched), batch, table.k, "left_anti").unionByName(batch), touched)
    return touched
