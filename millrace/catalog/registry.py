"""Query registration."""

from __future__ import annotations

import textwrap
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.session import in_utc
from millrace.sources.tables import Tables

AS_OF = "2001-09-01 00:00:00"

_WIDER = {
    T.ByteType: "long",
    T.ShortType: "long",
    T.IntegerType: "long",
    T.FloatType: "double",
    T.DecimalType: "double",
    T.DateType: "timestamp_ntz",
    T.TimestampType: "timestamp_ntz",
}


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return widen(self.build(Tables(in_utc(spark), sf_dir)))


def widen(df: DataFrame) -> DataFrame:
    """One output type per kind: bigint, double, timestamp, text, boolean."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(_WIDER[type(f.dataType)]).alias(f.name) if type(f.dataType) in _WIDER else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


ENTRIES: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    def wrap(build: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = Entry(name, build, textwrap.dedent(sql).strip() if sql else None)
        return build

    return wrap
