"""Set operations and source succession."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keyed import only_matching


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def union_relations(
    relations: Mapping[str, DataFrame], overrides: Mapping[str, str] | None = None, include: list[str] | None = None,
    exclude: list[str] | None = None, source_col: str = "_source",
) -> DataFrame:
    """Union over the superset of columns with a lineage column and optional type overrides."""
    overrides = overrides or {}
    out = None
    for name, df in relations.items():
        cols = [x for x in df.columns if (not include or x in include) and (not exclude or x not in exclude)]
        part = df.select(F.lit(name).alias(source_col), *[F.col(x).cast(overrides[x]).alias(x) if x in overrides else F.col(x) for x in cols])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def except_rows(a: DataFrame, b: DataFrame, keep_repeats: bool = False) -> DataFrame:
    return a.exceptAll(b) if keep_repeats else a.subtract(b)


def intersect_rows(a: DataFrame, b: DataFrame, keep_repeats: bool = False) -> DataFrame:
    return a.intersectAll(b) if keep_repeats else a.intersect(b)


def source_succession(
    old: DataFrame, new: DataFrame, k: list[str] | None = None, old_until: Column | None = None, new_from: Column | None = None
) -> DataFrame:
    """Old source before a cut-over and new source after it, or the new source plus what only the old one has."""
    if k:
        return new.unionByName(only_matching(old, new, k, "left_anti"))
    return old.filter(old_until).unionByName(new.filter(new_from))
