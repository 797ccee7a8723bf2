"""Window-style operators that reduce to filters on rank or to grouped aggregates.

``row_number() <= n`` filters are pruned before the shuffle (Spark keeps at most n rows per key
and input partition), and full-frame values are computed as partial aggregates and joined back,
so no operator here gathers a key's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.keyed import KEY, attach, attach_aggs, order_struct, packed
from millrace.operators.ordered import running_total


def _sort(o: list[str]) -> list[Column]:
    """'col' ascending, '-col' descending."""
    return [F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc() for name in o]


def first_rows(df: DataFrame, k: list[str], o: list[str], n: int = 1, out: str | None = None) -> DataFrame:
    """The first n rows of every key in the given total order."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*k).orderBy(*_sort(o)))).filter(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", out) if out else ranked.drop("_rn")


def dedupe_latest(df: DataFrame, k: list[str], o: list[str]) -> DataFrame:
    """Keep one row per key, the first in the order (use '-updated_at' for the latest)."""
    return first_rows(df, k, o)


def topk_per_group(df: DataFrame, k: list[str], o: list[str], n: int, out: str = "rank") -> DataFrame:
    return first_rows(df, k, o, n, out)


def rank_first(df: DataFrame, k: list[str], o: list[str]) -> DataFrame:
    """All rows that share the first position of their key (ties kept)."""
    best = attach_aggs(df, k, {"_first": F.min(order_struct(o))})
    # "Not after the first" keeps the order out of the join keys, so the rows need no shuffle by it.
    return best.filter(order_struct(o) <= F.col("_first")).drop("_first")


def dense_rank_group(df: DataFrame, k: list[str], col: str, out: str, chunk: Column | None) -> DataFrame:
    """Dense rank of col inside the key: the distinct values are numbered (along chunks) and joined back."""
    values = df.select(*k, col).distinct().withColumn("_one", F.lit(1))
    return attach(df, running_total(values, k, [col], "_one", out, chunk).drop("_one"), [*k, col])


def first_last_full_frame(
    df: DataFrame, k: list[str], o: list[str], cols: list[str], ignore_nulls: bool = True
) -> DataFrame:
    """first_<col> and last_<col> over all rows of the key, attached to every row."""
    aggs = {}
    for col in cols:
        order = F.when(F.col(col).isNotNull(), order_struct(o)) if ignore_nulls else order_struct(o)
        aggs |= {f"first_{col}": F.min_by(col, order), f"last_{col}": F.max_by(col, order)}
    return attach_aggs(df, k, aggs)


def nth_event(df: DataFrame, k: list[str], o: list[str], cols: dict[str, str], n: int) -> DataFrame:
    """Values of the key's n-th row (null when there are fewer), attached to every row."""
    rows = packed(df, k)
    picked = first_rows(rows, [KEY], o, n, "_rn").filter(F.col("_rn") == n)
    return rows.join(picked.select(KEY, *[F.col(col).alias(out) for out, col in cols.items()]), KEY, "left").drop(KEY)


def partition_aggs(df: DataFrame, k: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates over all rows of the key, attached to every row."""
    return attach_aggs(df, k, aggs)


def moving_sum_rows(
    df: DataFrame, k: list[str], o: str, aggs: dict[str, Column], sums: dict[str, tuple[str, int]]
) -> DataFrame:
    """Aggregate to (key, o) first, then sum each column over n preceding rows and the current one."""
    grouped = df.groupBy(*k, o).agg(*[agg.alias(name) for name, agg in aggs.items()])
    w = Window.partitionBy(*k).orderBy(o)
    return grouped.withColumns({out: F.sum(col).over(w.rowsBetween(-n, 0)) for out, (col, n) in sums.items()})


def window_over_aggregate(df: DataFrame, k: list[str], aggs: dict[str, Column], over: dict[str, Column]) -> DataFrame:
    """Group, then evaluate window columns on the grouped result."""
    return df.groupBy(*k).agg(*[agg.alias(name) for name, agg in aggs.items()]).withColumns(over)


def is_last_flag(df: DataFrame, k: list[str], o: list[str], out: str = "is_last") -> DataFrame:
    """True on the last row of the key in a total order."""
    last = attach_aggs(df, k, {"_last": F.max(order_struct(o))})
    return last.withColumn(out, order_struct(o) == F.col("_last")).drop("_last")


def deterministic_pick(df: DataFrame, k: list[str]) -> DataFrame:
    """One reproducible row per key: the smallest by all remaining columns."""
    rest = [name for name in df.columns if name not in k]
    picked = df.groupBy(*k).agg(F.min(order_struct(rest)).alias("_row"))
    return picked.select(*k, "_row.*")


def order_limit(df: DataFrame, o: list[str], n: int) -> DataFrame:
    """Top-n report over a total order (each partition keeps n rows before the merge)."""
    return df.orderBy(*_sort(o)).limit(n)
