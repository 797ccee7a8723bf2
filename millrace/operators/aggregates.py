"""Grouped aggregations. All of them combine partially before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from millrace.functions.columns import ladder
from millrace.operators.keyed import KEY, attach, packed
from millrace.operators.selection import exact_percentiles
from millrace.operators.spines import dense_ids_for_labels
from millrace.sources.session import cut_lineage


def group_agg(df: DataFrame, k: list[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*k).agg(*[agg.alias(name) for name, agg in aggs.items()])


def conditional_agg(df: DataFrame, k: list[str], spec: Mapping[str, tuple[str, Column, Column | str]]) -> DataFrame:
    """name -> (function name, condition, value): aggregate of the values whose row meets the condition."""
    aggs = {}
    for name, (fn, cond, value) in spec.items():
        value = F.col(value) if isinstance(value, str) else value
        aggs[name] = getattr(F, fn)(F.when(cond, value))
    return group_agg(df, k, aggs)


def count_distinct(df: DataFrame, k: list[str], spec: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """Distinct counts under conditions.

    Rows are first reduced to the distinct combinations of key, value and condition outcome,
    so a hot key is counted from its distinct values only.
    """
    slim = df.select(*k, *[F.when(cond, F.col(col)).alias(name) for name, (cond, col) in spec.items()])
    return slim.groupBy(*k).agg(*[F.count_distinct(F.col(name)).alias(name) for name in spec])


def bool_aggs(df: DataFrame, k: list[str], conds: Mapping[str, Column]) -> DataFrame:
    """any_<name> and all_<name> per key."""
    aggs: dict[str, Column] = {}
    for name, cond in conds.items():
        aggs |= {f"any_{name}": F.bool_or(cond), f"all_{name}": F.bool_and(cond)}
    return group_agg(df, k, aggs)


def any_value_agg(df: DataFrame, k: list[str], cols: list[str]) -> DataFrame:
    """One reproducible value per key and column (the smallest), with the row count."""
    return group_agg(df, k, {c: F.min(c) for c in cols} | {"num_rows": F.count(F.lit(1))})


def listagg_ordered(df: DataFrame, k: list[str], col: str, out: str, sep: str = ", ") -> DataFrame:
    """Distinct values of a bounded label column as one ordered, separated text per key. ``listagg_over`` names the keys that break a bound."""
    labels = df.filter(F.col(col).isNotNull()).select(*k, col).distinct()
    return labels.groupBy(*k).agg(F.array_join(F.array_sort(F.collect_list(col)), sep).alias(out))


def listagg_over(df: DataFrame, k: list[str], col: str, most_chars: int) -> DataFrame:
    """Keys whose distinct values come to more than ``most_chars`` characters, with that number: to be checked before texts are put together."""
    labels = df.filter(F.col(col).isNotNull()).select(*k, col).distinct()
    return labels.groupBy(*k).agg(F.sum(F.length(col)).alias("n_chars")).filter(F.col("n_chars") > most_chars)


def median_stddev(df: DataFrame, k: list[str], col: str, digits: int = 4) -> DataFrame:
    """Exact median and sample standard deviation per key."""
    return exact_percentiles(df, k, col, {"median": 0.5}, {"stddev": F.round(F.stddev_samp(col), digits)})


def percentile_tier(df: DataFrame, part: list[str], col: str, tiers: list[tuple[float, str]], lowest: str) -> DataFrame:
    """Label every row by the highest percentile of its partition that it exceeds."""
    points = {f"_p{i}": p for i, (p, _) in enumerate(tiers)}
    limits = exact_percentiles(df, part, col, points)
    steps = [(F.col(col) > F.col(f"_p{i}"), label) for i, (_, label) in enumerate(tiers)]
    return attach(df, limits, part).withColumn("tier", ladder(steps, lowest)).drop(*points)


def strict_sum(df: DataFrame, k: list[str], cols: list[str]) -> DataFrame:
    """Sum per key, null as soon as one value of the key is null."""
    return group_agg(df, k, {c: F.when(F.count(F.lit(1)) == F.count(c), F.sum(c)) for c in cols})


def all_some_none(df: DataFrame, k: list[str], cond: Column, out: str) -> DataFrame:
    hits = F.count(F.when(cond, F.lit(1)))
    status = F.when(hits == F.count(F.lit(1)), "all").when(hits > 0, "some").otherwise("none")
    return group_agg(df, k, {out: status})


def having_filter(df: DataFrame, k: list[str], aggs: Mapping[str, Column], cond: Column) -> DataFrame:
    return group_agg(df, k, aggs).filter(cond)


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def scalar_subquery_agg(df: DataFrame, sub: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row, as scalar subqueries."""
    return df.withColumns({name: sub.select(name).scalar() for name in sub.columns})


def ratio_to_report(df: DataFrame, part: list[str], label: list[str], col: str, out: str) -> DataFrame:
    """Share of each label in its partition's total; both sums are partial aggregates."""
    rows = packed(df, part)
    sums = rows.groupBy(KEY, *label).agg(F.sum(col).alias(col))
    totals = rows.groupBy(KEY).agg(F.sum(col).alias("_total"))
    return sums.join(totals, KEY, "left").select(f"{KEY}.*", *label, col, (F.col(col) / F.col("_total")).alias(out))


def pivot_conditional(
    df: DataFrame, k: list[str], col: str, values: list[str], agg: str = "sum",
    then_value: Column | None = None, else_value: object = 0, prefix: str = "", suffix: str = "", distinct: bool = False,
) -> DataFrame:
    """One column per listed value: the aggregate of then_value where it matches, else else_value."""
    then_value = F.lit(1) if then_value is None else then_value
    aggs = {}
    for value in values:
        cell = F.when(F.col(col) == value, then_value).otherwise(F.lit(else_value))
        aggs[f"{prefix}{value}{suffix}"] = F.count_distinct(cell) if distinct else getattr(F, agg)(cell)
    return group_agg(df, k, aggs)


def unpivot(df: DataFrame, ids: list[str], cols: list[str], var: str = "field_name", val: str = "value", keep_nulls: bool = True) -> DataFrame:
    """Columns to (name, text value) rows."""
    as_text = df.select(*ids, *[F.col(name).cast("string").alias(name) for name in cols])
    out = as_text.unpivot(ids, cols, var, val)
    return out if keep_nulls else out.filter(F.col(val).isNotNull())


def column_values(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Values by falling frequency; ties in value order."""
    out = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    out = out.orderBy(F.col("num_rows").desc(), F.col("value").asc())
    return out.limit(n) if n else out


def calendar_rollup(df: DataFrame, k: list[str], ts: str, unit: str, aggs: Mapping[str, Column]) -> DataFrame:
    return group_agg(df.withColumn(unit, F.trunc(F.col(ts), unit)), [*k, unit], aggs)


def residual_allocation(parent: DataFrame, child: DataFrame, k: list[str], col: str, eps: float, label: str) -> DataFrame:
    """Child rows plus one row per key for the part of the parent total that no child explains.

    parent: k, col; child: k, item, col. Differences within +-eps are rounding, not residuals.
    """
    explained = child.groupBy(*k).agg(F.sum(col).alias("_explained"))
    gap = attach(parent.groupBy(*k).agg(F.sum(col).alias(col)), explained, k)
    gap = gap.withColumn(col, F.col(col) - F.coalesce("_explained", F.lit(0)))
    rest = gap.filter(F.abs(F.col(col)) > eps).select(*k, F.lit(label).alias("item"), col)
    return child.select(*k, "item", col).unionByName(rest)


def id_bitmaps(df: DataFrame, k: list[str], col: str) -> DataFrame:
    """Exact sets of the column's values per key, as bitmaps of 32,768 ids: k, ``bucket`` and ``bits``. Rows of one bucket lie together.

    Whole numbers are their own ids; other values get dense ids first. Repeats are dropped before the first shuffle and bitmaps are built
    where a bucket's ids have come together: built from scattered ids they would be larger than the rows.
    """
    rows = df.where(F.col(col).isNotNull())
    if isinstance(df.schema[col].dataType, IntegralType):
        rows = rows.select(*k, F.col(col).cast("long").alias("_id"))
    else:
        rows = dense_ids_for_labels(cut_lineage(rows.select(*k, col).distinct(), "labelled"), col, "_id")
    ids = rows.select(*k, F.bitmap_bucket_number("_id").alias("bucket"), F.bitmap_bit_position("_id").alias("_bit")).distinct()
    return ids.repartition("bucket").groupBy("bucket", *k).agg(F.bitmap_construct_agg("_bit").alias("bits"))


def rolling_distinct_12m(df: DataFrame, ts: str, entity: str, as_of: str, months: int = 24, span: int = 12) -> DataFrame:
    """Distinct entities active in the span months up to each of the last ``months`` months.

    Entities become bitmaps per month and bucket of ids; the report slides a union over the months of a bucket and adds up what the unions hold. No
    row is repeated for the months that it counts in.
    """
    this_month = F.trunc(F.lit(as_of).cast("date"), "month")
    number = lambda day: F.year(day) * 12 + F.month(day) - 1
    last = number(this_month)
    active = df.select(number(F.col(ts)).alias("_m"), entity).where(F.col("_m").between(last - (months + span - 2), last))
    sets = id_bitmaps(active, ["_m"], entity).withColumn("_asked", F.lit(False))
    # One more row a bucket and report month, so that months without own rows have their union, too.
    asked = sets.groupBy("bucket").agg(F.max(last).alias("_last"))
    asked = asked.select(F.explode(F.sequence(F.col("_last") - (months - 1), F.col("_last"))).alias("_m"), "bucket", F.lit(None).cast("binary").alias("bits"), F.lit(True).alias("_asked"))
    frame = Window.partitionBy("bucket").orderBy("_m").rangeBetween(-(span - 1), 0)
    unions = sets.select("_m", "bucket", "bits", "_asked").unionAll(asked).withColumn("_union", F.bitmap_or_agg("bits").over(frame)).where("_asked")
    counted = unions.groupBy("_m").agg(F.sum(F.bitmap_count("_union")).alias("entities")).where("entities > 0")
    return counted.select(F.make_date(F.floor(F.col("_m") / 12).cast("int"), F.col("_m") % 12 + 1, F.lit(1)).alias("month"), "entities")
