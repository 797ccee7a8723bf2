"""Projections, cleaning and predicates over whole tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.columns import any_of, is_true, ladder, text_flag


def base_projection(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """New name -> column; nothing else is read."""
    return df.select(*[(F.col(x) if isinstance(x, str) else x).alias(name) for name, x in mapping.items()])


def star_except(df: DataFrame, except_: list[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    return df.select(*[F.col(n).alias(f"{prefix}{n}{suffix}") for n in df.columns if n not in except_])


def empty_to_null(df: DataFrame) -> DataFrame:
    """'' becomes null in every text column."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select(*[F.nullif(F.col(n), F.lit("")).alias(n) if n in texts else F.col(n) for n in df.columns])


def clean_boolean_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({name: text_flag(name) for name in cols})


def clean_typed_columns(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Text to types, unparseable text to null; and how many values each column rejected."""
    parsed = {name: F.col(name).try_cast(t) for name, t in types.items()}
    rejects = [
        F.count(F.when(F.col(name).isNotNull() & parsed[name].isNull(), 1)).alias(name) for name in types
    ]
    counts = df.agg(*rejects).unpivot([], list(types), "column_name", "rejected")
    return df.withColumns(parsed), counts


def normalise_event_times(df: DataFrame, col: str, unit: str, out: str) -> DataFrame:
    """Epoch seconds or milliseconds to a timestamp."""
    convert = {"seconds": F.timestamp_seconds, "millis": F.timestamp_millis}[unit]
    return df.withColumn(out, convert(F.col(col)).cast("timestamp_ntz"))


def derived_column_chain(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Columns defined one after the other, each may use the earlier ones."""
    for name, col in steps:
        df = df.withColumn(name, col)
    return df


def classify_first_match(df: DataFrame, col: str, rules: list[tuple[str, object]], default: object, out: str) -> DataFrame:
    """First regular expression found in the lower-case text gives the label."""
    text = F.lower(F.col(col))
    return df.withColumn(out, ladder([(text.rlike(pattern), label) for pattern, label in rules], default))


def map_codes_and_count(df: DataFrame, col: str, mapping: Mapping[object, str], default: str, out: str = "label") -> DataFrame:
    label = ladder([(F.col(col) == code, name) for code, name in mapping.items()], default)
    return df.groupBy(label.alias(out)).agg(F.count(F.lit(1)).alias("num_rows"))


def banded_score(df: DataFrame, col: Column, bands: list[tuple[float, object]], lowest: object, out: str) -> DataFrame:
    """Bands given from the highest threshold down; a value reaching a threshold gets its score."""
    return df.withColumn(out, ladder([(col >= limit, score) for limit, score in bands], lowest))


def histogram_width_bucket(df: DataFrame, col: str, lo: float, hi: float, n: int) -> DataFrame:
    """Rows per equal-width bucket; 0 and n+1 hold the values outside [lo, hi)."""
    bucket = F.width_bucket(F.col(col), F.lit(float(lo)), F.lit(float(hi)), F.lit(n))
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("num_rows"))


def filter_test_traffic(df: DataFrame, rules: list[Column], exceptions: Column | None = None) -> DataFrame:
    """Drop rows that any rule marks as test traffic, unless they are excepted. Unknown is kept."""
    is_test = is_true(any_of([is_true(rule) for rule in rules]))
    keep = ~is_test if exceptions is None else ~is_test | is_true(exceptions)
    return df.filter(keep)


def spam_recipients(events: DataFrame, k: str, kind: str, bad: list[str], good: list[str]) -> DataFrame:
    """Keys with a bad event and never a good one."""
    flags = events.groupBy(k).agg(
        F.bool_or(F.col(kind).isin(bad)).alias("_bad"), F.bool_or(F.col(kind).isin(good)).alias("_good")
    )
    return flags.filter(F.col("_bad") & ~F.col("_good")).select(k)


def period_filter(df: DataFrame, ts: str, n: int, unit: str, as_of: str) -> DataFrame:
    """Rows since the start of the as-of unit minus n units."""
    months = n * {"month": 1, "quarter": 3, "year": 12}[unit]
    start = F.add_months(F.trunc(F.lit(as_of).cast("date"), unit), -months)
    return df.filter(F.col(ts) >= start.cast("timestamp_ntz"))


def unit_conversion(frames: list[tuple[DataFrame, Mapping[str, float]]]) -> DataFrame:
    """Scale the measures of each regional frame to the common unit, then union."""
    out = None
    for df, factors in frames:
        part = df.withColumns({name: F.col(name) * F.lit(factor) for name, factor in factors.items()})
        out = part if out is None else out.unionByName(part)
    return out
