"""Small column vocabulary shared by operators and plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(x: Column | str) -> Column:
    """Two-decimal amount as exact integer cents; sums of cents never depend on row order."""
    return F.rint(c(x) * 100).cast("long")


def money(x: Column | str) -> Column:
    """Integer cents back to currency units (one double division at the very end)."""
    return c(x) / F.lit(100)


def zero(x: Column | str) -> Column:
    return F.coalesce(c(x), F.lit(0))


def is_true(x: Column | str) -> Column:
    """Null-safe truth: null counts as false."""
    return F.coalesce(c(x), F.lit(False))


def count_when(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_when(cond: Column, value: Column | str) -> Column:
    return F.sum(F.when(cond, c(value)))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def ladder(steps: list[tuple[Column, object]], default: object = None) -> Column:
    """Ordered rules to one value: the first true condition wins."""
    out = None
    for cond, value in steps:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def half_even(x: Column | str) -> Column:
    return F.rint(c(x))


def nearest_step(x: Column | str, steps_per_unit: int) -> Column:
    """Round half up to the nearest 1/steps_per_unit (20 gives 0.05 steps)."""
    return F.floor(c(x) * steps_per_unit + 0.5) / F.lit(steps_per_unit)


def text_flag(x: Column | str) -> Column:
    """'true'/'false' text to boolean; anything else is null."""
    return F.when(c(x) == "true", True).when(c(x) == "false", False)


def surrogate_key(cols: list[Column | str]) -> Column:
    """md5 over the text of the columns joined by '-', null as the empty string."""
    parts = [F.coalesce(c(x).cast("string"), F.lit("")) for x in cols]
    return F.md5(F.concat_ws("-", *parts))


def split_part(x: Column | str, sep: str, n: int) -> Column:
    """n-th piece (1-based), '' when there are fewer pieces."""
    return F.split_part(c(x), F.lit(sep), F.lit(n))


def url_host(url: Column | str) -> Column:
    bare = F.regexp_replace(c(url), r"^(https?|android-app)://", "")
    return split_part(split_part(bare, "/", 1), "?", 1)


def url_path(url: Column | str) -> Column:
    """Path without scheme, host and query; '' when the URL has no path."""
    bare = split_part(F.regexp_replace(c(url), r"^https?://", ""), "?", 1)
    return F.regexp_replace(bare, r"^[^/]*/?", "")


def page_of(url: Column | str) -> Column:
    """'/' for a missing path, else the path between single slashes."""
    path = url_path(url)
    return F.when(F.length(path) < 2, "/").otherwise(F.regexp_replace(F.concat(F.lit("/"), path, F.lit("/")), "//", "/"))


def url_parameter(url: Column | str, name: str) -> Column:
    value = split_part(split_part(url, f"{name}=", 2), "&", 1)
    return F.when(value != "", value)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance. Earth radius 3961 mi, 1.60934 km per mile (fixed values)."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    miles = 2 * 3961 * F.asin(F.sqrt(a))
    return miles * F.lit(1.60934) if unit == "km" else miles
