"""Column functions against fixed examples and brute force."""

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.functions import dates as D
from tests.helpers import d, ts


@pytest.mark.parametrize("a,b,part,n", [
    ("2018-01-01 01:00:00", "2018-01-02 01:00:00", "day", 1), ("2018-01-01 01:00:00", "2018-02-01 01:00:00", "month", 1),
    ("2018-01-01 01:00:00", "2019-01-01 01:00:00", "year", 1), ("2018-01-01 01:00:00", "2018-01-01 02:00:00", "hour", 1),
    ("2018-01-01 01:00:00", "2018-01-01 02:01:00", "minute", 61), ("2018-01-01 01:00:00", "2018-01-01 02:00:01", "second", 3601),
    ("2019-12-31 00:00:00", "2019-12-27 00:00:00", "week", -1), ("2019-12-31 00:00:00", "2019-12-30 00:00:00", "week", 0),
    ("2019-12-31 00:00:00", "2020-01-02 00:00:00", "week", 0), ("2019-12-31 00:00:00", "2020-01-06 02:00:00", "week", 1),
    ("2018-01-01 00:00:59", "2018-01-01 00:01:01", "minute", 1), ("2018-03-31 00:00:00", "2018-04-01 00:00:00", "quarter", 1),
    (None, "2018-01-01 02:00:00", "hour", None), ("2018-01-01 02:00:00", None, "hour", None),
])
def test_boundary_diff(spark, a, b, part, n):
    df = spark.createDataFrame([(ts(a), ts(b))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(D.boundary_diff("a", "b", part)).first()[0] == n


@pytest.mark.parametrize("a,n,part,want", [
    ("2018-01-01 01:00:00", 1, "day", "2018-01-02 01:00:00"), ("2018-01-01 01:00:00", 1, "month", "2018-02-01 01:00:00"),
    ("2018-01-01 01:00:00", 1, "year", "2019-01-01 01:00:00"), ("2018-01-01 01:00:00", 1, "hour", "2018-01-01 02:00:00"),
    ("2018-01-31 01:00:00", 1, "month", "2018-02-28 01:00:00"), ("2018-01-01 01:00:00", -2, "week", "2017-12-18 01:00:00"), (None, 1, "day", None),
])
def test_add_part(spark, a, n, part, want):
    df = spark.createDataFrame([(ts(a),)], "a timestamp_ntz")
    assert df.select(D.add_part("a", n, part)).first()[0] == ts(want)


def test_last_day_of(spark):
    df = spark.createDataFrame([(d("2018-01-02"),)], "a date")
    got = df.select(*[D.last_day_of("a", p) for p in ("month", "quarter", "year")]).first()
    assert tuple(got) == (d("2018-01-31"), d("2018-03-31"), d("2018-12-31"))


def test_surrogate_key(spark):
    data = [("a", "b", "c"), ("a", None, "c"), (None, None, None)]
    df = spark.createDataFrame(data, "x string, y string, z string")
    got = [tuple(r) for r in df.select(C.surrogate_key(["x"]), C.surrogate_key(["x", "y", "z"])).collect()]
    want = [(hashlib.md5((r[0] or "").encode()).hexdigest(), hashlib.md5("-".join(v or "" for v in r).encode()).hexdigest()) for r in data]
    assert got == want
    assert got[0][0] == "0cc175b9c0f1b6a831c399e269772661" and got[2][0] == "d41d8cd98f00b204e9800998ecf8427e"


@pytest.mark.parametrize("url,host,path", [
    ("www.example.co.uk?utm_source=a&utm_medium=cpc", "www.example.co.uk", ""), ("http://example.com/2018/01/tips/", "example.com", "2018/01/tips/"),
    ("https://www.example.com/2018/blog?x=1", "www.example.com", "2018/blog"), ("android-app://m.example.com/", "m.example.com", None), ("docs.example.com/a/index.js?utm_source=g", "docs.example.com", "a/index.js"),
    ("example.com", "example.com", ""),
])
def test_url_parts(spark, url, host, path):
    df = spark.createDataFrame([(url,)], "u string")
    got = df.select(C.url_host("u"), C.url_path("u")).first()
    assert got[0] == host
    if path is not None:
        assert got[1] == path


def test_url_parameter(spark):
    df = spark.createDataFrame([("http://e.com/m?utm_medium=organic",), ("http://e.com/m?utm_medium=organic&utm_source=github",)], "u string")
    got = [tuple(r) for r in df.select(C.url_parameter("u", "utm_medium"), C.url_parameter("u", "utm_source")).collect()]
    assert got == [("organic", None), ("organic", "github")]


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    cols = [F.col(x) for x in "abcd"]
    got = df.select(F.round(C.haversine(*cols, unit="km"), 0), F.round(C.haversine(*cols), 0)).first()
    assert tuple(got) == (430.0, 267.0)


def test_nearest_step_and_half_even(spark):
    df = spark.createDataFrame([(0.974, 2.5), (0.976, 3.5), (1.0249, -2.5)], "a double, b double")
    got = [tuple(r) for r in df.select(C.nearest_step("a", 20), C.half_even("b")).collect()]
    assert got == [(0.95, 2.0), (1.0, 4.0), (1.0, -2.0)]


def brute_business_minutes(a, b):
    minutes, at = 0, a
    while at < b:
        if at.weekday() < 5 and 9 <= at.hour < 18:
            minutes += 1
        at += timedelta(minutes=1)
    return minutes


def test_business_minutes_match_a_minute_by_minute_count(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(25):
        a = datetime(2001, 3, 1) + timedelta(minutes=rng.randrange(40 * 1440))
        pairs.append((a, a + timedelta(minutes=rng.randrange(14 * 1440))))
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    snapped = df.withColumns({"s": D.snap_to_opening("a"), "e": D.snap_to_opening("b")})
    for r in snapped.withColumn("m", D.business_minutes("s", "e")).collect():
        assert r.s.weekday() < 5 and 9 <= r.s.hour < 18
        assert r.m == brute_business_minutes(r.a, r.b), r


def test_weekend_days_match_a_day_by_day_count(spark):
    first = d("2001-01-01")
    pairs = [(first + timedelta(days=i), first + timedelta(days=i + n)) for i in range(9) for n in range(17)]
    df = spark.createDataFrame(pairs, "a date, b date")
    for r in df.withColumn("n", D.weekend_days_between("a", "b")).collect():
        days = [r.a + timedelta(days=i) for i in range((r.b - r.a).days + 1)]
        assert r.n == sum(x.weekday() == 5 or (x.weekday() == 6 and x > r.a) for x in days)
