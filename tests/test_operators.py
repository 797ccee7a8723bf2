"""Operators on small frames with known results."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import joins as J
from millrace.operators import projections as P
from millrace.operators import sets as U
from millrace.operators import spines as N
from millrace.operators.keyed import join_known
from tests.helpers import d, rows, ts


def test_date_spine_excludes_its_end(spark):
    got = [r[0] for r in N.date_spine(spark, "day", "2018-01-01", "2018-01-10").orderBy("date_day").collect()]
    assert got[0] == ts("2018-01-01") and got[-1] == ts("2018-01-09") and len(got) == 9
    assert N.date_spine(spark, "hour", "2018-01-01", "2018-01-02").count() == 24
    assert N.date_spine(spark, "month", "2018-01-01", "2018-01-01").count() == 0


def test_generate_series(spark):
    assert [r[0] for r in N.generate_series(spark, 10).collect()] == list(range(1, 11))


def test_width_bucket_edges(spark):
    df = spark.createDataFrame([(x,) for x in (190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0)], "amount double")
    got = rows(P.histogram_width_bucket(df, "amount", 200000, 600000, 4))
    assert got == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 1), (5, 1)]


def test_bool_aggs(spark):
    df = spark.createDataFrame([("abc", 1, 1), ("abc", 1, 0), ("def", 1, 0), ("hij", 1, 1), ("hij", 1, None), ("klm", 1, 0), ("klm", 1, None)], "key string, a int, b int")
    assert rows(A.bool_aggs(df, ["key"], {"eq": F.col("a") == F.col("b")}), "key", "any_eq") == [("abc", True), ("def", False), ("hij", True), ("klm", False)]


def test_pivot_with_apostrophe_and_missing_value(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    got = A.pivot_conditional(df, ["size"], "color", ["red", "blue", "blue's"])
    assert rows(got, "size", "red", "blue", "`blue's`") == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_unpivot_keeps_nulls_and_writes_booleans(spark):
    df = spark.createDataFrame([(123, "active", True), (567, "churned", None)], "id int, status string, is_updated boolean")
    assert rows(A.unpivot(df, ["id"], ["status", "is_updated"], "prop", "val")) == [(123, "is_updated", "true"), (123, "status", "active"), (567, "is_updated", None), (567, "status", "churned")]
    assert A.unpivot(df, ["id"], ["status", "is_updated"], keep_nulls=False).count() == 3


def test_union_relations_superset(spark):
    a = spark.createDataFrame([(1, "x", "pi")], "id int, name string, fav string")
    b = spark.createDataFrame([(2, "green", 7)], "id int, color string, fav int")
    got = U.union_relations({"a": a, "b": b}, {"fav": "string"})
    assert rows(got, "_source", "id", "name", "fav", "color") == [("a", 1, "x", "pi", None), ("b", 2, None, "7", "green")]
    assert U.union_relations({"a": a, "b": b}, {"fav": "string"}, exclude=["fav"]).columns == ["_source", "id", "name", "color"]


def test_empty_to_null_and_typed_columns(spark):
    df = spark.createDataFrame([("", "1", 3), ("a", "n/a", 4), (None, None, 5)], "f string, g string, h int")
    assert rows(P.empty_to_null(df), "f") == [(None,), (None,), ("a",)]
    clean, rejects = P.clean_typed_columns(df, {"g": "int"})
    assert rows(clean, "g") == [(None,), (None,), (1,)]
    assert rows(rejects) == [("g", 1)]


def test_filter_test_traffic_keeps_unknown_and_excepted(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None), (4, True)], "id int, is_test boolean")
    assert rows(P.filter_test_traffic(df, [F.col("is_test")], F.col("id") == 4), "id") == [(2,), (3,), (4,)]


def test_asof_join_with_gaps_and_open_end(spark):
    history = spark.createDataFrame(
        [(1, ts("2020-01-01"), ts("2020-02-01"), "a"), (1, ts("2020-03-01"), None, "b"), (2, ts("2020-01-01"), None, "c")], "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, v string"
    )
    fact = spark.createDataFrame([(i, k, ts(t)) for i, (k, t) in enumerate([
        (1, "2019-12-31"), (1, "2020-01-01"), (1, "2020-01-31"), (1, "2020-02-01"), (1, "2020-06-01"), (2, "2021-01-01"), (3, "2021-01-01"),
    ])], "id int, k int, at timestamp_ntz")
    got = J.asof_scd2_join(fact, history, [("k", "k")], "at", ["v"], lambda x: F.trunc(x, "month"))
    assert [r[1] for r in rows(got, "id", "v")] == [None, "a", "a", None, "b", "c", None]


def test_interval_load_equals_expansion(spark):
    data = [(i, i % 3, d(f"2020-01-{1 + i % 20:02d}"), d(f"2020-02-{1 + (i * 7) % 20:02d}"), i) for i in range(40)] + [(99, 0, d("2020-01-05"), d("2020-01-05"), 5)]
    df = spark.createDataFrame(data, "id int, g int, a date, b date, v int")
    days = J.interval_expand_join(df, "a", "b").groupBy("g", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("load"))
    assert rows(J.interval_overlap_load(df, "a", "b", ["g"], F.col("v"))) == rows(days)
    lengths = J.interval_expand_join(df, "a", "b").groupBy("id").count()
    assert all(r["count"] == (r.b - r.a).days for r in lengths.join(df, "id").collect())


def test_disjunctive_join_first_alternative_wins_and_rows_do_not_multiply(spark):
    left = spark.createDataFrame([(1, 10, "x"), (2, None, "y"), (3, 99, "zz")], "id int, k int, name string")
    right = spark.createDataFrame([(10, "q", "by key"), (11, "x", "by name x"), (12, "y", "first y"), (13, "y", "second y")], "k2 int, n2 string, label string")
    got = J.disjunctive_join(left, right, [("k", "k2"), ("name", "n2")], ["label"])
    assert rows(got, "id", "label") == [(1, "by key"), (2, "first y"), (3, None)]


def test_full_outer_reconcile_reasons(spark):
    prod = spark.createDataFrame([(1, "a", 100), (2, "b", 500), (4, "d", None)], "k int, s string, v int")
    backup = spark.createDataFrame([(1, "a", 150), (2, "x", 500), (3, "c", 1), (4, "d", 5)], "k int, s string, v int")
    got = J.full_outer_reconcile(prod, backup, "k", {"s": None, "v": 100})
    assert rows(got, "k", "reason") == [(2, "s changed"), (3, "missing in production"), (4, "v changed")]


def test_split_and_product(spark):
    df = spark.createDataFrame([(1, "a, b,,c"), (2, "")], "id int, t string")
    assert rows(J.split_to_rows(df, "t", ",", "w"), "id", "w") == [(1, "a"), (1, "b"), (1, "c")]
    lists = {"x": F.array(F.lit(1), F.lit(2)), "y": F.array().cast("array<int>")}
    assert rows(J.multi_list_product(df.select("id"), lists)) == [(1, 1, None), (1, 2, None), (2, 1, None), (2, 2, None)]


def test_join_known_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(i, None if i % 2 else i) for i in range(10)], "id int, k int")
    side = spark.createDataFrame([(0, "zero"), (2, "two")], "k int, v string")
    got = join_known(left, side, "k", "id")
    assert got.count() == 10 and rows(got.filter("v is not null"), "id", "v") == [(0, "zero"), (2, "two")]


def test_residual_allocation_ignores_rounding(spark):
    parent = spark.createDataFrame([(1, 100), (2, 50), (3, 7)], "k int, c int")
    child = spark.createDataFrame([(1, "a", 60), (1, "b", 38), (2, "a", 20)], "k int, item string, c int")
    got = A.residual_allocation(parent, child, ["k"], "c", 3, "rest")
    assert rows(got.filter("item = 'rest'")) == [(2, "rest", 30), (3, "rest", 7)]


def test_strict_sum_and_null_safe_totals(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, None, 3), (2, 4, 5)], "k int, a int, b int")
    assert rows(A.strict_sum(df, ["k"], ["a", "b"])) == [(1, None, 5), (2, 4, 5)]
    assert rows(N.null_safe_totals(df, ["k"], ["a", "b"])) == [(1, 6), (2, 9)]


def test_rolling_distinct_counts_by_hand(spark):
    data = [(1, "2020-01-15"), (1, "2020-06-15"), (2, "2019-02-01"), (3, "2018-01-01")]
    df = spark.createDataFrame([(e, ts(t)) for e, t in data], "e int, t timestamp_ntz")
    got = {r.month: r.entities for r in A.rolling_distinct_12m(df, "t", "e", "2020-12-10", months=24).collect()}
    for m, n in got.items():
        low = (m.year * 12 + m.month - 11)
        want = {e for e, t in data if low <= ts(t).year * 12 + ts(t).month <= m.year * 12 + m.month}
        assert n == len(want)
    assert got[d("2020-12-01")] == 1 and got[d("2020-01-01")] == 2


def test_dense_ids_follow_label_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("ca",), (None,), ("cb",)], "x string")
    assert rows(N.dense_ids_for_labels(df, "x", "n")) == [(None, None), ("a", 1), ("b", 2), ("b", 2), ("ca", 3), ("cb", 4)]


@pytest.mark.parametrize("unit,n,want", [("year", 2, 3), ("month", 1, 1)])
def test_period_filter(spark, unit, n, want):
    df = spark.createDataFrame([(ts(x),) for x in ("1998-12-31", "1999-01-01", "2000-05-05", "2001-08-01")], "t timestamp_ntz")
    assert P.period_filter(df, "t", n, unit, "2001-09-01").count() == want


def test_assembly_sides_are_checked_for_repeats(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    side = spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    assert J.repeated_keys(side, ["k"]).count() == 0
    assert J.repeated_keys(side.unionAll(side), ["k"]).count() == 2
    assert rows(J.wide_fact_assembly(base, "k", [side])) == [(1, "a"), (2, None)]


def test_listagg_over_names_the_keys_that_break_the_bound(spark):
    df = spark.createDataFrame([("a", "xx"), ("a", "xx"), ("a", "yyy"), ("b", "z"), ("c", None)], "k string, v string")
    assert rows(A.listagg_over(df, ["k"], "v", 4)) == [("a", 5)]


@pytest.mark.parametrize("entity", ["id", "name"])
def test_rolling_distinct_equals_counting_each_window(spark, entity):
    import random
    from datetime import date, datetime

    rng = random.Random(3)
    data = [(rng.choice([-5, 0, 1, 7, 32767, 32768, 32769, 70_000, 10**12]), datetime(2018 + rng.randrange(4), rng.randint(1, 12), rng.randint(1, 28))) for _ in range(150)]
    data += [(7, datetime(2020, 5, 5))] * 100 + [(None, datetime(2020, 5, 5)), (8, None)]
    df = spark.createDataFrame([(i, f"n{i}" if i is not None else None, t) for i, t in data], "id long, name string, t timestamp_ntz")
    got = {r.month: r.entities for r in A.rolling_distinct_12m(df, "t", entity, "2021-03-10", months=20, span=5).collect()}
    want = {}
    for back in range(20):
        m = 2021 * 12 + 2 - back
        n = len({i for i, t in data if i is not None and t is not None and m - 4 <= t.year * 12 + t.month - 1 <= m})
        if n:
            want[date(m // 12, m % 12 + 1, 1)] = n
    assert got == want
