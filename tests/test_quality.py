"""Every check: a passing and a failing case."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality as Q
from millrace.operators import quality_run as R
from millrace.operators.ordered import UNCHUNKED
from tests.helpers import d, rows, ts


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_value_checks(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (2, None), (None, "b")], "id int, v string")
    assert rows(Q.dq_unique(df, "id")) == [(2, 2)]
    assert Q.dq_unique(df, "id", F.col("v") == "a").count() == 0
    assert rows(Q.dq_not_null(df, "v"), "id") == [(2,)]
    assert Q.dq_not_null(df, "v", F.col("id") == 1).count() == 0
    assert rows(Q.dq_accepted_values(df, "v", ["a"])) == [("b", 2)]
    assert Q.dq_accepted_values(df, "v", ["a", "b"]).count() == 0
    assert rows(Q.dq_not_accepted_values(df, "v", ["a", "z"])) == [("a", 1)]
    assert rows(Q.dq_unique_combination(df, ["id", "v"])) == []
    assert rows(Q.dq_unique_combination(df, ["v"])) == [("b", 2)]


@pytest.mark.parametrize("inclusive,bad", [(True, [(1,), (9,)]), (False, [(1,), (2,), (8,), (9,)])])
def test_accepted_range(spark, inclusive, bad):
    df = frame(spark, [(x,) for x in (1, 2, 5, 8, 9, None)], "x int")
    assert rows(Q.dq_accepted_range(df, "x", 2, 8, inclusive)) == bad


def test_column_checks(spark):
    df = frame(spark, [(1, None, 3), (1, None, 4), (1, None, None), (1, None, 5)], "c int, n int, m int")
    assert Q.dq_at_least_one(df, "n").count() == 1 and Q.dq_at_least_one(df, "m").count() == 0
    assert Q.dq_not_constant(df, "c").count() == 1 and Q.dq_not_constant(df, "m").count() == 0
    assert Q.dq_not_null_proportion(df, "m", 0.8).first()[0] == 0.75 and Q.dq_not_null_proportion(df, "m", 0.7).count() == 0
    assert rows(Q.dq_expression_is_true(df, F.col("m") > 3), "m") == [(3,)]
    assert Q.dq_expression_is_true(df, F.col("m") > 3, F.col("m") != 3).count() == 0


def test_relationships_and_cardinality(spark):
    child = frame(spark, [(1,), (2,), (4,), (None,)], "id int")
    parent = frame(spark, [(1,), (2,), (3,)], "id int")
    assert rows(Q.dq_relationships_where(child, "id", parent, "id")) == [(4,)]
    assert Q.dq_relationships_where(child, "id", parent, "id", F.col("id") != 4).count() == 0
    assert rows(Q.dq_relationships_where(child, "id", parent, "id", F.col("id") != 4, F.col("id") != 2)) == [(2,)]
    assert rows(Q.dq_cardinality_equality(child.filter("id < 3"), "id", parent, "id")) == [(3, 1)]
    assert Q.dq_cardinality_equality(parent, "id", parent, "id").count() == 0


def test_equality_and_counts(spark):
    a = frame(spark, [(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = frame(spark, [(1, "x"), (3, None)], "k int, v string")
    assert rows(Q.dq_equality(a, b, ["k", "v"])) == [("a_minus_b", 2, "y"), ("b_minus_a", 3, None)]
    assert rows(Q.dq_equality(a, b, ["k", "v"], keep_repeats=True)) == [("a_minus_b", 1, "x"), ("a_minus_b", 2, "y"), ("b_minus_a", 3, None)]
    assert Q.dq_equality(a, a, ["k", "v"]).count() == 0
    assert rows(Q.dq_equal_rowcount(a, b)) == [(3, 2, 1)] and Q.dq_equal_rowcount(a, a).count() == 0
    assert rows(Q.dq_fewer_rows_than(a, b), "row_count_delta") == [(1,)]
    assert rows(Q.dq_fewer_rows_than(a, a), "row_count_delta") == [(1,)]
    assert Q.dq_fewer_rows_than(b, a).count() == 0


@pytest.mark.parametrize("gaps,zero,failing", [("allowed", False, [2]), ("allowed", True, []), ("required", True, []), ("not_allowed", True, [1, 2])])
def test_exclusive_ranges(spark, gaps, zero, failing):
    spans = [(1, 3, "2020-05-06", "2020-05-07"), (2, 3, "2020-05-08", "2020-05-08"), (3, 3, "2020-05-09", "2020-05-10")]
    df = frame(spark, [(i, k, d(a), d(b)) for i, k, a, b in spans], "i int, k int, a date, b date")
    for chunk in (None, F.trunc("a", "month")):
        got = Q.dq_mutually_exclusive_ranges(df, "a", "b", ["k"], chunk, gaps, zero)
        assert [r[0] for r in rows(got, "i")] == failing


def test_overlap_fails(spark):
    df = frame(spark, [(1, 5), (4, 8), (8, 9)], "a int, b int")
    assert rows(Q.dq_mutually_exclusive_ranges(df, "a", "b", [], UNCHUNKED), "a") == [(1,)]


def test_sequential_values(spark):
    evens = frame(spark, [(x,) for x in (2, 4, 6, 8, 12)], "x int")
    assert rows(Q.dq_sequential_values(evens, "x", [], F.floor(F.col("x") / F.lit(5)), 2), "x") == [(12,)]
    hours = frame(spark, [(ts(f"2021-01-01 0{h}:00:00"),) for h in range(4)], "t timestamp_ntz")
    assert Q.dq_sequential_values(hours, "t", [], UNCHUNKED, 1, "hour").count() == 0


def test_recency_and_freshness(spark):
    df = frame(spark, [(ts("2024-01-01 00:00:00"),)], "t timestamp_ntz")
    assert Q.dq_recency(df, "t", "day", 3, "2024-01-03").count() == 0 and Q.dq_recency(df, "t", "day", 1, "2024-01-03").count() == 1
    got = Q.dq_source_freshness([("a", df, "t", 10, 100), ("b", df, "t", 10, 20), ("c", df, "t", 99, 100)], "2024-01-03")
    assert rows(got, "source", "status") == [("a", "warn"), ("b", "error"), ("c", "pass")]
    assert Q.dq_weekday_freshness(df, "t", "2024-01-05").count() == 1 and Q.dq_weekday_freshness(df, "t", "2024-01-06").count() == 0


def test_daily_amounts_judge_weekdays_only(spark):
    ledger = frame(spark, [(d("2024-01-01"), "cost", -5), (d("2024-01-02"), "cost", 0)], "date date, type string, amount int")
    days = frame(spark, [(d(f"2024-01-0{i}"),) for i in range(1, 8)], "date date")
    assert rows(Q.dq_daily_amount_sanity(ledger, days), "date") == [(d(f"2024-01-0{i}"),) for i in (2, 3, 4, 5)]


@pytest.mark.parametrize("as_of,limit", [("2024-03-09", "2024-02-01"), ("2024-03-10", "2024-03-01")])
def test_closed_month(spark, as_of, limit):
    assert spark.range(1).select(Q.closed_month_limit(as_of)).first()[0] == d(limit)


def test_failure_counts(spark):
    df = frame(spark, [(1,), (1,)], "x int")
    assert rows(Q.failure_counts({"unique": Q.dq_unique(df, "x"), "null": Q.dq_not_null(df, "x")})) == [("unique", 1)]


def test_one_run_equals_the_single_checks(spark):
    """Every check of the table by itself, and all in one scan."""
    import json

    df = spark.createDataFrame(
        [(1, "a", 5.0, ts("2024-01-01"), None), (2, None, None, ts("2024-01-03"), None), (3, "a", -1.0, None, None), (3, "b", 99.0, ts("2024-01-02"), None), (None, "c", 7.0, ts("2024-01-02"), None)],
        "id int, s string, x double, at timestamp_ntz, none int").withColumn("same", F.lit("k"))
    even = F.col("id") != 2
    both = {
        "unique": (R.unique(["id"]), Q.dq_unique(df, "id")), "unique where": (R.unique(["s"], F.col("x") > 0), Q.dq_unique(df, "s", F.col("x") > 0)),
        "pair": (R.unique(["s", "same"]), Q.dq_unique_combination(df, ["s", "same"])), "null": (R.not_null("x"), Q.dq_not_null(df, "x")), "null where": (R.not_null("s", even), Q.dq_not_null(df, "s", even)),
        "values": (R.accepted_values("s", ["a", "b"]), Q.dq_accepted_values(df, "s", ["a", "b"])), "not values": (R.not_accepted_values("s", ["a"]), Q.dq_not_accepted_values(df, "s", ["a"])),
        "range": (R.accepted_range("x", 0, 50), Q.dq_accepted_range(df, "x", 0, 50)), "open range": (R.accepted_range("x", 5, None, False), Q.dq_accepted_range(df, "x", 5, None, False)),
        "expression": (R.expression_is_true(F.col("x") > 6), Q.dq_expression_is_true(df, F.col("x") > 6)), "expression where": (R.expression_is_true(F.col("x") > 6, F.col("s") == "a"), Q.dq_expression_is_true(df, F.col("x") > 6, F.col("s") == "a")),
        "one": (R.at_least_one("none"), Q.dq_at_least_one(df, "none")), "one there": (R.at_least_one("s"), Q.dq_at_least_one(df, "s")),
        "constant": (R.not_constant("same"), Q.dq_not_constant(df, "same")), "varies": (R.not_constant("s"), Q.dq_not_constant(df, "s")), "all null": (R.not_constant("none"), Q.dq_not_constant(df, "none")),
        "share": (R.not_null_proportion("x", 0.9), Q.dq_not_null_proportion(df, "x", 0.9)), "share fine": (R.not_null_proportion("x", 0.1), Q.dq_not_null_proportion(df, "x", 0.1)),
        "old": (R.recency("at", "day", 5, "2024-02-01"), Q.dq_recency(df, "at", "day", 5, "2024-02-01")), "fresh": (R.recency("at", "day", 5, "2024-01-05"), Q.dq_recency(df, "at", "day", 5, "2024-01-05")),
    }
    run = R.run_checks(df, ["id", "s", "x"], {name: check for name, (check, _) in both.items()})
    found = {}
    for r in run.collect():
        found.setdefault(r.check_id, []).append(r)
    for name, (check, single) in both.items():
        mine, want = found.get(name, []), single.collect()
        if check.key is None:
            assert sorted(json.dumps(json.loads(r.key)) for r in mine for _ in range(r.n_rows)) == sorted(json.dumps({"id": r.id, "s": r.s, "x": r.x}) for r in want), name
        elif check.key:
            assert sorted((r.n_rows, str(list(json.loads(r.key).values()))) for r in mine) == sorted((r.n_records, str(list(r)[:-1])) for r in want), name
        else:
            assert len(mine) == len(want) and all(r.n_rows == 5 and r.key is None for r in mine), name
    assert found["share"][0].measure == 0.8 and found["one"][0].measure == 0


def test_one_run_over_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, at timestamp_ntz")
    checks = {"u": R.unique(["id"]), "o": R.at_least_one("id"), "c": R.not_constant("id"), "p": R.not_null_proportion("id", 0.9), "r": R.recency("at", "day", 1, "2024-01-01")}
    assert rows(R.run_checks(df, ["id"], checks)) == [("o", None, 0, 0.0)]


def test_one_run_reads_the_table_once(spark):
    from millrace.catalog import load
    from tests.helpers import plan

    text = plan(load()["dq_run_orders"](spark, "/root/testdata/sf0.001"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
