"""Chunked ordered operators equal the plain windows, with a hot key, null keys and null values."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import ordered as O
from millrace.operators import selection as S
from millrace.operators import windows as W
from tests.helpers import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; some keys and values are null; times tie."""
    rng = random.Random(11)
    data = []
    for i in range(900):
        key = 7 if i % 3 == 0 else (None if i % 17 == 0 else rng.randrange(20))
        data.append((i, key, rng.randrange(400), None if rng.random() < 0.3 else rng.randrange(50)))
    return spark.createDataFrame(data, "id int, k int, t int, v int").repartition(5).cache()


def chunk():
    return F.floor(F.col("t") / F.lit(30))


def test_lag_and_lead(skewed):
    for fn in (O.lag_delta, O.lead_values):
        plain = fn(skewed, ["k"], ["t", "id"], {"x": "v", "y": "id"}, O.UNCHUNKED)
        assert rows(fn(skewed, ["k"], ["t", "id"], {"x": "v", "y": "id"}, chunk())) == rows(plain)


def test_fills(skewed):
    for fn in (O.forward_fill, O.backward_fill):
        assert rows(fn(skewed, ["k"], ["t", "id"], "v", "x", chunk())) == rows(fn(skewed, ["k"], ["t", "id"], "v", "x", O.UNCHUNKED))


def test_running_total_and_sequence(skewed):
    assert rows(O.running_total(skewed, ["k"], ["t", "id"], "v", "x", chunk())) == rows(O.running_total(skewed, ["k"], ["t", "id"], "v", "x", O.UNCHUNKED))
    cond = F.col("id") % 2 == 0
    got = O.sequence_number_in_group(skewed, ["k"], ["t", "id"], cond, "n", chunk())
    assert rows(got) == rows(O.sequence_number_in_group(skewed, ["k"], ["t", "id"], cond, "n", O.UNCHUNKED))


def test_no_key_at_all(skewed):
    got = O.running_total(skewed, [], ["t", "id"], "v", "x", chunk())
    assert rows(got) == rows(O.running_total(skewed, [], ["t", "id"], "v", "x", O.UNCHUNKED))


def test_rank_in_group(skewed):
    want = skewed.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy("t")))
    assert rows(O.rank_in_group(skewed, ["k"], "t", "r", chunk())) == rows(want)


def test_status_duration_skips_unknown_states(spark):
    df = spark.sql("select * from values (1, timestamp_ntz'2024-01-01 00:00:00', 'a'), (1, timestamp_ntz'2024-01-01 00:00:30', null), (1, timestamp_ntz'2024-01-02 00:00:00', 'b') v(k, ts, s)")
    got = O.status_duration(df.withColumn("id", F.lit(0)), ["k"], "ts", "s", ["id"], F.to_date("ts"))
    assert {r.s: r.seconds_in_state for r in got.collect()} == {"a": 86400, "b": None}


@pytest.mark.parametrize("kind", ["long", "int", "double", "float"])
@pytest.mark.parametrize("factor", [1, 1_000_003, -3])
def test_percentiles_are_exact(skewed, kind, factor):
    typed = skewed.withColumn("v", (F.col("v") * factor - (0 if kind in ("long", "int") else 0.37)).cast(kind))
    got = {r.k: (r.p0, r.p50, r.p90, r.p100, r.n) for r in S.exact_percentiles(typed, ["k"], "v", {"p0": 0, "p50": 0.5, "p90": 0.9, "p100": 1}, {"n": F.count("v")}).collect()}
    want = typed.groupBy("k").agg(*[F.percentile("v", p).alias(f"p{i}") for i, p in enumerate((0.0, 0.5, 0.9, 1.0))], F.count("v").alias("n")).collect()
    assert set(got) == {r.k for r in want}
    for r in want:
        assert got[r.k] == (pytest.approx(r.p0), pytest.approx(r.p1), pytest.approx(r.p2), pytest.approx(r.p3), r.n)


def test_percentiles_over_all_bits(spark):
    values = [-(2**63), -(2**40) - 7, -65537, -1, 0, 1, 65535, 65536, 2**33, 2**63 - 1]
    assert S.exact_percentiles(spark.createDataFrame([], "k string, v long"), ["k"], "v", {"p": 0.5}).count() == 0
    for some in (values, values[5:], values[3:5], [5, 5, 5], [None, None]):
        df = spark.createDataFrame([(None, v) for v in some], "k string, v long")
        picks = S.exact_percentiles(df, ["k"], "v", {f"p{i}": i / max(len(some) - 1, 1) for i in range(len(some))})
        assert [tuple(r)[1:] for r in picks.collect()] == [tuple(float(v) if v is not None else None for v in sorted(some, key=lambda v: v or 0))]
    odd = [float("-inf"), -1e300, -0.0, 0.0, 5e-324, 1.5, float("inf")]
    df = spark.createDataFrame([(v,) for v in odd], "v double")
    assert [r.p for r in [S.exact_percentiles(df, [], "v", {"p": i / 6}).first() for i in (1, 2, 4, 5)]] == [-1e300, 0.0, 5e-324, 1.5]
    with pytest.raises(TypeError):
        S.exact_percentiles(spark.createDataFrame([("x",)], "v string"), [], "v", {"p": 0.5})


def test_median_stddev(skewed):
    values = [r.v for r in skewed.filter("k = 7 and v is not null").collect()]
    got = {r.k: r for r in A.median_stddev(skewed, ["k"], "v").collect()}[7]
    assert got["median"] == statistics.median(values)
    assert got["stddev"] == pytest.approx(statistics.stdev(values), abs=1e-4)


def test_rank_windows(skewed):
    w = Window.partitionBy("k")
    first = skewed.withColumn("r", F.rank().over(w.orderBy("t"))).filter("r = 1").drop("r")
    assert rows(W.rank_first(skewed, ["k"], ["t"])) == rows(first)
    dense = skewed.withColumn("d", F.dense_rank().over(w.orderBy("t")))
    assert rows(W.dense_rank_group(skewed, ["k"], "t", "d", O.UNCHUNKED)) == rows(dense)
    assert rows(W.dense_rank_group(skewed, ["k"], "t", "d", chunk())) == rows(dense)
    last = skewed.withColumn("is_last", F.row_number().over(w.orderBy(F.desc("t"), F.desc("id"))) == 1)
    assert rows(W.is_last_flag(skewed, ["k"], ["t", "id"])) == rows(last)
    full = w.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = skewed.withColumns({"first_v": F.first("v", True).over(full), "last_v": F.last("v", True).over(full)})
    assert rows(W.first_last_full_frame(skewed, ["k"], ["t", "id"], ["v"])) == rows(want)


def test_first_rows_prune_before_the_shuffle(skewed):
    plan = W.dedupe_latest(skewed, ["k"], ["-t", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_labels_that_share_a_prefix_are_numbered_over_many_partitions(spark):
    from millrace.operators.spines import dense_ids_for_labels

    labels = [f"a common prefix {i:05d}" for i in range(900)] + [None, "zz", ""]
    df = spark.createDataFrame([(x,) for x in labels * 2], "name string")
    want = {x: i + 1 for i, x in enumerate(sorted({x for x in labels if x is not None}))} | {None: None}
    assert {r.name: r.n for r in dense_ids_for_labels(df, "name", "n").collect()} == want
