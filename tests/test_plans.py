"""Physical plans of registered queries."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.catalog import load
from millrace.operators.keyed import join_known
from tests.helpers import plan

SF = "/root/testdata/sf0.001"

@pytest.mark.parametrize(("name", "most"), [("partition_aggs", 2), ("rank_first", 2), ("is_last_flag", 2), ("first_last_full_frame", 2), ("nth_event", 2), ("ratio_to_report", 3)])
def test_keyed_aggregates_keep_the_partitioning(spark, no_broadcasts, name, most):
    assert plan(load()[name](spark, SF)).count("Exchange hashpartitioning") <= most


def test_scan_reads_only_what_is_used(spark):
    text = plan(entry.queries()["ratio_to_report"](spark, SF))
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_returnflag:string>", text)


def test_filters_reach_the_scan(spark):
    text = plan(entry.queries()["period_filter"](spark, SF))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", text)


def test_status_history_needs_no_shuffle(spark):
    assert "Exchange" not in plan(entry.queries()["status_history"](spark, SF))


def test_bucketed_sides_meet_without_a_shuffle(spark, no_broadcasts):
    """Only the orders, their stages and their quotes are shuffled by order."""
    text = plan(load()["order_fact"](spark, SF))
    assert text.count("FileScan parquet spark_catalog") == 3 and len(re.findall(r"Exchange hashpartitioning\(order_id#\w+, \d", text)) <= 3


def test_sides_of_an_order_read_lines_where_they_were_dealt(spark, no_broadcasts):
    """Documents, their versions and their purchase orders need no shuffle once the lines are dealt by order; nor do the funnels once bids are marked."""
    from millrace.catalog import documents, sourcing
    from millrace.catalog.orders import dealt_by_order, quoted
    from millrace.sources.tables import Tables

    t = dealt_by_order(Tables(spark, SF))
    assert t["rates"].inputFiles() and set(t["rates"].columns) == {"currency", "date", "rate"}
    for side in (quoted, sourcing.auction_funnel):
        assert "Exchange" not in plan(side(t))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000000")
    for side in (documents.document_versions, documents.increments):
        assert not re.search(r"Exchange hashpartitioning\((order_id|doc_id|currency|_group)", plan(side(t)))


def test_a_bucketed_frame_outlives_its_catalog_entry(spark, no_broadcasts):
    from millrace.sources.session import cut_bucketed

    before = {t.name for t in spark.catalog.listTables()}
    left, right = (cut_bucketed(spark.range(n).selectExpr("id % 50 as k").groupBy("k").count(), "hub", "k") for n in (100, 90))
    assert {t.name for t in spark.catalog.listTables()} == before
    both = left.join(right.withColumnRenamed("count", "other"), "k")
    assert "Exchange" not in plan(both) and both.count() == 50


def test_unknown_keys_are_spread_over_partitions(spark, no_broadcasts):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(4000).selectExpr("id", "if(id % 10 = 0, id % 7, null) as k")
        side = spark.range(5).selectExpr("id as k", "id * 2 as v").groupBy("k").agg(F.max("v").alias("v"))
        out = join_known(rows, side, "k", "id").withColumn("at", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted((r.id, r.k, r.v) for r in out) == [(i, i % 7 if i % 10 == 0 else None, i % 7 * 2 if i % 10 == 0 and i % 7 < 5 else None) for i in range(4000)]
    assert len({r.at for r in out if r.k is None}) > 1


def test_bids_are_dealt_once_by_auction_and_once_by_order_and_supplier(spark, no_broadcasts):
    """The other two shuffles are those of the auction heads."""
    assert plan(load()["bid_behaviour"](spark, SF)).count("Exchange hashpartitioning") == 4


def test_funnel_counts_need_no_copies_of_the_bids(spark, no_broadcasts):
    text = plan(load()["auction_funnel"](spark, SF))
    assert "Expand" not in text and text.count("Exchange hashpartitioning") == 4


def test_shipments_are_dealt_by_order_once(spark, no_broadcasts):
    """Test orders, the first of a leg and the orders without shipment: no second shuffle by order, none by order and leg."""
    text = plan(load()["shipment_fact"](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\w+L, \d", text)) <= 2 and "Exchange hashpartitioning(order_id#" in text
    assert not re.search(r"Exchange hashpartitioning\(order_id#\w+L, leg", text)


def test_history_takes_one_pass(spark, no_broadcasts):
    """Lines give what is asked and what was delivered at once: one shuffle of partial sums, one for the windows."""
    from datetime import datetime, timedelta

    from millrace.plans import quality_risk

    day = lambda n: datetime(2000, 1, 3) + timedelta(days=n)
    lines = [(i % 3 if i % 11 else None, ["CNC", "3DP", None][i % 5 % 3], i * 5 % 90, i * 5 % 90 + i % 9 if i % 4 else None, i * 5 % 90 + i % 31 if i % 3 else None) for i in range(200)] + [(7, "3DP", 10, 12, 13)]
    at = lambda n: None if n is None else day(n)
    rows = spark.createDataFrame([(k, t, at(s), at(d), at(x), s // 7) for k, t, s, d, x in lines], "key int, technology string, shipped_at timestamp_ntz, delivered_at timestamp_ntz, disputed_at timestamp_ntz, days int")
    rows = rows.withColumn("week", quality_risk.week_index("shipped_at")).drop("days")
    out = quality_risk.history_at(rows, ["key"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    first = min(r.week for r in rows.collect())
    got = {(r.key, r.week - first): r for r in out.collect()}
    for k in {x[0] for x in lines}:
        made = [x for x in lines if x[0] == k and x[1] == "CNC"]
        for week in {x[2] // 7 for x in lines if x[0] == k}:
            base = min(x[2] // 7 for x in lines)
            done = [x for x in made if x[3] is not None and x[3] // 7 <= week]
            recent = [x for x in done if x[3] // 7 > week - 6]
            bad = lambda some: sum(x[4] is not None and x[4] <= x[3] + 14 for x in some)
            share = lambda some: (bad(some) * 200 + len(some)) // (len(some) * 2) if bad(some) else None
            r = got[k, week - base]
            assert (r.lines_so_far, r.running_percent, r.recent_percent, r._known) == (len(done), share(done), share(recent), bool(made))


def test_both_histories_come_from_one_dealing(spark, no_broadcasts):
    """Rows that are dealt by the fewer keys are not shuffled again and not joined, and hold what history_at tells of their week; rows without a key have no history by it."""
    from datetime import datetime, timedelta

    from millrace.plans import quality_risk

    at = lambda n: None if n is None else datetime(2000, 1, 3) + timedelta(days=n)
    lines = [
        (i, i % 3 if i % 11 else None, "ab"[i % 2] if i % 13 else None, ["CNC", "3DP", None][i % 5 % 3], at(i * 5 % 90), at(i * 5 % 90 + i % 9 if i % 4 else None), at(i * 5 % 90 + i % 31 if i % 3 else None))
        for i in [*range(200), 7, 7, 8]
    ]
    rows = spark.createDataFrame(lines, "line int, s int, m string, technology string, shipped_at timestamp_ntz, delivered_at timestamp_ntz, disputed_at timestamp_ntz")
    rows = rows.withColumn("week", quality_risk.week_index("shipped_at"))
    out = quality_risk.with_histories(rows.repartition("s"), ["s", "m"], ["s"])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
    both = quality_risk.history_at(rows, ["s", "m"])
    part = quality_risk.history_at(rows, ["s"]).select("s", "week", F.col("recent_percent").alias("part_percent"))
    want = rows.join(both, ["s", "m", "week"], "left").join(part, ["s", "week"], "left")
    names = ["line", "week", "recent_percent", "running_percent", "lines_so_far", "_known", "part_percent"]
    got = sorted(map(tuple, out.select(names).collect()), key=str)
    assert got == sorted(map(tuple, want.select(names).collect()), key=str) and len(got) == len(lines)
    assert len({g[2] for g in got}) > 2 and len({g[6] for g in got}) > 2
