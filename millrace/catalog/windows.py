"""Window queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.catalog.registry import register
from millrace.functions.columns import cents
from millrace.functions.dates import day
from millrace.operators import ordered as O
from millrace.operators import windows as W


def quarter():
    return F.trunc("o_orderdate", "quarter")

LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@register("dedupe_latest", """
    select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_partkey desc, l_suppkey, l_extendedprice, l_quantity) as rn from (
        select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate from lineitem))
    where rn = 1""")
def dedupe_latest(t):
    lines = t["lineitem"].drop("l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return W.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], ["-l_shipdate", "-l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])


@register("rank_first", """
    select * exclude (r) from (select o_orderkey, o_custkey, o_orderdate, rank() over (partition by o_custkey order by o_orderdate) as r from orders)
    where r = 1""")
def rank_first(t):
    return W.rank_first(t["orders"].select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderdate"])


@register("dense_rank_group", """
    select o_orderkey, o_custkey, date_trunc('month', o_orderdate)::timestamp as project_month,
           dense_rank() over (partition by o_custkey order by date_trunc('month', o_orderdate)) as project_number
    from orders""")
def dense_rank_group(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", F.trunc("o_orderdate", "month").alias("project_month"))
    return W.dense_rank_group(orders, ["o_custkey"], "project_month", "project_number", F.trunc("project_month", "year"))


@register("sequence_number_in_group", """
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_shipdate, l_extendedprice, l_quantity, l_suppkey,
           case when l_returnflag = 'R' then row_number() over (partition by l_orderkey, l_returnflag
             order by l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) end as return_number
    from lineitem""")
def sequence_number_in_group(t):
    lines = t["lineitem"].select("l_orderkey", *LINE_ORDER, "l_returnflag")
    out = O.sequence_number_in_group(
        lines, ["l_orderkey"], LINE_ORDER, F.col("l_returnflag") == "R", "return_number", F.trunc("l_shipdate", "quarter")
    )
    return out.drop("l_returnflag")


@register("lag_delta", """
    select o_orderkey, o_custkey, lag(o_orderkey) over w as previous_order,
           date_diff('day', lag(o_orderdate) over w, o_orderdate) as days_since_previous,
           (round(o_totalprice * 100)::bigint - coalesce(lag(round(o_totalprice * 100)::bigint) over w, 0)) as delta_cents
    from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def lag_delta(t):
    orders = t["orders"].withColumn("cents", cents("o_totalprice"))
    prev = O.lag_delta(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
        {"previous_order": "o_orderkey", "prev_date": "o_orderdate", "prev_cents": "cents"}, quarter(),
    )
    return prev.select(
        "o_orderkey", "o_custkey", "previous_order", F.datediff("o_orderdate", "prev_date").alias("days_since_previous"),
        (F.col("cents") - F.coalesce("prev_cents", F.lit(0))).alias("delta_cents"),
    )


@register("status_duration", """
    with stated as (select event_id, user_id, ts, event_type as state from events where event_type <> 'view')
    select *, lead(state) over w as next_state, lead(ts) over w as next_at,
           (epoch_us(lead(ts) over w) // 1000000 - epoch_us(ts) // 1000000) as seconds_in_state
    from stated window w as (partition by user_id order by ts, event_id)""")
def status_duration(t):
    events = t["events"].select("event_id", "user_id", "ts", F.nullif("event_type", F.lit("view")).alias("state"))
    return O.status_duration(events, ["user_id"], "ts", "state", ["event_id"], day("ts"))


@register("forward_fill", """
    select event_id, user_id, ts, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (
             partition by user_id order by ts, event_id rows between unbounded preceding and current row) as last_signup
    from events""")
def forward_fill(t):
    events = t["events"].select("event_id", "user_id", "ts", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("signup"))
    return O.forward_fill(events, ["user_id"], ["ts", "event_id"], "signup", "last_signup", day("ts")).drop("signup")


@register("backward_fill", """
    select event_id, user_id, ts, first_value(case when event_type = 'purchase' then ts end ignore nulls) over (
             partition by user_id order by ts, event_id rows between current row and unbounded following) as next_purchase_at
    from events""")
def backward_fill(t):
    events = t["events"].select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("ts")).alias("bought_at"))
    return O.backward_fill(events, ["user_id"], ["ts", "event_id"], "bought_at", "next_purchase_at", day("ts")).drop("bought_at")


@register("first_last_full_frame", """
    with e as (select event_id, user_id, ts, nullif(event_type, 'view') as state, nullif(value, 0.0) as amount from events)
    select event_id, user_id, first_value(state ignore nulls) over w as first_state, last_value(state ignore nulls) over w as last_state,
           first_value(amount ignore nulls) over w as first_amount, last_value(amount ignore nulls) over w as last_amount
    from e window w as (partition by user_id order by ts, event_id rows between unbounded preceding and unbounded following)""")
def first_last_full_frame(t):
    events = t["events"].select(
        "event_id", "user_id", "ts", F.nullif("event_type", F.lit("view")).alias("state"), F.nullif("value", F.lit(0.0)).alias("amount")
    )
    out = W.first_last_full_frame(events, ["user_id"], ["ts", "event_id"], ["state", "amount"])
    return out.drop("ts", "state", "amount")


@register("nth_event", """
    select o_orderkey, o_custkey, nth_value(o_orderkey, 2) over w as second_order, nth_value(o_orderdate, 2) over w as second_order_at
    from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and unbounded following)""")
def nth_event(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    picked = {"second_order": "o_orderkey", "second_order_at": "o_orderdate"}
    return W.nth_event(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], picked, 2).drop("o_orderdate")


@register("partition_aggs", """
    select o_orderkey, o_custkey, min(o_orderdate) over w as first_at, max(o_orderdate) over w as last_at,
           sum(round(o_totalprice * 100)::bigint) over w::bigint / 100 as lifetime_total, count(*) over w as n_orders
    from orders window w as (partition by o_custkey)""")
def partition_aggs(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = W.partition_aggs(orders, ["o_custkey"], {
        "first_at": F.min("o_orderdate"), "last_at": F.max("o_orderdate"),
        "lifetime_total": F.sum(cents("o_totalprice")) / F.lit(100), "n_orders": F.count(F.lit(1)),
    })
    return out.drop("o_orderdate", "o_totalprice")


@register("moving_sum_rows", """
    with m as (select l_suppkey, date_trunc('month', l_shipdate)::timestamp as month, sum(l_quantity) as qty, count(*) as n from lineitem group by 1, 2)
    select *, sum(qty) over (partition by l_suppkey order by month rows between 5 preceding and current row) as qty_rows_6,
           sum(n) over (partition by l_suppkey order by month rows between 23 preceding and current row)::bigint as n_rows_24
    from m""")
def moving_sum_rows(t):
    lines = t["lineitem"].withColumn("month", F.trunc("l_shipdate", "month"))
    return W.moving_sum_rows(
        lines, ["l_suppkey"], "month", {"qty": F.sum("l_quantity"), "n": F.count(F.lit(1))},
        {"qty_rows_6": ("qty", 5), "n_rows_24": ("n", 23)},
    )


@register("running_total", """
    select o_orderkey, o_custkey, sum(round(o_totalprice * 100)::bigint) over (
      partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and current row)::bigint as running_cents
    from orders""")
def running_total(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", cents("o_totalprice").alias("cents"))
    out = O.running_total(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "cents", "running_cents", quarter())
    return out.drop("o_orderdate", "cents")


@register("window_over_aggregate", """
    with g as (select l_suppkey, date_trunc('month', l_shipdate)::timestamp as month, sum(l_quantity) as qty from lineitem group by 1, 2)
    select *, rank() over (partition by l_suppkey order by qty desc, month) as qty_rank,
           sum(qty) over (partition by l_suppkey) as supplier_qty from g""")
def window_over_aggregate(t):
    lines = t["lineitem"].withColumn("month", F.trunc("l_shipdate", "month"))
    months = Window.partitionBy("l_suppkey")
    return W.window_over_aggregate(lines, ["l_suppkey", "month"], {"qty": F.sum("l_quantity")}, {
        "qty_rank": F.rank().over(months.orderBy(F.desc("qty"), "month")),
        "supplier_qty": F.sum("qty").over(months),
    })


@register("is_last_flag", """
    select l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
           row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc,
             l_extendedprice desc, l_quantity desc) = 1 as is_last
    from lineitem""")
def is_last_flag(t):
    lines = t["lineitem"].select("l_orderkey", *LINE_ORDER)
    return W.is_last_flag(lines, ["l_orderkey"], LINE_ORDER).drop("l_linenumber", "l_quantity")


@register("deterministic_pick", """
    select * exclude (rn) from (select l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
      row_number() over (partition by l_orderkey order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) as rn from lineitem) where rn = 1""")
def deterministic_pick(t):
    return W.deterministic_pick(t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"), ["l_orderkey"])


@register("order_limit", """
    select o_orderkey, o_totalprice, o_orderdate from orders order by o_totalprice desc, o_orderkey limit 100""")
def order_limit(t):
    return W.order_limit(t["orders"].select("o_orderkey", "o_totalprice", "o_orderdate"), ["-o_totalprice", "o_orderkey"], 100)


@register("topk_per_group", """
    select * from (select l_orderkey, l_partkey, l_suppkey, l_extendedprice,
      row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey, l_suppkey) as rank from lineitem) where rank <= 3""")
def topk_per_group(t):
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    return W.topk_per_group(lines, ["l_orderkey"], ["-l_extendedprice", "l_partkey", "l_suppkey"], 3)
