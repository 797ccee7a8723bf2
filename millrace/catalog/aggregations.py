"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import AS_OF, register
from millrace.functions.columns import cents, money
from millrace.operators import aggregates as A


@register("group_agg", """
    select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty,
           sum(cast(round(l_extendedprice * 100) as bigint))::bigint / 100 as sum_base_price,
           sum(cast(round(l_extendedprice * 100) as bigint) * (100 - cast(round(l_discount * 100) as bigint)))::bigint / 10000 as sum_disc_price,
           sum(cast(round(l_extendedprice * 100) as bigint))::bigint / count(*) / 100 as avg_price,
           min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, count(*) as num_rows
    from lineitem group by 1, 2""")
def group_agg(t):
    price = cents("l_extendedprice")
    return A.group_agg(t["lineitem"], ["l_returnflag", "l_linestatus"], {
        "sum_qty": F.sum("l_quantity"),
        "sum_base_price": money(F.sum(price)),
        "sum_disc_price": F.sum(price * (100 - cents("l_discount"))) / F.lit(10000),
        "avg_price": F.sum(price) / F.count(F.lit(1)) / F.lit(100),
        "first_ship": F.min("l_shipdate"),
        "last_ship": F.max("l_shipdate"),
        "num_rows": F.count(F.lit(1)),
    })


@register("conditional_agg", """
    select l_suppkey,
           sum(case when l_returnflag = 'R' then l_quantity end) as returned_qty,
           count(case when l_linestatus = 'O' then 1 end) as open_lines,
           min(case when l_returnflag = 'R' then l_shipdate end) as first_return,
           max(case when l_discount >= 0.05 then l_extendedprice end) as top_discounted_price
    from lineitem group by 1""")
def conditional_agg(t):
    returned = F.col("l_returnflag") == "R"
    return A.conditional_agg(t["lineitem"], ["l_suppkey"], {
        "returned_qty": ("sum", returned, "l_quantity"),
        "open_lines": ("count", F.col("l_linestatus") == "O", F.lit(1)),
        "first_return": ("min", returned, "l_shipdate"),
        "top_discounted_price": ("max", F.col("l_discount") >= 0.05, "l_extendedprice"),
    })


@register("count_distinct", """
    select o_orderpriority, count(distinct o_custkey) as customers,
           count(distinct case when o_orderstatus = 'F' then o_custkey end) as customers_finished,
           count(distinct case when o_orderstatus <> 'F' then o_orderdate::date end) as open_days
    from orders group by 1""")
def count_distinct(t):
    done = F.col("o_orderstatus") == "F"
    orders = t["orders"].withColumn("order_day", F.to_date("o_orderdate"))
    return A.count_distinct(orders, ["o_orderpriority"], {
        "customers": (F.lit(True), "o_custkey"),
        "customers_finished": (done, "o_custkey"),
        "open_days": (~done, "order_day"),
    })


@register("bool_aggs", """
    select l_orderkey, bool_or(l_returnflag = 'R') as any_returned, bool_and(l_returnflag = 'R') as all_returned,
           bool_or(l_discount > 0.08) as any_high_discount, bool_and(l_discount > 0.08) as all_high_discount
    from lineitem group by 1""")
def bool_aggs(t):
    return A.bool_aggs(t["lineitem"], ["l_orderkey"], {
        "returned": F.col("l_returnflag") == "R", "high_discount": F.col("l_discount") > 0.08,
    })


@register("any_value_agg", """
    select o_custkey, min(o_orderpriority) as o_orderpriority, min(o_orderstatus) as o_orderstatus, count(*) as num_rows
    from orders group by 1""")
def any_value_agg(t):
    return A.any_value_agg(t["orders"], ["o_custkey"], ["o_orderpriority", "o_orderstatus"])


@register("listagg_ordered", """
    select l_orderkey, string_agg(distinct p_type, ', ' order by p_type) as part_types
    from lineitem join part on p_partkey = l_partkey group by 1""")
def listagg_ordered(t):
    lines = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    return A.listagg_ordered(lines, ["l_orderkey"], "p_type", "part_types")


@register("median_stddev", """
    select l_returnflag, quantile_cont(cents, 0.5) as median, round(stddev_samp(cents), 4) as stddev
    from (select l_returnflag, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem) group by 1""")
def median_stddev(t):
    lines = t["lineitem"].select("l_returnflag", cents("l_extendedprice").alias("cents"))
    return A.median_stddev(lines, ["l_returnflag"], "cents")


@register("percentile_tier", """
    with p as (select c_mktsegment, quantile_cont(round(c_acctbal * 100)::bigint, 0.8) as p80, quantile_cont(round(c_acctbal * 100)::bigint, 0.6) as p60
               from customer group by 1)
    select c_custkey, c_mktsegment, round(c_acctbal * 100)::bigint as cents,
           case when round(c_acctbal * 100)::bigint > p80 then 'high' when round(c_acctbal * 100)::bigint > p60 then 'medium' else 'low' end as tier
    from customer join p using (c_mktsegment)""")
def percentile_tier(t):
    scores = t["customer"].select("c_custkey", "c_mktsegment", cents("c_acctbal").alias("cents"))
    return A.percentile_tier(scores, ["c_mktsegment"], "cents", [(0.8, "high"), (0.6, "medium")], "low")


@register("strict_sum", """
    select l_orderkey,
           case when count(*) = count(qty) then sum(qty) end as qty,
           case when count(*) = count(price) then sum(price)::bigint end as price
    from (select l_orderkey, nullif(l_quantity, 25) as qty,
                 case when l_partkey % 50 <> 0 then cast(round(l_extendedprice * 100) as bigint) end as price from lineitem)
    group by 1""")
def strict_sum(t):
    lines = t["lineitem"].select(
        "l_orderkey", F.nullif("l_quantity", F.lit(25.0)).alias("qty"),
        F.when(F.col("l_partkey") % 50 != 0, cents("l_extendedprice")).alias("price"),
    )
    return A.strict_sum(lines, ["l_orderkey"], ["qty", "price"])


@register("all_some_none", """
    select l_orderkey, case when count(*) filter (where l_returnflag = 'R') = count(*) then 'all'
                            when count(*) filter (where l_returnflag = 'R') > 0 then 'some' else 'none' end as returned
    from lineitem group by 1""")
def all_some_none(t):
    return A.all_some_none(t["lineitem"], ["l_orderkey"], F.col("l_returnflag") == "R", "returned")


@register("having_filter", """
    select o_custkey, count(*) as n_orders, sum(round(o_totalprice * 100)::bigint)::bigint / 100 as total
    from orders group by 1 having count(*) > 12 and sum(round(o_totalprice * 100)::bigint) > 300000000""")
def having_filter(t):
    aggs = {"n_orders": F.count(F.lit(1)), "total": money(F.sum(cents("o_totalprice")))}
    return A.having_filter(t["orders"], ["o_custkey"], aggs, "n_orders > 12 and total > 3000000")


@register("distinct_rows", "select distinct o_custkey, o_orderpriority from orders")
def distinct_rows(t):
    return A.distinct_rows(t["orders"], ["o_custkey", "o_orderpriority"])


@register("scalar_subquery_agg", """
    with s as (select sum(round(o_totalprice * 100)::bigint)::bigint / count(*) as avg_cents, max(o_orderdate) as newest from orders)
    select o_orderkey, (select avg_cents from s) as avg_cents, (select newest from s) as newest,
           round(o_totalprice * 100)::bigint > (select avg_cents from s) as above_average
    from orders""")
def scalar_subquery_agg(t):
    orders = t["orders"].select("o_orderkey", "o_orderdate", cents("o_totalprice").alias("cents"))
    sub = orders.agg((F.sum("cents") / F.count(F.lit(1))).alias("avg_cents"), F.max("o_orderdate").alias("newest"))
    out = A.scalar_subquery_agg(orders, sub)
    return out.select("o_orderkey", "avg_cents", "newest", (F.col("cents") > F.col("avg_cents")).alias("above_average"))


@register("ratio_to_report", """
    select l_suppkey, l_returnflag, sum(l_quantity) as l_quantity,
           sum(l_quantity) / sum(sum(l_quantity)) over (partition by l_suppkey) as share
    from lineitem group by 1, 2""")
def ratio_to_report(t):
    return A.ratio_to_report(t["lineitem"], ["l_suppkey"], ["l_returnflag"], "l_quantity", "share")


@register("pivot_conditional", """
    select l_suppkey, sum(case when l_returnflag = 'A' then 1 else 0 end)::bigint as n_A,
           sum(case when l_returnflag = 'N' then 1 else 0 end)::bigint as n_N,
           sum(case when l_returnflag = 'R' then 1 else 0 end)::bigint as n_R,
           sum(case when l_returnflag = 'it''s' then 1 else 0 end)::bigint as "n_it's"
    from lineitem group by 1""")
def pivot_conditional(t):
    return A.pivot_conditional(t["lineitem"], ["l_suppkey"], "l_returnflag", ["A", "N", "R", "it's"], prefix="n_")


@register("unpivot", """
    select o_orderkey, 'o_orderstatus' as prop, o_orderstatus as val from orders
    union all select o_orderkey, 'o_orderpriority', o_orderpriority from orders
    union all select o_orderkey, 'is_finished', case when o_orderstatus = 'F' then 'true' else 'false' end from orders
    union all select o_orderkey, 'customer', nullif(o_custkey, 7)::varchar from orders""")
def unpivot(t):
    orders = t["orders"].select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_orderstatus") == "F").alias("is_finished"),
        F.nullif("o_custkey", F.lit(7)).alias("customer"),
    )
    return A.unpivot(orders, ["o_orderkey"], ["o_orderstatus", "o_orderpriority", "is_finished", "customer"], "prop", "val")


@register("column_values", """
    select event_type as value, count(*) as num_rows from events group by 1 order by 2 desc, 1""")
def column_values(t):
    return A.column_values(t["events"], "event_type")


@register("calendar_rollup", """
    select l_returnflag, date_trunc('month', l_shipdate)::timestamp as month, sum(l_quantity) as qty, count(*) as num_rows
    from lineitem group by 1, 2""")
def calendar_rollup(t):
    return A.calendar_rollup(t["lineitem"], ["l_returnflag"], "l_shipdate", "month", {
        "qty": F.sum("l_quantity"), "num_rows": F.count(F.lit(1)),
    })


@register("residual_allocation", """
    with child as (select l_orderkey, l_returnflag as item, sum(round(l_extendedprice * 100)::bigint)::bigint as cents
                   from lineitem where l_returnflag <> 'N' group by 1, 2),
         parent as (select l_orderkey, sum(round(l_extendedprice * 100)::bigint)::bigint as cents from lineitem group by 1)
    select * from child
    union all
    select p.l_orderkey, 'unattributed', p.cents - coalesce(c.cents, 0)
    from parent p left join (select l_orderkey, sum(cents)::bigint as cents from child group by 1) c using (l_orderkey)
    where abs(p.cents - coalesce(c.cents, 0)) > 3""")
def residual_allocation(t):
    lines = t["lineitem"].select("l_orderkey", F.col("l_returnflag").alias("item"), cents("l_extendedprice").alias("cents"))
    child = lines.filter("item <> 'N'").groupBy("l_orderkey", "item").agg(F.sum("cents").alias("cents"))
    return A.residual_allocation(lines, child, ["l_orderkey"], "cents", 3, "unattributed")


@register("rolling_distinct_12m", """
    select m.month, count(distinct o_custkey) as entities
    from (select unnest(generate_series(timestamp '1999-10-01', timestamp '2001-09-01', interval 1 month)) as month) m
    join orders on date_trunc('month', o_orderdate) between m.month - interval 11 month and m.month
    group by 1""")
def rolling_distinct_12m(t):
    return A.rolling_distinct_12m(t["orders"], "o_orderdate", "o_custkey", AS_OF)
