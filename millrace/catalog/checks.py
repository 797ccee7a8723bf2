"""Data-quality queries. Each is bound so that some rows fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, register
from millrace.functions.columns import cents
from millrace.functions.dates import add_part, day
from millrace.operators import quality as Q
from millrace.operators import quality_run as R
from millrace.sources import frames
from millrace.sources.tables import SOURCES


@register("dq_unique", "select o_custkey, count(*) as n_records from orders where o_orderstatus = 'F' group by 1 having count(*) > 1")
def dq_unique(t):
    return Q.dq_unique(t["orders"], "o_custkey", F.col("o_orderstatus") == "F")


@register("dq_not_null", "select o_orderkey, o_custkey from orders where o_orderkey % 4 <> 1 and o_orderpriority = '5-LOW'")
def dq_not_null(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return Q.dq_not_null(orders, "priority", F.col("o_orderkey") % 4 != 1).drop("priority")


@register("dq_accepted_values", "select event_type as value, count(*) as n_records from events where event_type not in ('view', 'click', 'purchase') group by 1")
def dq_accepted_values(t):
    return Q.dq_accepted_values(t["events"], "event_type", ["view", "click", "purchase"])


@register("dq_not_accepted_values", "select l_returnflag as value, count(*) as n_records from lineitem where l_returnflag in ('R', 'X') group by 1")
def dq_not_accepted_values(t):
    return Q.dq_not_accepted_values(t["lineitem"], "l_returnflag", ["R", "X"])


@register("dq_accepted_range", "select c_custkey, c_acctbal from customer where c_acctbal < 0 or c_acctbal > 9000")
def dq_accepted_range(t):
    return Q.dq_accepted_range(t["customer"].select("c_custkey", "c_acctbal"), "c_acctbal", 0, 9000)


@register("dq_at_least_one", "select count(case when l_linestatus = 'X' then 1 end) as n_values from lineitem having count(case when l_linestatus = 'X' then 1 end) = 0")
def dq_at_least_one(t):
    return Q.dq_at_least_one(t["lineitem"].select(F.when(F.col("l_linestatus") == "X", 1).alias("x")), "x")


@register("dq_not_constant", "select count(distinct length(l_returnflag)) as n_distinct from lineitem having count(distinct length(l_returnflag)) = 1")
def dq_not_constant(t):
    return Q.dq_not_constant(t["lineitem"].select(F.length("l_returnflag").alias("flag_length")), "flag_length")


@register("dq_not_null_proportion", """
    select count(nullif(event_type, 'view')) / count(*) as not_null_proportion from events having count(nullif(event_type, 'view')) / count(*) not between 0.95 and 1""")
def dq_not_null_proportion(t):
    return Q.dq_not_null_proportion(t["events"].select(F.nullif("event_type", F.lit("view")).alias("kind")), "kind", 0.95)


@register("dq_expression_is_true", """
    select l_orderkey, l_partkey, l_extendedprice from lineitem where l_linestatus = 'F' and not (l_extendedprice * (1 - l_discount) >= 2000)""")
def dq_expression_is_true(t):
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_linestatus")
    bad = Q.dq_expression_is_true(lines, F.col("l_extendedprice") * (1 - F.col("l_discount")) >= 2000, F.col("l_linestatus") == "F")
    return bad.select("l_orderkey", "l_partkey", "l_extendedprice")


@register("dq_unique_combination", """
    select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1""")
def dq_unique_combination(t):
    return Q.dq_unique_combination(t["lineitem"], ["l_orderkey", "l_linenumber"])


@register("dq_relationships_where", """
    select l_orderkey as id from lineitem where l_returnflag = 'R' and not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P')""")
def dq_relationships_where(t):
    return Q.dq_relationships_where(t["lineitem"], "l_orderkey", t["orders"], "o_orderkey", F.col("l_returnflag") == "R", F.col("o_orderstatus") != "P")


@register("dq_cardinality_equality", S.ctes(S.ORDERS_V2) + """
    , a as (select o_custkey as value, count(*) as num_rows from orders group by 1), b as (select o_custkey as value, count(*) as num_rows from orders_v2 group by 1)
    (select * from a except select * from b) union all (select * from b except select * from a)""")
def dq_cardinality_equality(t):
    return Q.dq_cardinality_equality(t["orders"], "o_custkey", frames.orders_v2(t), "o_custkey")


@register("dq_equality", S.ctes(S.ORDERS_V2) + """
    select 'a_minus_b' as which_diff, * from (select o_orderkey, o_orderstatus from orders except select o_orderkey, o_orderstatus from orders_v2)
    union all select 'b_minus_a', * from (select o_orderkey, o_orderstatus from orders_v2 except select o_orderkey, o_orderstatus from orders)""")
def dq_equality(t):
    return Q.dq_equality(t["orders"], frames.orders_v2(t), ["o_orderkey", "o_orderstatus"])


@register("dq_equal_rowcount", S.ctes(S.ORDERS_V2) + """
    select (select count(*) from orders) as count_a, (select count(*) from orders_v2) as count_b, (select count(*) from orders) - (select count(*) from orders_v2) as diff_count""")
def dq_equal_rowcount(t):
    return Q.dq_equal_rowcount(t["orders"], frames.orders_v2(t))


@register("dq_fewer_rows_than", """
    select (select count(*) from lineitem) as count_ours, (select count(*) from orders) as count_other, (select count(*) from lineitem) - (select count(*) from orders) as row_count_delta""")
def dq_fewer_rows_than(t):
    return Q.dq_fewer_rows_than(t["lineitem"], t["orders"])


@register("dq_mutually_exclusive_ranges", S.ctes(S.ORDER_INTERVAL) + """
    , n as (select o_custkey, o_orderkey, start_at, end_at, lead(start_at) over (partition by o_custkey order by start_at, end_at, o_orderkey) as next_lower from order_interval)
    select * from n where not (start_at < end_at and coalesce(end_at <= next_lower, next_lower is null))""")
def dq_mutually_exclusive_ranges(t):
    spans = frames.order_interval(t).select("o_custkey", "o_orderkey", "start_at", "end_at")
    return Q.dq_mutually_exclusive_ranges(spans, "start_at", "end_at", ["o_custkey"], F.trunc("start_at", "quarter"))


@register("dq_sequential_values", """
    with d as (select distinct o_custkey, date_trunc('month', o_orderdate)::timestamp as month from orders),
         p as (select *, lag(month) over (partition by o_custkey order by month) as previous_month from d)
    select * from p where month <> previous_month + interval 1 month""")
def dq_sequential_values(t):
    months = t["orders"].select("o_custkey", F.trunc("o_orderdate", "month").alias("month")).distinct()
    return Q.dq_sequential_values(months, "month", ["o_custkey"], F.trunc("month", "year"), 1, "month")


@register("dq_recency", "select max(o_orderdate) as most_recent, timestamp '2001-08-25' as threshold from orders having max(o_orderdate) < timestamp '2001-08-25'")
def dq_recency(t):
    return Q.dq_recency(t["orders"], "o_orderdate", "day", 7, AS_OF)


@register("dq_source_freshness", """
    with f as (select 'orders' as source, max(o_orderdate) as loaded_at, 24 as warn, 1440 as error from orders
               union all select 'lineitem', max(l_shipdate), 12, 24 from lineitem
               union all select 'events', max(ts), 12, 24 from events)
    select source, loaded_at, age_hours, case when age_hours > error then 'error' when age_hours > warn then 'warn' else 'pass' end as status
    from (select *, date_diff('hour', loaded_at, timestamp '2024-01-31 10:00:00') as age_hours from f)""")
def dq_source_freshness(t):
    watched = [s for s in SOURCES.values() if s.loaded_at]
    return Q.dq_source_freshness([(s.name, t[s.name], s.loaded_at, s.warn_hours, s.error_hours) for s in watched], "2024-01-31 10:00:00")


LEDGER_SQL = """ledger as (
  select l_shipdate as date, 'revenue' as type, case when l_returnflag = 'R' and l_linenumber = 7 then round(l_extendedprice * 100)::bigint else 0 end as amount from lineitem
  union all select l_shipdate, 'cost', case when l_linestatus = 'F' and l_returnflag = 'A' and l_linenumber = 7 then -round(l_quantity)::bigint else 0 end from lineitem)"""


def small_ledger(t):
    lines = t["lineitem"]
    date = F.to_date("l_shipdate").alias("date")
    last_line = F.col("l_linenumber") == 7
    revenue = F.when((F.col("l_returnflag") == "R") & last_line, cents("l_extendedprice")).otherwise(F.lit(0))
    cost = F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A") & last_line, -F.rint("l_quantity").cast("long")).otherwise(F.lit(0))
    parts = F.array(F.struct(F.lit("revenue").alias("type"), revenue.alias("amount")), F.struct(F.lit("cost").alias("type"), cost.alias("amount")))
    return lines.select(date, F.inline(parts))


@register("dq_daily_amount_sanity", S.ctes(LEDGER_SQL) + """
    , d as (select date, sum(case when type = 'cost' then amount else 0 end)::bigint as cost, sum(case when type = 'revenue' then amount else 0 end)::bigint as revenue from ledger group by 1),
      days as (select distinct o_orderdate as date from orders where isodow(o_orderdate) <= 5)
    select days.date, coalesce(cost, 0) as cost, coalesce(revenue, 0) as revenue from days left join d on d.date = days.date
    where not (coalesce(cost, 0) < 0 or coalesce(revenue, 0) > 0)""")
def dq_daily_amount_sanity(t):
    days = t["orders"].select(day("o_orderdate").alias("date")).distinct()
    return Q.dq_daily_amount_sanity(small_ledger(t), days)


@register("dq_weekday_freshness", "select date_trunc('day', max(ts))::timestamp as newest from events having date_diff('day', max(ts), timestamp '2024-02-05') > 2")
def dq_weekday_freshness(t):
    return Q.dq_weekday_freshness(t["events"], "ts", "2024-02-05")


@register("dq_backup_integrity", S.ctes(S.ORDERS_V2, S.CUSTOMER_V2) + """
    , closed as (select timestamp '2001-08-01' as until_),
      ev as (select coalesce(p.d, b.d) as d, p.n as pn, b.n as bn from (select o_orderdate::date as d, count(*) as n from orders_v2 group by 1) p
             full join (select o_orderdate::date as d, count(*) as n from orders group by 1) b on p.d = b.d),
      l as (select l_orderkey * 10 + l_linenumber as k, max(l_shipdate) as shipped, sum(round(l_extendedprice * 100)::bigint)::bigint as cents,
                   sum(round(l_extendedprice * 100)::bigint + case when l_partkey % 40 = 0 then l_partkey * 20 else 0 end)::bigint as cents_now from lineitem group by 1)
    select 'order events' as test, strftime(d, '%Y-%m-%d') as identifier, 'count changed' as reason from ev, closed where d < until_ and pn <> bn
    union all
    select 'customer counts', strftime(d, '%Y-%m-%d'), 'count changed' from (
      select timestamp '1995-01-01' + to_days((c_custkey % 28)::int) as d, count(*) as bn from customer group by 1) b
      join (select timestamp '1995-01-01' + to_days((c_custkey % 28)::int) as d, count(*) as pn from customer_v2 group by 1) p using (d), closed where d < until_ and abs(bn - pn) / bn > 0.01
    union all
    select 'margin', k::varchar, 'cents changed' from l, closed where shipped < until_ and abs(cents - cents_now) > 10000
    union all
    select 'orders', o.o_orderkey::varchar, case when v.o_orderkey is null then 'missing in production' else 'o_orderstatus changed' end
    from orders o left join orders_v2 v using (o_orderkey), closed where o.o_orderdate < until_ and (v.o_orderkey is null or v.o_orderstatus <> o.o_orderstatus)
    union all
    select 'supplier counts', strftime(d, '%Y-%m-%d'), 'count changed' from (select timestamp '1995-01-01' + to_days((s_suppkey % 9)::int) as d, count(*) as bn, count(*) filter (where s_suppkey % 50 <> 0) as pn
      from supplier group by 1), closed where d < until_ and pn > 0 and abs(bn - pn) / bn > 0.01""")
def dq_backup_integrity(t):
    def dated(df, key, modulus):
        return df.withColumn("created_at", add_part(F.lit("1995-01-01").cast("timestamp_ntz"), F.col(key) % modulus, "day"))

    keyed = t["lineitem"].groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    drift = F.when(F.col("l_partkey") % 40 == 0, F.col("l_partkey") * 20).otherwise(F.lit(0))
    backup_lines = keyed.agg(F.max("l_shipdate").alias("at"), F.sum(cents("l_extendedprice")).alias("cents"))
    prod_lines = keyed.agg(F.max("l_shipdate").alias("at"), F.sum(cents("l_extendedprice") + drift).alias("cents"))
    return Q.dq_backup_integrity(
        {
            "order events": (frames.orders_v2(t), t["orders"], "o_orderdate", 0.0),
            "customer counts": (dated(frames.customer_v2(t), "c_custkey", 28), dated(t["customer"], "c_custkey", 28), "created_at", 0.01),
            "supplier counts": (
                dated(t["supplier"].filter("s_suppkey % 50 <> 0"), "s_suppkey", 9), dated(t["supplier"], "s_suppkey", 9), "created_at", 0.01
            ),
        },
        {
            "margin": (prod_lines, backup_lines, "k", "at", {"cents": 10000}),
            "orders": (frames.orders_v2(t), t["orders"], "o_orderkey", "o_orderdate", {"o_orderstatus": None}),
        },
        AS_OF,
    )


def order_checks():
    return {
        "finished orders per customer": R.unique(["o_custkey"], F.col("o_orderstatus") == "F"),
        "one order of a priority per day": R.unique(["o_orderpriority", "o_orderdate"]),
        "priority known": R.not_null("priority", F.col("o_orderkey") % 4 != 1),
        "status accepted": R.accepted_values("o_orderstatus", ["F", "O"]),
        "priority not accepted": R.not_accepted_values("o_orderpriority", ["1-URGENT", "none"]),
        "price in range": R.accepted_range("o_totalprice", 5000, 300000),
        "finished orders are cheap": R.expression_is_true(F.col("o_totalprice") < 200000, F.col("o_orderstatus") == "F"),
        "some order is lost": R.at_least_one("lost"),
        "status text varies": R.not_constant("status_length"),
        "priorities known in general": R.not_null_proportion("priority", 0.95),
        "dates known in general": R.not_null_proportion("o_orderdate", 0.95),
        "recent": R.recency("o_orderdate", "day", 30, "2024-01-01"),
    }


def order_columns(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
    return orders.withColumns({
        "priority": F.nullif("o_orderpriority", F.lit("5-LOW")), "lost": F.when(F.col("o_orderstatus") == "X", 1), "status_length": F.length("o_orderstatus"),
    })


@register("dq_run_orders", """
    with o as (select *, nullif(o_orderpriority, '5-LOW') as priority from orders),
    found as (
      select 'finished orders per customer' as check_id, to_json({'o_custkey': o_custkey})::varchar as key, count(*) as n_rows, null::double as measure from o where o_orderstatus = 'F' group by o_custkey having count(*) > 1
      union all select 'one order of a priority per day', to_json({'o_orderpriority': o_orderpriority, 'o_orderdate': strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000')})::varchar, count(*), null from o group by o_orderpriority, o_orderdate having count(*) > 1
      union all select 'priority known', to_json({'o_orderkey': o_orderkey})::varchar, count(*), null from o where priority is null and o_orderkey % 4 <> 1 group by o_orderkey
      union all select 'status accepted', to_json({'o_orderstatus': o_orderstatus})::varchar, count(*), null from o where o_orderstatus not in ('F', 'O') group by o_orderstatus
      union all select 'priority not accepted', to_json({'o_orderpriority': o_orderpriority})::varchar, count(*), null from o where o_orderpriority in ('1-URGENT', 'none') group by o_orderpriority
      union all select 'price in range', to_json({'o_orderkey': o_orderkey})::varchar, count(*), null from o where o_totalprice < 5000 or o_totalprice > 300000 group by o_orderkey
      union all select 'finished orders are cheap', to_json({'o_orderkey': o_orderkey})::varchar, count(*), null from o where o_orderstatus = 'F' and not o_totalprice < 200000 group by o_orderkey
      union all select 'some order is lost', null, count(*), count(*) filter (where o_orderstatus = 'X') from o having count(*) filter (where o_orderstatus = 'X') = 0
      union all select 'status text varies', null, count(*), 1 from o having min(length(o_orderstatus)) = max(length(o_orderstatus))
      union all select 'priorities known in general', null, count(*), count(priority) / count(*) from o having count(priority) / count(*) not between 0.95 and 1
      union all select 'recent', null, count(*), epoch(max(o_orderdate)) from o having max(o_orderdate) < timestamp '2023-12-02')
    select check_id, key, n_rows, measure::double as measure from found""")
def dq_run_orders(t):
    return R.run_checks(order_columns(t), ["o_orderkey"], order_checks())
