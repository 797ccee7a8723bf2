"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import register
from millrace.functions.columns import cents
from millrace.functions.dates import month
from millrace.operators import joins as J
from millrace.sources import frames
from millrace.sources.tables import read_seed

# Text form of the order priorities.
PRIORITY_LABELS = [("1-urgent", "rush", 1), ("2-high", "rush", 2), ("3-medium", "normal", 5), ("5-low", "slow", 10)]


@register("join_inner_equi", """
    select o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey""")
def join_inner_equi(t):
    return J.join_inner_equi(t["orders"], t["customer"], [("o_custkey", "c_custkey")]).select("o_orderkey", "c_name", "c_mktsegment")


@register("join_left_equi", """
    select c_custkey, o_orderkey, o_orderdate from customer left join (select * from orders where o_orderdate >= timestamp '2001-01-01') on o_custkey = c_custkey""")
def join_left_equi(t):
    recent = t["orders"].filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return J.join_left_equi(t["customer"], recent, [("c_custkey", "o_custkey")]).select("c_custkey", "o_orderkey", "o_orderdate")


@register("lookup_broadcast", """
    select o_orderkey, p.lane, p.days::bigint as days from orders
    left join (values ('1-urgent', 'rush', 1), ('2-high', 'rush', 2), ('3-medium', 'normal', 5), ('5-low', 'slow', 10)) p(priority, lane, days)
    on lower(trim(o_orderpriority)) = p.priority""")
def lookup_broadcast(t):
    labels = F.broadcast(read_seed(t.spark, PRIORITY_LABELS, "priority string, lane string, days int"))
    return J.lookup_broadcast(t["orders"], F.col("o_orderpriority"), labels, "priority", ["lane", "days"]).select("o_orderkey", "lane", "days")


@register("role_playing_dims", """
    select l_orderkey, l_partkey, l_suppkey, l_shipdate, cn.n_name as customer_nation, sn.n_name as supplier_nation, l_quantity
    from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey
    left join nation cn on cn.n_nationkey = c_nationkey left join nation sn on sn.n_nationkey = s_nationkey""")
def role_playing_dims(t):
    fact = (
        t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "c_nationkey", "s_nationkey")
    )
    nation = t["nation"].select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("nation"))
    return J.role_playing_dims(fact, nation, "key", {"c_nationkey": "customer", "s_nationkey": "supplier"}).drop("c_nationkey", "s_nationkey")


@register("wide_fact_assembly", """
    select o_orderkey, o_orderstatus, l.n_lines, l.price_cents, r.returned_lines, r.first_return, s.n_suppliers, p.n_types, d.last_ship
    from orders
    left join (select l_orderkey, count(*) as n_lines, sum(round(l_extendedprice * 100)::bigint)::bigint as price_cents from lineitem group by 1) l on l.l_orderkey = o_orderkey
    left join (select l_orderkey, count(*) as returned_lines, min(l_shipdate) as first_return from lineitem where l_returnflag = 'R' group by 1) r on r.l_orderkey = o_orderkey
    left join (select l_orderkey, count(distinct l_suppkey) as n_suppliers from lineitem group by 1) s on s.l_orderkey = o_orderkey
    left join (select l_orderkey, count(distinct p_type) as n_types from lineitem join part on p_partkey = l_partkey group by 1) p on p.l_orderkey = o_orderkey
    left join (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by 1) d on d.l_orderkey = o_orderkey""")
def wide_fact_assembly(t):
    lines = t["lineitem"].withColumnRenamed("l_orderkey", "o_orderkey")
    typed = lines.select("o_orderkey", "l_partkey").join(t["part"].select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    sides = [
        lines.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(cents("l_extendedprice")).alias("price_cents")),
        lines.filter("l_returnflag = 'R'").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("returned_lines"), F.min("l_shipdate").alias("first_return")),
        lines.groupBy("o_orderkey").agg(F.count_distinct("l_suppkey").alias("n_suppliers")),
        typed.groupBy("o_orderkey").agg(F.count_distinct("p_type").alias("n_types")),
        lines.groupBy("o_orderkey").agg(F.max("l_shipdate").alias("last_ship")),
    ]
    return J.wide_fact_assembly(t["orders"].select("o_orderkey", "o_orderstatus"), "o_orderkey", sides)


@register("self_join_lineage", S.ctes(S.PARENT_ORDERS) + """
    select a.o_orderkey, a.parent_key, b.o_orderdate as parent_date, round(b.o_totalprice * 100)::bigint as parent_cents
    from parent_orders a left join parent_orders b on b.o_orderkey = a.parent_key""")
def self_join_lineage(t):
    linked = frames.parent_orders(t).withColumn("cents", cents("o_totalprice"))
    out = J.self_join_lineage(linked, "o_orderkey", "parent_key", {"parent_date": "o_orderdate", "parent_cents": "cents"})
    return out.select("o_orderkey", "parent_key", "parent_date", "parent_cents")


@register("asof_scd2_join", S.ctes(S.SUPPLIER_HISTORY) + """
    select l_orderkey, l_partkey, l_suppkey, l_shipdate, l_extendedprice, h.rate from lineitem
    left join supplier_history h on h.s_suppkey = l_suppkey and l_shipdate >= h.valid_from and (h.valid_to is null or l_shipdate < h.valid_to)""")
def asof_scd2_join(t):
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return J.asof_scd2_join(lines, frames.supplier_history(t), [("l_suppkey", "s_suppkey")], "l_shipdate", ["rate"], month)


@register("interval_expand_join", S.ctes(S.ORDER_INTERVAL) + """
    select o_orderkey, unnest(generate_series(start_at, end_at - interval 1 day, interval 1 day)) as date from order_interval""")
def interval_expand_join(t):
    return J.interval_expand_join(frames.order_interval(t).select("o_orderkey", "start_at", "end_at"), "start_at", "end_at").select("o_orderkey", "date")


@register("interval_overlap_load", S.ctes(S.ORDER_INTERVAL) + """
    , days as (select o_custkey % 25 as team, round(o_totalprice * 100)::bigint as cents,
                      unnest(generate_series(start_at, end_at - interval 1 day, interval 1 day)) as date from order_interval)
    select team, date, count(*) as in_progress, sum(cents)::bigint as load from days group by 1, 2""")
def interval_overlap_load(t):
    work = frames.order_interval(t).withColumn("team", F.col("o_custkey") % 25)
    return J.interval_overlap_load(work, "start_at", "end_at", ["team"], cents("o_totalprice"))


@register("fx_convert", S.ctes(S.RATES) + f"""
    , o as (select o_orderkey, o_orderdate, round(o_totalprice * 100)::bigint as cents, {S.CURRENCY} as ccy from orders)
    select o_orderkey, ccy, cents / rate as usd_cents from o left join rates r on r.currency = ccy and r.date = o_orderdate::date""")
def fx_convert(t):
    orders = t["orders"].select("o_orderkey", "o_orderdate", cents("o_totalprice").alias("cents"), frames.order_currency().alias("ccy"))
    return J.fx_convert(orders, frames.rates(t), "cents", "ccy", F.col("o_orderdate"), "usd_cents").select("o_orderkey", "ccy", "usd_cents")


@register("fx_convert_effective_date", S.ctes(S.RATES, S.MILESTONES) + f"""
    , o as (select o_orderkey, round(o_totalprice * 100)::bigint as cents, {S.CURRENCY} as ccy,
              case when delivered_at >= timestamp '1998-01-01' then delivered_at when shipped_at is not null and o_orderkey % 5 <> 0 then shipped_at
                   else created_at end::date as rate_date from milestones)
    select o_orderkey, ccy, rate_date::timestamp as rate_date, cents / rate as usd_cents
    from o left join rates r on r.currency = ccy and r.date = rate_date""")
def fx_convert_effective_date(t):
    orders = frames.milestones(t).withColumn("cents", cents("o_totalprice")).withColumn("ccy", frames.order_currency())
    cut_over = F.lit("1998-01-01").cast("timestamp_ntz")
    rule = (
        F.when(F.col("delivered_at") >= cut_over, F.col("delivered_at"))
        .when(F.col("shipped_at").isNotNull() & (F.col("o_orderkey") % 5 != 0), F.col("shipped_at")).otherwise(F.col("created_at"))
    )
    out = J.fx_convert_effective_date(orders, frames.rates(t), "cents", "ccy", rule, "usd_cents")
    return out.select("o_orderkey", "ccy", "rate_date", "usd_cents")


@register("disjunctive_join", """
    with tickets as (select event_id, case when event_id % 3 = 0 then user_id end as ref_key, 'Customer#' || lpad((user_id * 7)::varchar, 9, '0') as ref_name from events),
         by_name as (select c_name, min(c_custkey) as c_custkey from customer group by 1)
    select event_id, coalesce(k.c_custkey, n.c_custkey) as c_custkey, coalesce(k.c_mktsegment, nn.c_mktsegment) as c_mktsegment
    from tickets left join customer k on k.c_custkey = ref_key left join by_name n on n.c_name = ref_name left join customer nn on nn.c_custkey = n.c_custkey""")
def disjunctive_join(t):
    tickets = t["events"].select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("ref_key"),
        F.concat(F.lit("Customer#"), F.lpad((F.col("user_id") * 7).cast("string"), 9, "0")).alias("ref_name"),
    )
    out = J.disjunctive_join(tickets, t["customer"], [("ref_key", "c_custkey"), ("ref_name", "c_name")], ["c_custkey", "c_mktsegment"])
    return out.select("event_id", "c_custkey", "c_mktsegment")


@register("waterfall_resolve", """
    with a as (select o_custkey, min(o_orderkey) as v from orders where o_orderstatus = 'F' group by 1),
         b as (select o_custkey, min(o_orderkey) as v from orders where o_orderpriority = '1-URGENT' group by 1),
         c as (select o_orderkey, min(o_custkey) as v from orders group by 1)
    select event_id, coalesce(a.v, b.v, c.v) as resolved from events
    left join a on a.o_custkey = user_id * 3 left join b on b.o_custkey = user_id * 2 left join c on c.o_orderkey = event_id""")
def waterfall_resolve(t):
    events = t["events"].select("event_id", (F.col("user_id") * 3).alias("k1"), (F.col("user_id") * 2).alias("k2"))
    steps = [
        (t["orders"].filter("o_orderstatus = 'F'"), "k1", "o_custkey", "o_orderkey"),
        (t["orders"].filter("o_orderpriority = '1-URGENT'"), "k2", "o_custkey", "o_orderkey"),
        (t["orders"], "event_id", "o_orderkey", "o_custkey"),
    ]
    return J.waterfall_resolve(events, steps, "resolved").select("event_id", "resolved")


@register("semi_join", "select o_orderkey, o_orderdate from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def semi_join(t):
    return J.semi_join(t["orders"].select("o_orderkey", "o_orderdate"), t["lineitem"].filter("l_returnflag = 'R'"), [("o_orderkey", "l_orderkey")])


@register("anti_join", "select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01')")
def anti_join(t):
    recent = t["orders"].filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return J.anti_join(t["customer"].select("c_custkey", "c_name"), recent, [("c_custkey", "o_custkey")])


@register("full_outer_reconcile", S.ctes(S.ORDERS_V2) + """
    , p as (select o_orderkey, o_orderstatus, round(o_totalprice * 100)::bigint + case when o_orderkey % 31 = 0 then o_orderkey % 400 else 0 end as cents from orders_v2),
      b as (select o_orderkey, o_orderstatus, round(o_totalprice * 100)::bigint as cents from orders where o_orderkey % 89 <> 0)
    select o_orderkey, reason, production_o_orderstatus, backup_o_orderstatus, production_cents, backup_cents from (
      select coalesce(p.o_orderkey, b.o_orderkey) as o_orderkey,
             case when p.o_orderkey is null then 'missing in production' when b.o_orderkey is null then 'missing in backup'
                  when p.o_orderstatus is distinct from b.o_orderstatus then 'o_orderstatus changed' when abs(p.cents - b.cents) > 100 then 'cents changed' end as reason,
             p.o_orderstatus as production_o_orderstatus, b.o_orderstatus as backup_o_orderstatus, p.cents as production_cents, b.cents as backup_cents
      from p full join b on p.o_orderkey = b.o_orderkey) where reason is not null""")
def full_outer_reconcile(t):
    k = F.col("o_orderkey")
    drift = F.when(k % 31 == 0, k % 400).otherwise(F.lit(0))
    prod = frames.orders_v2(t).withColumn("cents", cents("o_totalprice") + drift)
    backup = t["orders"].filter(k % 89 != 0).withColumn("cents", cents("o_totalprice"))
    return J.full_outer_reconcile(prod, backup, "o_orderkey", {"o_orderstatus": None, "cents": 100})


@register("cross_join_scaffold", """
    with f as (select l_suppkey, date_trunc('month', l_shipdate) as month, count(*) as returned, sum(l_quantity) as qty from lineitem where l_returnflag = 'R' group by 1, 2),
         m as (select unnest(generate_series((select min(month) from f)::timestamp, (select max(month) from f)::timestamp, interval 1 month)) as month)
    select s_suppkey, m.month, coalesce(returned, 0)::bigint as returned, coalesce(qty, 0) as qty
    from supplier cross join m left join f on f.l_suppkey = s_suppkey and f.month = m.month""")
def cross_join_scaffold(t):
    returned = t["lineitem"].filter("l_returnflag = 'R'").groupBy(F.col("l_suppkey").alias("s_suppkey"), month("l_shipdate").alias("month"))
    facts = returned.agg(F.count(F.lit(1)).alias("returned"), F.sum("l_quantity").alias("qty"))
    first, last = facts.agg(F.min("month").cast("date")).scalar(), facts.agg(F.max("month").cast("date")).scalar()
    return J.cross_join_scaffold(t["supplier"], ["s_suppkey"], facts, first, last, "month", "month", ["returned", "qty"])


@register("lateral_explode", """
    select vec_id, label::bigint as label, generate_subscripts(embedding, 1)::bigint - 1 as pos, unnest(embedding)::double as x from embeddings""")
def lateral_explode(t):
    return J.lateral_explode(t["embeddings"], "embedding", "x", pos="pos")


@register("split_to_rows", """
    select p_partkey, trim(w) as word from (select p_partkey, unnest(string_split_regex(p_name || ', ' || p_brand || ',', '[ ,]')) as w from part) where trim(w) <> ''""")
def split_to_rows(t):
    parts = t["part"].select("p_partkey", F.concat("p_name", F.lit(", "), "p_brand", F.lit(",")).alias("tags"))
    return J.split_to_rows(parts, "tags", "[ ,]", "word").drop("tags")


@register("multi_list_product", """
    with l as (select conv_id, turn, case when turn % 3 = 0 then ['none'] else ['r:' || role, 't:' || turn] end as contacts,
                      case when turn % 2 = 0 then [null] else [conv_id, conv_id + 1, conv_id + 2] end as orders from conversations)
    select conv_id, turn::bigint as turn, contact, unnest(orders) as order_ref from (select conv_id, turn, unnest(contacts) as contact, orders from l)""")
def multi_list_product(t):
    turn = F.col("turn")
    contacts = F.when(turn % 3 == 0, F.array(F.lit("none"))).otherwise(F.array(F.concat(F.lit("r:"), "role"), F.concat(F.lit("t:"), turn.cast("string"))))
    ids = F.col("conv_id")
    orders = F.when(turn % 2 == 0, F.array().cast("array<bigint>")).otherwise(F.array(ids, ids + 1, ids + 2))
    return J.multi_list_product(t["conversations"].select("conv_id", "turn", "role"), {"contact": contacts, "order_ref": orders}).drop("role")


@register("computed_key_join", """
    with w as (select date_trunc('week', o_orderdate) as week, count(*) as n_orders, sum(round(o_totalprice * 100)::bigint)::bigint as cents from orders group by 1),
         l as (select date_trunc('week', l_shipdate) as week, count(*) as n_lines from lineitem group by 1)
    select w.week::timestamp as week, n_orders, cents, n_lines from w join l on l.week = w.week""")
def computed_key_join(t):
    placed = t["orders"].groupBy(F.trunc("o_orderdate", "week").alias("week")).agg(F.count(F.lit(1)).alias("n_orders"), F.sum(cents("o_totalprice")).alias("cents"))
    shipped = t["lineitem"].groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    weekly = shipped.groupBy(F.trunc("day", "week").alias("ship_week")).agg(F.sum("n").alias("n_lines"))
    code = lambda x: F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)
    return J.computed_key_join(placed, weekly, code("week"), code("ship_week")).drop("ship_week")


@register("coalesced_exception_override", """
    with e as (select o_orderkey, timestamp '2001-12-31' as recognised_at from orders where o_orderkey % 1000 = 7)
    select o.o_orderkey, coalesce(e.recognised_at, o.o_orderdate + interval 14 day) as recognised_at from orders o left join e on e.o_orderkey = o.o_orderkey""")
def coalesced_exception_override(t):
    derived = t["orders"].select("o_orderkey", (F.col("o_orderdate") + F.expr("interval 14 days")).alias("recognised_at"))
    listed = t["orders"].filter("o_orderkey % 1000 = 7").select("o_orderkey", F.lit("2001-12-31").cast("timestamp_ntz").alias("recognised_at"))
    return J.coalesced_exception_override(derived, listed, "o_orderkey", ["recognised_at"])
