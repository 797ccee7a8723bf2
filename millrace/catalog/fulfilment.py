"""On-time, lateness, tracking, shipment and logistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, register
from millrace.functions.columns import cents
from millrace.functions.dates import add_part, day
from millrace.plans import fulfilment as P
from millrace.plans import sourcing
from millrace.sources import frames
from millrace.sources.session import cut_lineage


def on_time_sql(promised, happened, due=None, hold="false"):
    due = due or promised
    return f"""case when {promised} + interval 1 day > timestamp '2001-09-01' then null when {due} is null then null
      when status in ('completed', 'delivered', 'disputed', 'shipped') and {happened} is null then null when status = 'canceled' then null when {hold} and {happened} > {due} then null
      when {happened} > {due} then false when {happened} <= {due} then true when {happened} is null and {due} + interval 1 day < timestamp '2001-09-01' then false end"""


def delay_sql(promised, happened):
    return f"round(date_diff('minute', {promised}, {happened}) / 1440, 1)"


GRACE = "promised_supplier_at + interval 12 hour"
OWN_SINCE = "1998-01-01"
OWN_PROMISE = f"""case when technology_id = '3' and created_at < timestamp '{OWN_SINCE}' then null
      when technology_id = '3' and lower(deal_type) = 'tooling & samples' and status <> 'canceled' then
        case when shipped_at <= own_promise_at then true when shipped_at > own_promise_at then false when shipped_at is null and own_promise_at + interval 1 day < timestamp '2001-09-01' then false end
      else {on_time_sql('promised_supplier_at', 'shipped_at', GRACE)} end"""
LABEL = """case when promised_supplier_at > timestamp '2001-09-01' then null when promised_supplier_at is null then null
      when status in ('completed', 'delivered', 'disputed', 'shipped') and label_at is null then null when status = 'canceled' then null
      when label_at > promised_supplier_at then false when label_at <= promised_supplier_at then true
      when label_at is null and promised_supplier_at + interval 1 day < date_trunc('day', timestamp '2001-09-01') then false end"""


@register("on_time_rate", S.ctes(S.ORDER_TIMELINE) + f"""
    , d as (select l_orderkey as order_id, count(*) as n_delays, bool_or(l_linenumber % 2 = 0) as has_supplier_liability, min(l_shipdate) as first_delay_at, max(l_shipdate + to_days(l_linenumber)) as latest_new_shipping_at
            from lineitem where l_returnflag = 'R' group by 1)
    select o.order_id, {on_time_sql('promised_customer_at', 'shipped_to_customer_at', hold='on_customer_hold')} as on_time_to_customer,
           {on_time_sql('expected_at', 'shipped_to_customer_at', hold='on_customer_hold')} as on_time_expected, {OWN_PROMISE} as on_time_by_supplier,
           {LABEL} as on_time_label, {delay_sql('promised_customer_at', 'shipped_to_customer_at')} as delay_to_customer_days,
           {delay_sql(GRACE, 'shipped_at')} as delay_by_supplier_days, n_delays, has_supplier_liability, first_delay_at, latest_new_shipping_at
    from order_timeline o left join d using (order_id)""")
def on_time_rate(t):
    line = F.col("l_linenumber")
    delays = t["lineitem"].filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("order_id"), F.when(line % 2 == 0, "supplier").otherwise("carrier").alias("liability"), F.col("l_shipdate").alias("notified_at"),
        add_part("l_shipdate", line, "day").alias("new_shipping_at"),
    )
    return P.on_time_rate(frames.order_timeline(t), delays, AS_OF, OWN_SINCE)


@register("batch_on_time_rate", S.ctes(S.ORDER_TIMELINE) + f"""
    , b as (select l_orderkey as order_id, l_linenumber::bigint as batch_number, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || round(l_extendedprice * 100)::bigint as batch_id, l_shipdate as shipped_at,
                   l_shipdate + to_days((l_partkey % 3)::int) as shipped_to_customer_at, l_shipdate + to_days((l_suppkey % 5 - 2)::int) as promised_supplier_at, l_shipdate + to_days((l_partkey % 7 - 2)::int) as promised_customer_at,
                   'shipped' as status, l_partkey % 41 = 0 as on_customer_hold, l_quantity::bigint as quantity from lineitem where l_returnflag = 'A'),
      f as (select *, max(batch_number) over (partition by order_id) = batch_number as is_last_batch from (select *, row_number() over (partition by order_id, batch_number order by shipped_at, batch_id) as rn from b) where rn = 1),
      u as (select 'batches' as source, order_id, batch_number, status, promised_supplier_at, shipped_at, promised_customer_at, shipped_to_customer_at, on_customer_hold, quantity, is_last_batch from f
            union all select 'orders', order_id, 1, status, promised_supplier_at, shipped_at, promised_customer_at, shipped_to_customer_at, on_customer_hold, order_id % 100, true from order_timeline where order_id not in (select order_id from b))
    select source, order_id, batch_number, {on_time_sql('promised_supplier_at', 'shipped_at', GRACE)} as on_time_by_supplier, {on_time_sql('promised_customer_at', 'shipped_to_customer_at', hold='on_customer_hold')} as on_time_to_customer,
           {delay_sql('promised_customer_at', 'shipped_to_customer_at')} as delay_to_customer_days, quantity, is_last_batch from u""")
def batch_on_time_rate(t):
    key = F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], cents("l_extendedprice").cast("string"))
    batches = t["lineitem"].filter("l_returnflag = 'A'").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("long").alias("batch_number"), key.alias("batch_id"), F.col("l_shipdate").alias("shipped_at"),
        add_part("l_shipdate", F.col("l_partkey") % 3, "day").alias("shipped_to_customer_at"), add_part("l_shipdate", F.col("l_suppkey") % 5 - 2, "day").alias("promised_supplier_at"),
        add_part("l_shipdate", F.col("l_partkey") % 7 - 2, "day").alias("promised_customer_at"), F.lit("shipped").alias("status"),
        (F.col("l_partkey") % 41 == 0).alias("on_customer_hold"), F.col("l_quantity").cast("long").alias("quantity"),
    )
    return P.batch_on_time_rate(batches, frames.order_timeline(t).withColumn("quantity", F.col("order_id") % 100), AS_OF)


COMPONENTS = """components as (
  with won as (select * from (select auction_id, order_id, started_at, finished_at, row_number() over (partition by order_id order by started_at, auction_id) as rn from auctions where winning_bid_id is not null) where rn = 1),
       po as (select order_id, doc_id, finalized_at, created_at + to_days((doc_id % 5 + 10)::int) as promised from documents where doc_type = 'purchase_order' and finalized_at is not null),
       ch as (select *, coalesce(lag(promised) over (partition by order_id order by finalized_at, doc_id), promised) as previous from po),
       u as (select order_id, 'Production' as source, 'Production Delay' as impact, 'Label creation' as process, promised_supplier_at as start_at, shipped_at as end_at, 1 as factor, 0 as less from order_timeline
             union all select order_id, 'Production', 'Production Delay', 'Supplier pick up discrepancy', label_at, shipped_at, 1, 0 from order_timeline
             union all select order_id, 'Production', 'Production Time', 'Original Production Time', sourced_at, promised_supplier_at, 0, 0 from order_timeline
             union all select order_id, 'Logistics', 'Logistics Time', 'Transit time to cross dock', shipped_at, to_cross_dock_at, 1, first_leg_buffer_days * 1440 from order_timeline
             union all select order_id, 'Cross Docking', 'Cross Docking Time', 'Transit time at cross dock', to_cross_dock_at, from_cross_dock_at, 1, 1440 from order_timeline
             union all select order_id, 'Sourcing', 'Sourcing Time', 'Sourcing', started_at, finished_at, 0, 0 from won
             union all select b.order_id, 'Sourcing', 'Production Time', 'Counter bid on lead time', placed_at + interval 10 day, placed_at + to_days((lead_time % 7 + 7)::int), 1, 0 from bids b join won using (auction_id)
                       join auctions a on a.auction_id = b.auction_id and a.winning_bid_id = b.bid_id
             union all select order_id, 'Production', 'Production Time', 'PO promised shipping date adjustments', previous, promised, 1, 0 from ch)
  select order_id, source, impact, process, start_at, end_at, date_diff('minute', start_at, end_at) as minutes,
         case when factor = 0 then 0 else date_diff('minute', start_at, end_at) - less end::bigint as late_minutes from u)"""


def components(t):
    auctions = cut_lineage(frames.auctions(t), "auctions")
    history = sourcing.auction_history(auctions)
    winners = auctions.select("auction_id", "winning_bid_id")
    bids = frames.bids(t).join(winners, "auction_id").select(
        "auction_id", "order_id", (F.col("bid_id") == F.col("winning_bid_id")).alias("is_winning"), add_part("placed_at", 10, "day").alias("original_ship_by"),
        add_part("placed_at", F.col("lead_time") % 7 + 7, "day").alias("accepted_ship_by"),
    )
    docs = frames.documents(t).filter("doc_type = 'purchase_order'").withColumn("promised_at", add_part("created_at", F.col("doc_id") % 5 + 10, "day"))
    return P.lateness_components(frames.order_timeline(t), history, bids, docs)


LATE_BASE = S.ctes(S.ORDER_TIMELINE, S.AUCTIONS, S.DOCUMENTS, COMPONENTS)


@register("lateness_components", f"{LATE_BASE} select * from components")
def lateness_components(t):
    return components(t)


@register("lateness_decomposition", f"""{LATE_BASE}
    , c as (select order_id, sum(late_minutes) as l, sum(late_minutes) filter (where source = 'Sourcing') as l1, sum(late_minutes) filter (where source = 'Production') as l2, sum(late_minutes) filter (where source = 'Logistics') as l3,
                   sum(late_minutes) filter (where source = 'Cross Docking') as l4, sum(minutes) filter (where source = 'Sourcing') as m1, sum(minutes) filter (where source = 'Production') as m2,
                   sum(minutes) filter (where source = 'Logistics') as m3, sum(minutes) filter (where source = 'Cross Docking') as m4 from components group by 1),
      o as (select order_id, {on_time_sql('promised_customer_at', 'shipped_to_customer_at', hold='on_customer_hold')} as on_time_to_customer, date_diff('minute', promised_customer_at, shipped_to_customer_at) as actual from order_timeline),
      j as (select *, coalesce(not on_time_to_customer, false) as late, case when coalesce(not on_time_to_customer, false) then coalesce(l, 0) else 0 end as total from o left join c using (order_id))
    select order_id, on_time_to_customer, actual / 60 as hours_late, total::bigint / 60 as explained_hours_late,
           coalesce(case when late then l1 end, 0)::bigint / 60 as sourcing_late_hours, coalesce(case when late then l2 end, 0)::bigint / 60 as production_late_hours,
           coalesce(case when late then l3 end, 0)::bigint / 60 as logistics_late_hours, coalesce(case when late then l4 end, 0)::bigint / 60 as cross_dock_late_hours,
           coalesce(m1, 0)::bigint / 60 as sourcing_hours, coalesce(m2, 0)::bigint / 60 as production_hours, coalesce(m3, 0)::bigint / 60 as logistics_hours, coalesce(m4, 0)::bigint / 60 as cross_dock_hours,
           (actual - total)::bigint / 60 as unexplained_hours_late from j""")
def lateness_decomposition(t):
    timeline = frames.order_timeline(t)
    on_time = P.on_time(F.col("promised_customer_at"), F.col("shipped_to_customer_at"), F.col("status"), AS_OF, hold=F.col("on_customer_hold"))
    return P.lateness_decomposition(timeline.withColumn("on_time_to_customer", on_time), components(t))


STATUSES = ["In Transit", "Delivered", "Exception", "Available for pickup", "Held at customs", "Acceptance scan"]

MESSAGES = f"""messages as (
  with m as (select conv_id::varchar as tracking_number, timestamp '2024-01-01' + to_days((conv_id % 20)::int) + to_hours(turn * 7) as received_at, turn::bigint as message_id, role as location,
                    ({STATUSES!r})[(turn % 6 + 1)::int] as status, text as message, case when conv_id % 2 = 0 then 'first' else 'second' end as entity from conversations),
       o as (select *, row_number() over (partition by entity, tracking_number, received_at::date, location, message order by received_at, message_id) as rn from m)
  select tracking_number, received_at, message_id, location, status, entity, regexp_matches(' ' || lower(message) || ' ', ' ({'|'.join(P.ALERT_WORDS)}) ') as has_message_alert,
         regexp_matches(lower(status), '{P.STATUS_ALERTS}') as has_status_alert, row_number() over w as message_number, lead(received_at) over w is null as is_last_message,
         date_diff('hour', received_at, lead(received_at) over w) as hours_in_status from o where rn = 1 window w as (partition by tracking_number order by received_at, message_id))"""


def messages(t):
    status = F.get(F.array(*[F.lit(s) for s in STATUSES]), (F.col("turn") % 6).cast("int"))
    received = add_part(add_part(F.lit("2024-01-01").cast("timestamp_ntz"), F.col("conv_id") % 20, "day"), F.col("turn") * 7, "hour")
    rows = t["conversations"].select(
        F.col("conv_id").cast("string").alias("tracking_number"), received.alias("received_at"), F.col("turn").cast("long").alias("message_id"), F.col("role").alias("location"),
        status.alias("status"), F.col("text").alias("message"),
    )
    even = F.col("tracking_number").cast("long") % 2 == 0
    return P.tracking_messages({"first": rows.filter(even), "second": rows.filter(~even)}, day("received_at"))


@register("tracking_messages", f"{S.ctes(MESSAGES)} select * from messages")
def tracking_messages(t):
    return messages(t)


CARRIERS = [("dhl", "DHL"), ("ups", "UPS"), ("fedex", "FedEx")]

SHIPMENTS = """shipments as (
  with s as (select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || round(l_extendedprice * 100)::bigint as shipment_id, l_orderkey as order_id,
                    case when l_linenumber <> 7 then l_orderkey * 10 + case when l_linestatus = 'O' then 1 else 0 end end as batch_id, l_orderkey::varchar as tracking_number, l_shipdate as created_at,
                    case when l_linenumber <> 5 then l_shipdate + to_days(l_linenumber % 3) end as received_at, case when l_partkey % 11 <> 0 then l_shipdate + to_days((l_linenumber % 3 + l_suppkey % 6 + 1)::int) end as delivered_at,
                    (['dhl express', 'ups', 'fedex intl', 'local courier'])[(l_suppkey % 4 + 1)::int] as carrier, l_orderkey % 2 = 1 as is_cross_docking,
                    case when l_partkey % 97 = 0 then 'drop_shipping:customer' when l_orderkey % 2 = 0 then 'drop_shipping:customer' when l_linenumber % 2 = 0 then 'cross_docking:warehouse' else 'cross_docking:customer' end as leg
             from lineitem where l_orderkey % 71 <> 0),
       m as (select tracking_number, count(*) as n, count(*) filter (where has_message_alert) as a, min(received_at) filter (where status in ('In Transit', 'Acceptance scan')) as got, max(received_at) filter (where status = 'Delivered') as done,
                    max(status) filter (where is_last_message) as last_status, bool_or(has_message_alert) filter (where is_last_message) as last_alert from messages group by 1)
  select shipment_id, order_id, batch_id, tracking_number, created_at, coalesce(got, received_at) as received_at, coalesce(done, delivered_at) as delivered_at,
         case when contains(carrier, 'dhl') then 'DHL' when contains(carrier, 'ups') then 'UPS' when contains(carrier, 'fedex') then 'FedEx' else carrier end as carrier, leg, is_cross_docking,
         coalesce(last_status, 'unknown') as last_status, coalesce(a, 0) as n_alerts, coalesce(last_alert, false) as has_alert,
         coalesce(done, delivered_at) is not null or coalesce(n, 0) >= 3 or coalesce(got, received_at) is not null as is_valid,
         row_number() over (partition by order_id, leg order by created_at, shipment_id) = 1 as is_first_of_leg from s left join m using (tracking_number)
  union all
  select null, o_orderkey, null, 'Freight ' || o_orderkey, null, null, null, null, null, null, null, null, null, null, null from orders where o_orderkey % 3 = 0 and o_orderkey not in (select l_orderkey from lineitem))"""


def shipments(t):
    line = F.col("l_linenumber")
    key = F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], cents("l_extendedprice").cast("string"))
    names = F.array(*[F.lit(x) for x in ("DHL Express", "ups", "FedEx Intl", "Local Courier")])
    rows = t["lineitem"].select(
        key.alias("shipment_id"), F.col("l_orderkey").alias("order_id"), F.when(line != 7, F.col("l_orderkey") * 10 + (F.col("l_linestatus") == "O").cast("int")).alias("batch_id"),
        F.col("l_orderkey").cast("string").alias("tracking_number"), F.col("l_shipdate").alias("created_at"), F.when(line != 5, add_part("l_shipdate", line % 3, "day")).alias("received_at"),
        F.when(F.col("l_partkey") % 11 != 0, add_part("l_shipdate", line % 3 + F.col("l_suppkey") % 6 + 1, "day")).alias("delivered_at"),
        F.get(names, (F.col("l_suppkey") % 4).cast("int")).alias("carrier"), (F.col("l_orderkey") % 2 == 1).alias("is_cross_docking"), (line % 2 == 0).alias("to_warehouse"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit("drop_shipping:customer")).alias("leg_override"),
    )
    k = F.col("o_orderkey")
    note = F.when(k % 3 == 0, F.concat(F.lit("Freight "), k.cast("string"))).otherwise("post")
    tests = t["orders"].filter("o_orderkey % 71 = 0").select(k.alias("order_id"))
    return P.shipment_fact(rows, messages(t), t["orders"].select(k.alias("order_id"), note.alias("tracking_note")), CARRIERS, tests)


@register("shipment_fact", f"{S.ctes(MESSAGES, SHIPMENTS)} select * from shipments")
def shipment_fact(t):
    return shipments(t)


BATCHES = """batches as (
  with g as (select order_id, batch_id, bool_or(is_cross_docking) as is_cross_docking, count(*) filter (where is_valid) as n_shipments,
                    min(created_at) filter (where leg = 'cross_docking:warehouse') as label_to_cross_dock_at, min(received_at) filter (where leg = 'cross_docking:warehouse') as received_to_cross_dock_at,
                    min(delivered_at) filter (where leg = 'cross_docking:warehouse') as delivered_to_cross_dock_at,
                    min(case when is_cross_docking then least(created_at, received_at) else created_at end) filter (where not is_cross_docking or leg = 'cross_docking:customer') as label_to_customer_at,
                    min(received_at) filter (where not is_cross_docking or leg = 'cross_docking:customer') as received_to_customer_at,
                    min(delivered_at) filter (where not is_cross_docking or leg = 'cross_docking:customer') as delivered_to_customer_at, sum(n_alerts) as n_alerts,
                    string_agg(distinct carrier, ' ' order by carrier) filter (where not is_cross_docking or leg = 'cross_docking:customer') as carriers_to_customer
             from shipments where batch_id is not null group by 1, 2)
  select * exclude (n_alerts), n_shipments > 0 as is_valid_batch, n_alerts > 0 as has_had_alerts, coalesce(label_to_cross_dock_at, label_to_customer_at) as first_label_at from g)"""


@register("batch_fact", f"{S.ctes(MESSAGES, SHIPMENTS, BATCHES)} select * from batches")
def batch_fact(t):
    return P.batch_fact(shipments(t))


@register("logistics_timeline", f"""{S.ctes(MESSAGES, SHIPMENTS, BATCHES, S.MILESTONES)}
    , p as (select order_id, sum(n_shipments)::bigint as n_shipments, count(*) filter (where is_valid_batch) as n_batches, min(label_to_cross_dock_at) as lc, min(received_to_cross_dock_at) as rc, min(delivered_to_cross_dock_at) as dc,
                   min(label_to_customer_at) as lu, min(received_to_customer_at) as ru, min(delivered_to_customer_at) as du from batches group by 1),
      j as (select o_orderkey as order_id, o_orderkey % 2 = 1 as x, case when o_orderkey % 4 = 0 then delivered_at end as delivered_at, case when o_orderstatus = 'F' then delivered_at + interval 30 day end as completed_at, p.* exclude (order_id)
            from milestones left join p on p.order_id = o_orderkey),
      k as (select *, case when x then not coalesce(rc > dc, false) end as dock_dates_ok, not coalesce(case when x then rc > du else ru > du end, false) as customer_dates_ok,
                   case when x then not (coalesce(rc > du, false) or coalesce(rc > dc, false) or coalesce(rc > ru, false) or coalesce(dc > ru, false) or coalesce(dc > du, false) or coalesce(ru > du, false))
                        else not coalesce(ru > du, false) end as has_consistent_dates from j),
      d as (select *, case when customer_dates_ok then coalesce(du, delivered_at) end as del from k)
    select order_id, x as is_cross_docking, coalesce(n_shipments, 1) as n_shipments, n_batches, dock_dates_ok, customer_dates_ok, has_consistent_dates, case when x then lc else lu end as label_at,
           case when x then rc else ru end as shipped_at, ru as shipped_to_customer_at, case when x then ru end as shipped_from_cross_dock_at, del as delivered_at,
           coalesce(del, case when ru + interval 7 day < timestamp '2001-09-01' then ru + interval 7 day end, completed_at) as derived_delivered_at, case when x and dock_dates_ok then dc end as delivered_to_cross_dock_at from d""")
def logistics_timeline(t):
    k = F.col("o_orderkey")
    orders = frames.milestones(t).select(
        k.alias("order_id"), (k % 2 == 1).alias("is_cross_docking"), F.when(k % 4 == 0, F.col("delivered_at")).alias("delivered_at"),
        F.when(F.col("o_orderstatus") == "F", add_part("delivered_at", 30, "day")).alias("completed_at"),
    )
    return P.logistics_timeline(P.batch_fact(shipments(t)), orders, AS_OF)


@register("geo_resolution", """
    with c as (select n_nationkey, n_name, r_name from nation join region on r_regionkey = n_regionkey),
         o as (select o_orderkey as order_id, o_orderkey % 100 as supplier_id, case when o_orderkey % 400 = 9 then 5 else o_custkey end as address_id, o_orderkey % 2 = 1 and not coalesce(case when o_orderkey % 7 <> 0 then o_orderkey % 5 = 0 end, false) as is_cross_docking from orders),
         st as (select * from (values ('ca', 'California'), ('ny', 'New York'), ('tx', 'Texas')) v(code, state)),
         a as (select c_custkey as address_id, n_name as destination_country, r_name as destination_region, 'city ' || c_custkey % 50 as destination_city, coalesce(s1.state, s2.state) as destination_state
               from (select *, lower(regexp_replace((['US-CA', 'texas', 'US-NY', 'zz'])[(c_custkey % 4 + 1)::int], '^US-', '')) as area from customer) left join c on n_nationkey = c_nationkey
               left join st s1 on s1.code = area left join st s2 on lower(s2.state) = area)
    select order_id, supplier_id, is_cross_docking, destination_country, destination_region, destination_city, destination_state, c.n_name as origin_country, c.r_name as origin_region
    from o left join a using (address_id) left join supplier on s_suppkey = supplier_id left join c on n_nationkey = s_nationkey""")
def geo_resolution(t):
    k = F.col("o_orderkey")
    orders = t["orders"].select(
        k.alias("order_id"), (k % 100).alias("supplier_id"), F.col("o_custkey").alias("address_id"), (k % 2 == 1).alias("is_cross_docking"), F.when(k % 7 != 0, k % 5 == 0).alias("is_direct")
    )
    countries = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )
    areas = F.array(*[F.lit(x) for x in ("US-CA", "texas", "US-NY", "zz")])
    c = F.col("c_custkey")
    addresses = t["customer"].select(
        c.alias("address_id"), F.col("c_nationkey").alias("country_id"), F.get(areas, (c % 4).cast("int")).alias("area"), F.concat(F.lit("city "), (c % 50).cast("string")).alias("city")
    )
    states = F.broadcast(t.spark.createDataFrame([("CA", "California"), ("NY", "New York"), ("TX", "Texas")], "code string, state string"))
    exceptions = t["orders"].filter("o_orderkey % 400 = 9").select(k.alias("order_id"), F.lit(5).cast("long").alias("address_id"))
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("supplier_id"), F.col("s_nationkey").alias("country_id"))
    return P.geo_resolution(orders, suppliers, addresses, countries, states, exceptions)


@register("logistics_ops", S.ctes(S.RATES) + """
    , l as (select l_orderkey * 10 + l_linenumber as operation_id, l_orderkey::varchar as tracking_number, case when l_partkey % 13 = 0 then 'n/a' else l_quantity::bigint || '.5' end as w, round(l_extendedprice)::bigint as cost_cents,
                   (['USD', 'EUR', 'GBP'])[(l_orderkey % 3 + 1)::int] as currency, l_shipdate as started_at, l_shipdate + to_seconds(l_linenumber * 61) as labelled_at,
                   case l_partkey % 3 when 0 then true when 1 then false end as is_conforming, l_returnflag, coalesce(try_cast(case when l_partkey % 13 = 0 then 'n/a' else l_quantity::bigint || '.5' end as double), 0) as kg from lineitem)
    select 'eu' as region, md5('eu_' || operation_id) as operation_key, operation_id, tracking_number, kg as weight_kg, kg / 0.45359237::double as weight_lb, coalesce(cost_cents / rate, 0) as cost_usd_cents,
           date_diff('second', started_at, labelled_at) as seconds_spent, is_conforming from l left join rates r on r.currency = l.currency and r.date = labelled_at::date where l_returnflag = 'A'
    union all select 'us', md5('us_' || operation_id), operation_id, tracking_number, kg * 0.45359237::double, kg, cost_cents::double, date_diff('second', started_at, labelled_at), is_conforming from l where l_returnflag = 'R'""")
def logistics_ops(t):
    part = F.col("l_partkey")
    rows = t["lineitem"].select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("operation_id"), F.col("l_orderkey").cast("string").alias("tracking_number"),
        F.when(part % 13 == 0, "n/a").otherwise(F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit(".5"))).alias("weight_text"),
        F.round("l_extendedprice", 0).cast("long").alias("cost_cents"), F.get(F.array(*[F.lit(x) for x in frames.CURRENCIES]), (F.col("l_orderkey") % 3).cast("int")).alias("currency"),
        F.col("l_shipdate").alias("started_at"), add_part("l_shipdate", F.col("l_linenumber") * 61, "second").alias("labelled_at"),
        F.when(part % 3 == 0, "true").when(part % 3 == 1, "false").otherwise("").alias("conforming_text"), "l_returnflag",
    )
    return P.logistics_operations(rows.filter("l_returnflag = 'A'").drop("l_returnflag"), rows.filter("l_returnflag = 'R'").drop("l_returnflag"), frames.rates(t))


@register("logistics_scans", """
    select event_id, location, ts, timezone('Europe/Amsterdam', timezone('UTC', ts)) as ts_home,
           case location when 'Chicago' then timezone('America/Chicago', timezone('UTC', ts)) when 'Amsterdam' then timezone('Europe/Amsterdam', timezone('UTC', ts))
                when 'Telford' then timezone('Europe/London', timezone('UTC', ts)) else ts end as ts_local
    from (select event_id, ts, case user_id % 4 when 0 then 'Chicago' when 1 then 'Amsterdam' when 2 then 'Telford' else 'Delft' end as location from events)""")
def logistics_scans(t):
    u = F.col("user_id") % 4
    place = F.when(u == 0, "Chicago").when(u == 1, "Amsterdam").when(u == 2, "Telford").otherwise("Delft")
    zones = {"Chicago": "America/Chicago", "Amsterdam": "Europe/Amsterdam", "Telford": "Europe/London"}
    return P.scans_local_time(t["events"].select("event_id", "ts", place.alias("location")), zones, "ts", "Europe/Amsterdam")


@register("hold_rack", """
    select event_id, user_id as document_number, event_type as hold_rack_status, ts as status_at, min(ts) over (partition by user_id) as date_entered, max(ts) over (partition by user_id) as latest_contact from events""")
def hold_rack(t):
    rows = t["events"].select("event_id", F.col("user_id").alias("document_number"), F.col("event_type").alias("hold_rack_status"), F.col("ts").alias("status_at"))
    return P.hold_rack(rows, "document_number", "status_at")


