"""The derived frames in SQL, for use as common table expressions."""

RATES = """rates as (
  select c.currency, d.date,
         case c.currency when 'USD' then 100 when 'EUR' then 80 + day(d.date) % 10 else 70 + day(d.date) % 10 end / 100 as rate
  from (select distinct o_orderdate::date as date from orders) d
  cross join (values ('USD'), ('EUR'), ('GBP')) c(currency))"""

CURRENCY = "(['USD', 'EUR', 'GBP'])[(o_custkey % 3 + 1)::int]"

CUSTOMER_V2 = """customer_v2 as (
  select c_custkey, c_name, c_nationkey, case when c_custkey % 7 = 0 then c_acctbal + 100 else c_acctbal end as c_acctbal, c_mktsegment
  from customer where c_custkey % 50 <> 0
  union all
  select c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment from customer where c_custkey % 100 = 1)"""

SUPPLIER_V1 = "supplier_v1 as (select *, timestamp '2000-01-01' as updated_at from supplier)"

SUPPLIER_V2 = """supplier_v2 as (
  select s_suppkey, s_name, s_nationkey, case when s_suppkey % 7 = 0 then s_acctbal + 100 else s_acctbal end as s_acctbal,
         case when s_suppkey % 7 = 0 then timestamp '2001-01-01' else timestamp '2000-01-01' end as updated_at
  from supplier where s_suppkey % 50 <> 0
  union all
  select s_suppkey + 1000000, s_name, s_nationkey, s_acctbal, timestamp '2001-01-01' from supplier where s_suppkey % 100 = 1)"""

ORDERS_V2 = """orders_v2 as (
  select o_orderkey, o_custkey, case when o_orderkey % 11 = 0 then 'F' else o_orderstatus end as o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderkey % 97 <> 0)"""

SUPPLIER_HISTORY = """supplier_history as (
  select s_suppkey, v.valid_from, v.valid_to, (s_suppkey % 5 + v.i) / 100 as rate
  from supplier cross join (values
    (1, timestamp '1995-01-01', timestamp '1997-07-01'),
    (2, timestamp '1997-07-01', timestamp '1999-07-01'),
    (3, timestamp '1999-07-01', null)) v(i, valid_from, valid_to))"""

ORDER_INTERVAL = """order_interval as (
  select o_orderkey, o_custkey, o_totalprice, o_orderdate as start_at,
         o_orderdate + to_days((o_orderkey % 30 + 1)::int) as end_at
  from orders)"""

MILESTONES = """milestones as (
  select *, case when o_orderkey % 19 <> 0 then shipped_at + to_days((o_orderkey % 7 + 1)::int) end as delivered_at
  from (select o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderdate as created_at,
               o_orderdate + interval 10 day as promised_at,
               o_orderdate + to_days((o_orderkey % 20 + 1)::int) as shipped_at,
               case when o_orderkey % 13 = 0 then o_orderdate + interval 2 day end as cancelled_at
        from orders))"""

TIMED_INTERVAL = """timed_interval as (
  select *, started_at + to_minutes(o_orderkey * 91 % 20000) as finished_at
  from (select o_orderkey, o_custkey, o_orderdate + to_minutes(o_orderkey * 37 % 1440) as started_at from orders))"""

MESSY_CUSTOMER = """messy_customer as (
  select c_custkey, c_name, c_nationkey,
         case when c_custkey % 10 = 0 then '' else c_mktsegment end as c_mktsegment,
         case when c_custkey % 17 = 0 then 'n/a' else cast(cast(round(c_acctbal * 100) as bigint) as varchar) end as balance_cents,
         case c_custkey % 3 when 0 then 'true' when 1 then 'false' else '' end as is_strategic,
         case when c_custkey % 23 = 0 then 'unknown' else c_nationkey::varchar end as nation_text
  from customer)"""

LEGACY_ORDERS = """legacy_orders as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         case when o_orderkey % 2 = 0 then 'phone' else 'mail' end as channel
  from orders where o_orderdate < timestamp '1996-01-01')"""

PARENT_ORDERS = """parent_orders as (
  select o_orderkey, o_custkey, o_orderdate, o_totalprice, case when o_orderkey % 4 = 0 then prev end as parent_key
  from (select *, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as prev from orders))"""


def ctes(*frames: str) -> str:
    return "with " + ",\n".join(frames)

MART_ORDERS = """mart_orders as (
  select *, case when is_sourced then closed_at + to_days((order_id % 4)::int) end as sourced_at,
         subtotal_cents * (order_id % 35 + 60) // 100 as cost_cents
  from (select o_orderkey as order_id, o_custkey as contact_id, case when o_custkey % 4 <> 0 then o_custkey // 5 end as company_id,
               (['CNC', '3DP', 'IM', 'SM'])[(o_orderkey % 4 + 1)::int] as technology, o_orderdate as created_at,
               case when o_orderkey % 10 <> 0 then o_orderdate + to_days((o_orderkey % 3)::int) end as submitted_at,
               o_orderstatus <> 'O' as is_closed,
               case when o_orderstatus <> 'O' then o_orderdate + to_days((o_orderkey % 9 + 1)::int) end as closed_at,
               o_orderstatus = 'F' as is_sourced, round(o_totalprice * 100)::bigint as subtotal_cents,
               o_custkey % 3 = 0 as is_strategic, o_orderpriority as priority
        from orders))"""

CONTACTS = """contacts as (
  select c_custkey as contact_id, case when c_custkey % 4 <> 0 then c_custkey // 5 end as company_id, c_name as name,
         c_mktsegment as segment, n_name as country, r_name as region,
         case when c_custkey % 10 = 0 then 'outbound' else 'inbound' end as channel_type,
         case when c_custkey % 5 <> 0 then 'tok' || (c_custkey // 3) else '' end as token,
         timestamp '1994-06-01' + to_days((c_custkey * 7 % 900)::int) as created_at,
         case when c_custkey % 6 <> 0 then timestamp '1994-06-01' + to_days((c_custkey * 7 % 900 + c_custkey % 5)::int) end as lead_at,
         round(c_acctbal * 100)::bigint as balance_cents
  from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey)"""

DOC_LINES = """doc_lines as (
  select l_orderkey as order_id, l_orderkey * 10 + case l_returnflag when 'A' then 0 when 'N' then 2 else 4 end + case when l_linestatus = 'O' then 1 else 0 end as doc_id,
         case when l_returnflag = 'A' then 'quote' else 'purchase_order' end as doc_type, l_linestatus = 'O' as is_active, l_linenumber::bigint as line_number,
         l_partkey as part_id, l_suppkey as supplier_id, round(l_extendedprice * 100)::bigint as cents, round(l_discount * 100)::bigint as discount_pct,
         l_quantity::bigint as quantity, l_shipdate as dated_at
  from lineitem)"""

DOCUMENTS = DOC_LINES + """, documents as (
  select order_id, doc_id, doc_type, is_active, min(dated_at) as created_at, sum(cents)::bigint as subtotal_cents, min(supplier_id) as supplier_id,
         count(*) as n_lines, max(line_number) as revision, bool_or(discount_pct > 8) as is_admin,
         case when doc_id % 7 <> 0 then max(dated_at) end as finalized_at, (['USD', 'EUR', 'GBP'])[(order_id % 3 + 1)::int] as currency, order_id % 4 + 1 as technology_id
  from doc_lines group by 1, 2, 3, 4)"""


def path(url: str) -> str:
    return f"regexp_replace(split_part(regexp_replace({url}, '^https?://', ''), '?', 1), '^[^/]*/?', '')"


def page(url: str) -> str:
    return f"case when length({path(url)}) < 2 then '/' else replace('/' || {path(url)} || '/', '//', '/') end"


def host(url: str) -> str:
    return f"split_part(split_part(regexp_replace({url}, '^(https?|android-app)://', ''), '/', 1), '?', 1)"


def param(url: str, name: str) -> str:
    return f"nullif(split_part(split_part({url}, '{name}=', 2), '&', 1), '')"


WEB_CONTACTS = CONTACTS + """, web_contacts as (
  select contact_id, company_id, country, token, created_at, created_at + to_hours(contact_id % 37 - 18) as first_visit_at,
         (['ORGANIC_SEARCH', 'DIRECT_TRAFFIC', 'PAID_SEARCH', 'OFFLINE', 'SOCIAL_MEDIA'])[(contact_id % 6 + 1)::int] as source,
         case when contact_id % 6 = 3 then (['IMPORT', 'API', 'INTEGRATION', 'SALES'])[(contact_id // 6 % 4 + 1)::int] else 'kw' || (contact_id % 9) end as source_data_1,
         case when contact_id % 8 = 3 then 'list-1' end as source_data_2,
         url || case when contains(url, '?') then '&' else '?' end || 'utm_campaign=c' || (contact_id % 20)
           || case contact_id % 11 when 0 then '&utm_source=youtube' when 1 then '&utm_medium=display' else '' end as first_url
  from contacts left join pages on page_id = contact_id // 6)"""

PAGE_GROUPS = f"""page_groups as (
  select page, case when length(page) % 3 = 0 then 'Homepage' else 'Service' end as page_group
  from (select distinct lower({page('url')}) as page from pages) where length(page) % 3 <> 2)"""

BIDS = """bids as (
  select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || round(l_extendedprice * 100)::bigint as bid_id,
         l_orderkey * 10 + case when l_linestatus = 'O' then 1 else 0 end as auction_id, l_orderkey as order_id, l_orderkey % 5 = 0 as is_rfq, l_suppkey as supplier_id,
         l_shipdate - interval 3 day as assigned_at, case when l_linenumber % 3 <> 0 then l_shipdate - interval 2 day end as seen_at,
         case when l_linenumber % 7 <> 0 then l_shipdate end as placed_at,
         case when l_linenumber % 7 <> 0 then case l_returnflag when 'A' then 'accepted' when 'N' then 'countered' else 'rejected' end end as response_type,
         case when l_returnflag <> 'R' then round(l_extendedprice * 100)::bigint end as bid_cents, l_quantity::bigint as lead_time,
         round(l_discount * 100)::bigint as margin_pct, l_linenumber % 2 = 0 as is_active
  from lineitem)"""

AUCTIONS = BIDS + """, auctions as (
  select auction_id, order_id, is_rfq, case when is_rfq then 'RFQ' else 'RDA' end as auction_type, min(assigned_at) as started_at, max(placed_at) as finished_at,
         case when auction_id % 4 <> 0 then arg_min(bid_id, (bid_cents, bid_id)) filter (where response_type in ('accepted', 'countered')) end as winning_bid_id,
         sum(bid_cents)::bigint as amount_cents
  from bids group by auction_id, order_id, is_rfq)"""

ORDER_TIMELINE = MILESTONES + """, order_timeline as (
  select *, coalesce(from_cross_dock_at, shipped_at) as shipped_to_customer_at from (
    select *, to_cross_dock_at + to_days((order_id % 5)::int) as from_cross_dock_at, order_id % 3 as first_leg_buffer_days from (
      select *, case when is_cross_docking then shipped_at + to_days((order_id % 4)::int) end as to_cross_dock_at from (
        select o_orderkey as order_id, created_at, created_at + interval 2 day as sourced_at, case when o_orderkey % 23 <> 0 then created_at + interval 8 day end as promised_supplier_at,
               case when o_orderkey % 29 <> 0 then promised_at end as promised_customer_at, promised_at + to_days((o_orderkey % 4)::int) as expected_at,
               case when o_orderkey % 17 <> 0 then shipped_at end as shipped_at, shipped_at - to_days((o_orderkey % 3)::int) as label_at,
               case when cancelled_at is not null then 'canceled' when delivered_at is not null then 'delivered' else 'in_production' end as status,
               case when o_orderkey % 11 = 0 then '3' else (o_orderkey % 3)::varchar end as technology_id, case when o_orderkey % 22 = 0 then 'Tooling & Samples' else 'standard' end as deal_type,
               case when o_orderkey % 4 <> 0 then created_at + interval 6 day end as own_promise_at,
               o_orderkey % 31 = 0 as on_customer_hold, delivered_at, o_orderkey % 2 = 1 as is_cross_docking from milestones))))"""
