"""Quote, purchase order and line queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, register
from millrace.functions.columns import cents
from millrace.functions.dates import add_part
from millrace.operators.ordered import UNCHUNKED
from millrace.operators.sets import union_all
from millrace.plans import documents as D
from millrace.plans import finance
from millrace.sources import frames
from millrace.sources.session import cut_lineage
from millrace.sources.tables import is_dealt

CUT_OVER = "1998-10-01"


def rollup_lines(t):
    n = F.col("l_linenumber")
    lines = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    quantity = F.col("l_quantity").cast("long")
    return lines.select(
        F.col("l_orderkey").alias("order_id"), F.when(n == 7, "shipping").when(n == 6, "surcharge").otherwise("part").alias("type"),
        n.alias("line_number"), F.col("p_name").alias("title"), F.col("p_type").alias("material"), F.col("p_brand").alias("process"),
        quantity.alias("quantity"), F.when(F.col("l_partkey") % 20 != 0, quantity * F.col("p_size") * 10).alias("weight_g"),
        F.when(F.col("l_suppkey") % 17 != 0, quantity * F.col("p_size")).alias("volume_cm3"), cents("l_extendedprice").alias("price_cents"),
        (F.col("l_tax") >= 0.06).alias("manually_edited"), F.when(F.col("l_linestatus") == "F", F.col("l_discount") > 0.08).alias("has_note"),
    )


@register("line_item_rollup", """
    with l as (select l_orderkey as order_id, case l_linenumber when 7 then 'shipping' when 6 then 'surcharge' else 'part' end as type, l_linenumber as ln,
                      p_name as title, p_type as material, p_brand as process, l_quantity::bigint as quantity,
                      case when l_partkey % 20 <> 0 then l_quantity::bigint * p_size * 10 end as weight_g,
                      case when l_suppkey % 17 <> 0 then l_quantity::bigint * p_size end as volume_cm3, round(l_extendedprice * 100)::bigint as cents,
                      l_tax >= 0.06 as edited, case when l_linestatus = 'F' then l_discount > 0.08 end as note from lineitem join part on p_partkey = l_partkey),
         p as (select order_id, count(*) as n_parts, sum(quantity)::bigint as total_quantity,
                      case when count(*) = count(weight_g) then sum(weight_g)::bigint end as total_weight_g,
                      case when count(*) = count(volume_cm3) then sum(volume_cm3)::bigint end as total_volume_cm3,
                      count(*) filter (where edited) as n_edited, sum(cents)::bigint as parts_cents, bool_or(coalesce(note, false)) as has_note,
                      arg_min(title, (-quantity, -cents, ln, title)) as leading_title, count(distinct material) as n_materials, count(distinct process) as n_processes,
                      string_agg(distinct title, ', ' order by title) as titles from l where type = 'part' group by 1),
         a as (select order_id, count(*) as n_lines, sum(cents)::bigint as subtotal_cents, sum(case when type = 'shipping' then cents else 0 end)::bigint as shipping_cents,
                      sum(case when type = 'surcharge' then cents else 0 end)::bigint as other_cents from l group by 1)
    select order_id, n_lines, subtotal_cents, coalesce(n_parts, 0) as n_parts, total_quantity, total_weight_g, total_volume_cm3,
           case when coalesce(n_edited, 0) = coalesce(n_parts, 0) then 'all' when n_edited > 0 then 'some' else 'none' end as edited_status,
           coalesce(n_edited, 0) as n_edited, parts_cents, shipping_cents, other_cents, has_note, leading_title, n_materials, n_processes, titles
    from a left join p using (order_id)""")
def line_item_rollup(t):
    return D.line_item_rollup(rollup_lines(t), "order_id")


@register("line_item_fact", S.ctes(S.DOCUMENTS, S.RATES) + """
    , l as (select *, case when line_number = 7 then 'surcharge' else 'part' end as type, case when line_number = 3 then cents end as manual_cents,
                   case when line_number in (1, 2) then cents // quantity end as unit_cents, case when line_number = 2 then 5000 end as tooling_cents,
                   100 + order_id % 3 * 5 as multiplier_pct from doc_lines),
      p as (select l.order_id, type, l.doc_id, line_number, part_id, l.supplier_id, cents, quantity, currency,
              case when manual_cents is not null then manual_cents::double when type <> 'part' then cents::double
                   when unit_cents is not null then (unit_cents * quantity + coalesce(tooling_cents, 0))::double
                   else round_even(cents * multiplier_pct / (quantity * 100), 0) * quantity end / 100::double as price,
              case when order_id % 2 = 0 and d.created_at + interval 3 day >= timestamp '1998-10-01' then d.created_at + interval 3 day
                   when finalized_at is not null then finalized_at else d.created_at end::date as rate_date,
              unit_cents is not null or manual_cents is not null as manually_edited
            from l join (select doc_id, currency, created_at, finalized_at from documents) d using (doc_id))
    select order_id, type, doc_id, line_number, part_id, supplier_id, cents, quantity, price, rate_date::timestamp as rate_date, price / rate as price_usd, manually_edited
    from p left join rates r on r.currency = p.currency and r.date = rate_date""")
def line_item_fact(t):
    n = F.col("line_number")
    lines = frames.doc_lines(t).withColumns({
        "type": F.when(n == 7, "surcharge").otherwise("part"), "manual_cents": F.when(n == 3, F.col("cents")),
        "auto_cents": F.col("cents"), "unit_cents": F.when(n.isin(1, 2), F.expr("cents div quantity")),
        "tooling_cents": F.when(n == 2, 5000), "multiplier_pct": F.col("order_id") % 3 * 5 + 100,
    })
    heads = frames.documents(t).withColumn("closed_at", F.when(F.col("order_id") % 2 == 0, add_part("created_at", 3, "day")))
    return D.line_item_fact(lines, heads, frames.rates(t), CUT_OVER)


@register("document_versions", S.ctes(S.DOCUMENTS, S.RATES) + """
    , v as (select d.*, subtotal_cents / rate as usd from documents d left join rates r on r.currency = d.currency and r.date = finalized_at::date),
      q as (select *, row_number() over (partition by order_id order by created_at, doc_id) as rn, row_number() over (partition by order_id order by revision desc, doc_id desc) as rm
            from v where doc_type = 'quote'),
      f as (select *, row_number() over (partition by order_id order by finalized_at, doc_id) as rn from v where doc_type = 'purchase_order' and finalized_at is not null),
      a as (select *, row_number() over (partition by order_id order by coalesce(finalized_at, timestamp '0001-01-01') desc, doc_id desc) as rn
            from v where doc_type = 'purchase_order' and is_active),
      p as (select f.*, row_number() over (partition by f.order_id order by f.finalized_at desc, f.doc_id desc) as rp
            from f join (select order_id, doc_id as d1, finalized_at as f1 from f where rn = 1) o using (order_id)
            where date_diff('day', f1, f.finalized_at) <= case when technology_id = 2 then 2 else 7 end or d1 = f.doc_id),
      o as (select order_id, min(finalized_at) filter (where doc_type = 'quote') as first_submitted_at, max(revision) filter (where doc_type = 'quote') as n_quote_versions,
                   bool_or(is_admin) filter (where doc_type = 'quote') as has_admin_quote, count(*) filter (where doc_type = 'purchase_order') as n_purchase_orders from v group by 1)
    select o.*, q1.doc_id as first_quote_id, q1.is_admin as first_quote_by_admin, qm.doc_id as main_quote_id,
           case when date_diff('day', qm.created_at, qm.finalized_at) <= 5 then 6 when date_diff('day', qm.created_at, qm.finalized_at) <= 10 then 15
                when date_diff('day', qm.created_at, qm.finalized_at) <= 15 then 24 when date_diff('day', qm.created_at, qm.finalized_at) <= 20 then 32 else 42 end::bigint as sourcing_window,
           f.doc_id as first_po_id, f.finalized_at as sourced_at, f.supplier_id as first_supplier_id, f.usd as first_cost_usd_cents,
           a.doc_id as active_po_id, a.supplier_id as active_supplier_id, p.doc_id as production_po_id, p.finalized_at as production_finalized_at, p.usd as production_cost_usd_cents,
           coalesce(f.supplier_id <> a.supplier_id, false) as is_resourced
    from o left join q q1 on q1.order_id = o.order_id and q1.rn = 1 left join q qm on qm.order_id = o.order_id and qm.rm = 1
    left join f on f.order_id = o.order_id and f.rn = 1 left join a on a.order_id = o.order_id and a.rn = 1 left join p on p.order_id = o.order_id and p.rp = 1""")
def document_versions(t):
    return D.document_versions(frames.documents(t), frames.rates(t))


FIN_ORDERS = S.MILESTONES + """, fin_orders as (
  select o_orderkey as order_id, created_at, created_at + to_days((o_orderkey % 9 + 1)::int) as closed_at, shipped_at, delivered_at, completed_at,
         round(o_totalprice * 100)::bigint as subtotal_cents,
         coalesce(case when o_orderkey % 500 = 7 then timestamp '1998-10-15' end,
                  least(case when shipped_at > delivered_at then completed_at else delivered_at end, completed_at)) as recognized_at
  from (select *, case when o_orderstatus = 'F' then coalesce(delivered_at, shipped_at) + interval 1 day end as completed_at from milestones))"""

INCREMENTS = """increments as (
  with v as (select d.*, recognized_at, completed_at, bool_or(is_active) over (partition by order_id) as has_active,
               case when recognized_at >= timestamp '1998-10-01' and d.created_at <= recognized_at then recognized_at
                    when d.created_at <= delivered_at then delivered_at else d.created_at end::date as rate_date
             from documents d left join (select order_id, recognized_at, completed_at, delivered_at from fin_orders) o using (order_id) where doc_type = 'purchase_order'),
       u as (select v.*, subtotal_cents / rate as usd from v left join rates r on r.currency = v.currency and r.date = rate_date),
       s as (select *, lag(doc_id) over w as pd, lag(subtotal_cents) over w as pc, lag(usd) over w as pu,
               case when completed_at <= timestamp '2001-09-01' and finalized_at <= timestamp '2001-09-01' then greatest(finalized_at, completed_at) end as legacy
             from u window w as (partition by order_id order by finalized_at nulls first, doc_id)),
       x as (select *, case when doc_id % 5000 = 3 then timestamp '1999-12-31' when not has_active then null when legacy < timestamp '1998-10-01' then legacy
                 when finalized_at is not null and recognized_at is not null then greatest(finalized_at, recognized_at, timestamp '1998-10-01') end as rec_at from s)
  select order_id, doc_id, finalized_at, currency, rate_date::timestamp as rate_date, subtotal_cents - case when pd is null then 0 else pc end as cost_cents,
         usd - case when pd is null then 0 else pu end as cost_usd_cents, rec_at as cost_recognized_at, rec_at is not null as is_recognized from x)"""

INVOICES = """invoices as (
  with n as (select doc_id as invoice_id, order_id, created_at, finalized_at, case when doc_id % 11 = 0 then 'processing' else 'paid' end as status, currency,
                    subtotal_cents, doc_type = 'purchase_order' and is_active as is_credit from documents),
       o as (select invoice_id, order_id, created_at, status, n.currency, subtotal_cents, subtotal_cents / rate as usd_cents, null::bigint as remaining_cents, 'old' as system
             from n left join rates r on r.currency = n.currency and r.date = finalized_at::date where created_at < timestamp '1998-03-01' and finalized_at is not null),
       w as (select invoice_id, order_id, created_at, status, n.currency, case when is_credit then -subtotal_cents else subtotal_cents end as subtotal_cents, rate,
                    case when invoice_id % 3 = 0 then subtotal_cents else 0 end as remaining_cents, 'new' as system
             from n left join rates r on r.currency = n.currency and r.date = (created_at - interval 1 day)::date where created_at >= timestamp '1998-03-01'),
       a as (select * from o union all select invoice_id, order_id, created_at, status, currency, subtotal_cents, coalesce(subtotal_cents / rate, subtotal_cents::double), remaining_cents, system from w),
       l as (select a.*, case when completed_at is not null then greatest(a.created_at, completed_at) end as legacy, recognized_at
             from a left join (select order_id, completed_at, recognized_at from fin_orders) f using (order_id)),
       x as (select *, case when invoice_id % 4000 = 1 then timestamp '2000-01-31' when status = 'processing' then null
                 when legacy < timestamp '1998-10-01' then date_trunc('day', legacy)
                 when recognized_at is not null then date_trunc('day', greatest(created_at, recognized_at, timestamp '1998-10-01')) end::timestamp as rec_at from l)
  select invoice_id, order_id, created_at, status, currency, subtotal_cents, usd_cents, remaining_cents, system, rec_at as revenue_recognized_at, rec_at is not null as is_recognized from x)"""


def fin_orders(t):
    """Orders with completion and recognition dates."""
    ms = frames.milestones(t)
    completed = F.when(F.col("o_orderstatus") == "F", add_part(F.coalesce("delivered_at", "shipped_at"), 1, "day"))
    orders = ms.select(
        F.col("o_orderkey").alias("order_id"), "created_at", add_part("created_at", F.col("o_orderkey") % 9 + 1, "day").alias("closed_at"),
        "shipped_at", "delivered_at", completed.alias("completed_at"), cents("o_totalprice").alias("subtotal_cents"),
    )
    listed = t["orders"].filter("o_orderkey % 500 = 7").select(F.col("o_orderkey").alias("order_id"), F.lit("1998-10-15").cast("timestamp_ntz").alias("recognized_at"))
    return finance.recognition(orders, listed)


def increments(t):
    docs = frames.documents(t)
    # The few exceptions are written, so that their size is known and the documents need not move to meet them.
    listed = cut_lineage(docs.filter("doc_id % 5000 = 3").select("doc_id", F.lit("1999-12-31").cast("timestamp_ntz").alias("recognized_at")), "listed-costs")
    chunk = UNCHUNKED if is_dealt(t, "lineitem") else F.trunc("finalized_at", "quarter")
    return D.purchase_order_increments(docs, fin_orders(t), frames.rates(t), listed, AS_OF, CUT_OVER, chunk)


def invoices(t):
    docs = frames.documents(t).withColumnRenamed("doc_id", "invoice_id").withColumns({
        "status": F.when(F.col("invoice_id") % 11 == 0, "processing").otherwise("paid"),
        "is_credit": (F.col("doc_type") == "purchase_order") & F.col("is_active"),
        "remaining_cents": F.when(F.col("invoice_id") % 3 == 0, F.col("subtotal_cents")).otherwise(0),
    })
    both = finance.invoices_from_two_systems(docs, docs, frames.rates(t), "1998-03-01")
    listed = cut_lineage(docs.filter("invoice_id % 4000 = 1").select("invoice_id", F.lit("2000-01-31").cast("timestamp_ntz").alias("recognized_at")), "listed-invoices")
    return finance.invoice_recognition(both, fin_orders(t), listed, CUT_OVER)


FIN_BASE = S.ctes(S.DOCUMENTS, S.RATES, FIN_ORDERS)


@register("purchase_order_increments", f"{FIN_BASE}, {INCREMENTS} select * from increments")
def purchase_order_increments(t):
    return increments(t)


@register("invoice_recognition", f"{FIN_BASE}, {INVOICES} select * from invoices")
def invoice_recognition(t):
    return invoices(t)


LEDGER = """ledger as (
  select doc_id as source_id, 'cost' as type, order_id, date_trunc('day', cost_recognized_at)::timestamp as recognized_date, -cost_usd_cents as usd_cents from increments where is_recognized
  union all select invoice_id, 'revenue', order_id, date_trunc('day', revenue_recognized_at)::timestamp, usd_cents from invoices where is_recognized)"""


@register("contribution_margin", f"{FIN_BASE}, {INCREMENTS}, {INVOICES}, {LEDGER} select * from ledger")
def contribution_margin(t):
    return finance.contribution_margin(increments(t), invoices(t))


@register("contribution_margin_per_order", f"""{FIN_BASE}, {INCREMENTS}, {INVOICES}, {LEDGER}
    select order_id, coalesce(sum(case when type = 'cost' then round(usd_cents)::bigint end), 0)::bigint as cost_cents,
           coalesce(sum(case when type = 'revenue' then round(usd_cents)::bigint end), 0)::bigint as revenue_cents, coalesce(sum(round(usd_cents)::bigint), 0)::bigint as margin_cents
    from ledger group by 1""")
def contribution_margin_per_order(t):
    return finance.margin_per_order(finance.contribution_margin(increments(t), invoices(t)))


@register("payment_label", S.ctes(FIN_ORDERS) + """
    , inv as (select l_orderkey as order_id, l_returnflag = 'R' as is_credit, round(l_extendedprice * 100)::bigint as cents,
                     case when l_returnflag <> 'R' and l_linestatus = 'O' and l_linenumber % 3 = 0 then round(l_extendedprice * 100)::bigint else 0 end as remaining,
                     case when l_returnflag = 'R' and l_linestatus = 'F' and l_linenumber % 2 = 0 then round(l_extendedprice * 100)::bigint else 0 end as unapplied,
                     case when l_linenumber > 1 then l_tax >= 0.08 end as is_downpayment from lineitem),
      b as (select order_id, count(*) filter (where is_downpayment) as down, (coalesce(sum(remaining) filter (where not is_credit), 0) - coalesce(sum(unapplied) filter (where is_credit), 0))::bigint as rem,
                   coalesce(sum(cents) filter (where not is_credit), 0)::bigint as inv, -coalesce(sum(cents) filter (where is_credit), 0)::bigint as cred from inv group by 1),
      pay as (select event_id // 2 as order_id, ts as created_at, case event_type when 'error' then 'failed' when 'signup' then 'new' when 'view' then 'refunded' else 'successful' end as status,
                     case when event_id % 4 = 0 then 'refund' else 'payment' end as type, case when user_id % 3 = 0 then 'bank transfer' else 'card' end as method from events),
      p as (select order_id, max(created_at) as paid_at, max(case when status <> 'failed' and type = 'payment' then method end) as method,
                   bool_or(status in ('successful', 'refunded') and type = 'payment') as success, count(*) filter (where status = 'failed' and type = 'payment') as n_failed
            from pay where status <> 'new' group by 1),
      x as (select o.order_id, created_at, closed_at, subtotal_cents as sub, coalesce(rem, 0) as rem, coalesce(inv, 0) as inv, coalesce(cred, 0) as cred, coalesce(down, 0) as down,
                   paid_at, method, coalesce(success, false) as success, coalesce(n_failed, 0) as n_failed from fin_orders o left join b using (order_id) left join p using (order_id))
    select order_id, rem as remaining_cents, inv as invoiced_cents, cred as credited_cents, down as n_downpayments,
           case when created_at < timestamp '1996-01-01' then 'Not Available' when inv = 0 then 'Not yet invoiced' when rem = 0 and inv = abs(cred) then 'Fully Refunded'
                when rem = 0 and inv + cred >= sub then 'Fully Paid' when rem < 0 then 'Credit on Account / Awaiting Refund'
                when down > 0 then case when rem = 0 and inv + cred > 0 and down = 1 then 'First Downpayment Paid' when rem = 0 and inv + cred < sub then 'Issued invoices have been paid'
                     when rem > 0 and down = 1 then 'First Dowpayment Invoice Awaiting Payment' when rem > 0 then 'Awaiting Payment' else 'other' end
                when rem = 0 and inv + cred < sub then 'Paid and Partially Refunded/Credit Applied' when rem > 0 and inv + cred > rem then 'Partial Amount Outstanding'
                when rem > 0 and inv + cred < sub then 'Awaiting Payment and Partially Credited' when rem > 0 and inv + cred >= sub then 'Awaiting Payment' else 'other' end as payment_label,
           success as is_auto_payment, success and coalesce(paid_at::date = closed_at::date, false) and coalesce(method <> 'bank transfer', false) as is_instant_payment,
           coalesce(method, 'manual') as payment_method, n_failed as n_failed_payments from x""")
def payment_label(t):
    credit, price = F.col("l_returnflag") == "R", cents("l_extendedprice")
    bills = t["lineitem"].select(
        F.col("l_orderkey").alias("order_id"), credit.alias("is_credit"), price.alias("subtotal_cents"),
        F.when(~credit & (F.col("l_linestatus") == "O") & (F.col("l_linenumber") % 3 == 0), price).otherwise(0).alias("remaining_cents"),
        F.when(credit & (F.col("l_linestatus") == "F") & (F.col("l_linenumber") % 2 == 0), price).otherwise(0).alias("unapplied_cents"),
        F.when(F.col("l_linenumber") > 1, F.col("l_tax") >= 0.08).alias("is_downpayment"),
    )
    kind = F.col("event_type")
    payments = t["events"].select(
        F.floor(F.col("event_id") / F.lit(2)).alias("order_id"), F.col("ts").alias("created_at"),
        F.when(kind == "error", "failed").when(kind == "signup", "new").when(kind == "view", "refunded").otherwise("successful").alias("status"),
        F.when(F.col("event_id") % 4 == 0, "refund").otherwise("payment").alias("type"),
        F.when(F.col("user_id") % 3 == 0, "bank transfer").otherwise("card").alias("method"),
    )
    return finance.payment_label(fin_orders(t), bills, payments, "1996-01-01")


@register("sales_order_billing", S.ctes(FIN_ORDERS, S.RATES) + f"""
    , s as (select o_orderkey * 10 as sales_order_id, o_orderkey as order_id, o_orderdate as created_at, round(o_totalprice * 100)::bigint as subtotal_cents, {S.CURRENCY} as currency,
                   case o_orderstatus when 'F' then 'Billed' when 'O' then 'Pending Approval' else 'Closed' end as status,
                   case when o_orderkey % 3 = 0 then o_orderdate + interval 20 day end as fulfilled_at from orders where o_orderkey % 41 <> 0)
    select sales_order_id, s.order_id, s.subtotal_cents, coalesce(s.subtotal_cents / rate, s.subtotal_cents::double) as usd_cents,
           case status when 'Pending Approval' then 'Pending Billing' when 'Closed' then 'Cancelled' else status end as billing_status,
           case when status = 'Billed' then 'Billed' when fulfilled_at > timestamp '1998-03-01' then 'Eligible for invoicing'
                when fulfilled_at is null and recognized_at > timestamp '1998-03-01' then 'Eligible for invoicing not fulfilled'
                when fulfilled_at is null and recognized_at is null then 'Not fulfilled not Eligible for invoicing'
                when recognized_at < timestamp '1998-03-01' then 'before this system' else 'Other' end as billable_status
    from s left join rates r on r.currency = s.currency and r.date = (s.created_at - interval 1 day)::date left join fin_orders f on f.order_id = s.order_id""")
def sales_order_billing(t):
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    sales = t["orders"].select(
        (k * 10).alias("sales_order_id"), k.alias("order_id"), F.col("o_orderdate").alias("created_at"), cents("o_totalprice").alias("subtotal_cents"),
        frames.order_currency().alias("currency"), F.when(status == "F", "Billed").when(status == "O", "Pending Approval").otherwise("Closed").alias("status"),
        F.when(k % 3 == 0, add_part("o_orderdate", 20, "day")).alias("fulfilled_at"),
    )
    tests = t["orders"].filter("o_orderkey % 41 = 0").select(k.alias("order_id"))
    return finance.sales_order_billing(sales, fin_orders(t), frames.rates(t), tests, "1998-03-01")


@register("billing_passthrough", """
    with c as (select c_custkey as company_id, c_name as company_name, case when c_custkey % 5 <> 0 then c_custkey - c_custkey % 5 end as parent_id from customer)
    select c.*, k.n_children, case when s.c_custkey is null then null when s.c_custkey % 3 = 0 then 30 else 14 end::bigint as net_days, round(c_acctbal * 100)::bigint as credit_limit_cents,
           case when c.parent_id is null then 'Parent' else 'Child' end as company_type
    from c left join (select parent_id, count(*) as n_children from c where parent_id is not null group by 1) k on k.parent_id = c.company_id
    left join (select * from customer where c_custkey % 7 <> 0) s on s.c_custkey = c.company_id""")
def billing_passthrough(t):
    k = F.col("c_custkey")
    companies = t["customer"].select(k.alias("company_id"), F.col("c_name").alias("company_name"), F.when(k % 5 != 0, k - k % 5).alias("parent_id"))
    settings = t["customer"].filter("c_custkey % 7 <> 0").select(
        k.alias("company_id"), F.when(k % 3 == 0, 30).otherwise(14).alias("net_days"), cents("c_acctbal").alias("credit_limit_cents")
    )
    return finance.billing_terms(companies, settings)


@register("discounts_fact", S.ctes(S.DOC_LINES) + """
    , cart as (select order_id, doc_id, max(line_number) as m from doc_lines group by 1, 2)
    select doc_id * 10 + line_number as line_id, order_id, discount_pct, cents * discount_pct // 100 as discount_cents, case when part_id % 3 = 0 then part_id end as code_id,
           true as has_discount, part_id % 3 = 0 as has_discount_code
    from doc_lines d where discount_pct > 0 and exists (select 1 from cart c where c.order_id = d.order_id and m > 3)""")
def discounts_fact(t):
    lines = frames.doc_lines(t)
    line_id = F.col("doc_id") * 10 + F.col("line_number")
    # lines repeat line numbers inside a document, so the discount carries its own row id for the join
    keyed = lines.withColumn("line_id", F.struct(line_id.alias("id"), "part_id", "supplier_id", "dated_at", "cents", "quantity"))
    discounts = keyed.filter("discount_pct > 0").select(
        "line_id", "discount_pct", F.expr("cents * discount_pct div 100").alias("discount_cents"), F.when(F.col("part_id") % 3 == 0, F.col("part_id")).alias("code_id")
    )
    docs = lines.groupBy("order_id", "doc_id").agg(F.when(F.max("line_number") > 3, "sent").otherwise("cart").alias("status"))
    return finance.discounts_fact(discounts, keyed, docs).withColumn("line_id", F.col("line_id.id"))


@register("co2_estimate", """
    with g as (select * from (values ('NATION_1', 400), ('NATION_2', 300), ('NATION_3', 50), ('Other', 475)) v(country, grid)),
         m as (select * from (values ('NATION_1', 'LARGE', 2000), ('NATION_1', 'SMALL', 1500), ('NATION_2', 'PROMO', 9000), ('Other', 'ECONOMY', 5000)) v(country, material, per_kg)),
         b as (select l_orderkey as order_id, p_type as material, case when s_nationkey in (1, 2, 3) then n_name else 'Other' end as country, l_quantity * p_size as box, l_quantity * p_size * 0.5::double as vol, 2.7::double as density
               from lineitem join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey where p_type <> 'MEDIUM'),
         v as (select order_id, round((box - vol) * 0.33::double * grid)::bigint as mg, round(density * box * per_kg * 0.001::double)::bigint as pg from b left join g using (country) left join m using (country, material))
    select order_id, sum(mg)::bigint as manufacturing_g, sum(pg)::bigint as procurement_g, max(o_custkey % 1000) as logistics_g
    from v left join (select * from orders where o_orderkey % 5 <> 0) on o_orderkey = order_id where mg > 0 group by 1""")
def co2_estimate(t):
    country = F.when(F.col("s_nationkey").isin(1, 2, 3), F.col("n_name")).otherwise("Other")
    box = F.col("l_quantity") * F.col("p_size")
    lines = (
        t["lineitem"].join(t["part"].filter("p_type <> 'MEDIUM'"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("l_orderkey").alias("order_id"), F.col("p_type").alias("material"), country.alias("country"), box.alias("box_cm3"), (box * 0.5).alias("volume_cm3"), F.lit(2.7).alias("density"))
    )
    electricity = t.spark.createDataFrame([("NATION_1", 400), ("NATION_2", 300), ("NATION_3", 50), ("Other", 475)], "country string, grid int")
    materials = t.spark.createDataFrame(
        [("NATION_1", "LARGE", 2000), ("NATION_1", "SMALL", 1500), ("NATION_2", "PROMO", 9000), ("Other", "ECONOMY", 5000)], "country string, material string, per_kg int"
    )
    logistics = t["orders"].filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") % 1000).alias("logistics_g"))
    # both lookups are the literals above
    return finance.co2_estimate(lines, F.broadcast(electricity), F.broadcast(materials), logistics)


@register("reorder_detection", """
    with l as (select p_name as title, p_type as material, p_size // 10 as volume, coalesce(case when o_custkey % 4 <> 0 then o_custkey // 5 end, -o_custkey) as client, o_orderkey, o_orderdate, l_partkey, l_suppkey, l_shipdate
               from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey),
         r as (select title, material, volume, client from l group by 1, 2, 3, 4 having count(distinct o_orderkey) > 1),
         k as (select l.*, rank() over (partition by title, material, volume, client order by o_orderdate) as rank from l)
    select title, material, volume::bigint as volume, client, o_orderkey, o_orderdate, l_partkey, l_suppkey, l_shipdate, rank, rank > 1 as is_reorder from k join r using (title, material, volume, client)""")
def reorder_detection(t):
    client = F.coalesce(F.when(F.col("o_custkey") % 4 != 0, F.floor(F.col("o_custkey") / F.lit(5))), -F.col("o_custkey"))
    lines = (
        t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey")).join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("p_name").alias("title"), F.col("p_type").alias("material"), F.expr("p_size div 10").alias("volume"), client.alias("client"),
                "o_orderkey", "o_orderdate", "l_partkey", "l_suppkey", "l_shipdate")
    )
    return D.reorder_detection(lines, ["title", "material", "volume", "client"], "o_orderkey", "o_orderdate", F.trunc("o_orderdate", "year"))


@register("quote_and_po_line_views", S.ctes(S.DOCUMENTS) + """
    , m as (select order_id, doc_id from (select *, row_number() over (partition by order_id order by revision desc, doc_id desc) as rn from documents where doc_type = 'quote') where rn = 1),
      a as (select l.* from doc_lines l join (select order_id, min(doc_id) as doc_id from doc_lines where doc_type = 'purchase_order' and is_active group by 1) f using (doc_id)),
      c as (select order_id, line_number, min(cents) as cost_cents from a group by 1, 2)
    select 'quote' as view, l.order_id, l.doc_id, l.line_number, l.part_id, l.cents, cost_cents from doc_lines l join m using (doc_id) left join c on c.order_id = l.order_id and c.line_number = l.line_number
    union all select 'purchase_order', order_id, doc_id, line_number, part_id, cents, null from a""")
def quote_and_po_line_views(t):
    lines = frames.doc_lines(t)
    cols = ["view", "order_id", "doc_id", "line_number", "part_id", "cents", "cost_cents"]
    quotes = D.quote_lines(lines, frames.documents(t)).withColumn("view", F.lit("quote")).select(*cols)
    pos = D.po_lines(lines).withColumn("view", F.lit("purchase_order")).withColumn("cost_cents", F.lit(None).cast("long")).select(*cols)
    return union_all(quotes, pos)
