"""Order fact and partner share queries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from millrace.catalog import contacts, documents, fulfilment, sourcing, support
from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, ENTRIES, register
from millrace.functions.columns import cents
from millrace.functions.dates import add_part
from millrace.operators.joins import wide_fact_assembly
from millrace.plans import orders as P
from millrace.plans.sourcing import marked_bids
from millrace.sources import frames
from millrace.sources.session import cut_all, cut_bucketed, cut_lineage
from millrace.sources.tables import Derived

# Cancellation reasons of this binding.
CANCELLATIONS = {0: "New order created", 1: "Lead time cannot be met", 2: "Unusable files"}

# Which columns the order fact takes from which order-level frame.
SIDES = {
    "line_item_rollup": (documents.line_item_rollup, {"n_lines": "n_lines", "total_quantity": "total_quantity", "leading_title": "leading_title", "shipping_line_cents": "shipping_cents"}),
    "document_versions": (documents.document_versions, {
        "first_submitted_at": "first_submitted_at", "n_quote_versions": "n_quote_versions", "sourced_at": "sourced_at", "first_cost_usd_cents": "first_cost_usd_cents",
        "active_supplier_id": "active_supplier_id", "production_finalized_at": "production_finalized_at", "production_cost_usd_cents": "production_cost_usd_cents", "is_resourced": "is_resourced",
    }),
    "payment_label": (documents.payment_label, {"payment_label": "payment_label", "remaining_cents": "remaining_cents"}),
    "logistics_timeline": (fulfilment.logistics_timeline, {"shipped_at": "shipped_at", "derived_delivered_at": "derived_delivered_at", "has_consistent_dates": "has_consistent_dates"}),
    "on_time_rate": (fulfilment.on_time_rate, {"on_time_to_customer": "on_time_to_customer", "on_time_by_supplier": "on_time_by_supplier", "n_delays": "n_delays"}),
    "auction_funnel": (sourcing.auction_funnel, {"n_responses": "n_responses", "has_winning_bid": "has_winning_bid", "winning_supplier_id": "supplier_id"}),
    "rfq_funnel": (sourcing.rfq_funnel, {"n_rfqs": "n_rfqs", "is_sourced_by_rfq": "is_sourced_by_rfq"}),
    "contribution_margin_per_order": (documents.contribution_margin_per_order, {"margin_cents": "margin_cents"}),
    "geo_resolution": (fulfilment.geo_resolution, {"origin_country": "origin_country", "destination_country": "destination_country"}),
    "co2_estimate": (documents.co2_estimate, {"manufacturing_co2_g": "manufacturing_g"}),
    "interactions_per_order": (support.interactions_per_order, {"n_interactions": "n_interactions"}),
    "disputes_and_complaints": (support.disputes_and_complaints, {"disputed_at": "disputed_at", "dispute_resolution": "resolution"}),
}

SIDE_GROUPS = {
    "order-documents": ["line_item_rollup", "document_versions", "payment_label", "contribution_margin_per_order", "co2_estimate"],
    "order-logistics": ["logistics_timeline", "on_time_rate", "geo_resolution"],
    "order-sourcing": ["auction_funnel", "rfq_funnel", "interactions_per_order", "disputes_and_complaints"],
}


def side(t, name):
    build, cols = SIDES[name]
    return build(t).select("order_id", *[F.col(src).alias(out) for out, src in cols.items()])


SIDE_SQL = "\n".join(
    f"left join (select order_id, {', '.join(f'{src} as {out}' for out, src in cols.items())} from ({ENTRIES[name].sql})) {name} using (order_id)" for name, (_, cols) in SIDES.items()
)

ORDER_FACT = f"""{S.ctes(S.MART_ORDERS, S.LEGACY_ORDERS, S.DOCUMENTS)},
  quoted as (select order_id, arg_max(subtotal_cents, (revision, doc_id)) as quoted_cents from documents where doc_type = 'quote' group by 1),
  base as (select o_orderkey as order_id, case when o_orderkey % 50 <> 7 then o_custkey end as contact_id, o_orderdate as created_at, case when o_orderkey % 17 = 0 or o_orderkey % 50 = 7 then 'cart' else 'final' end as quote_status,
                  round(o_totalprice * 100)::bigint as subtotal_cents, case when o_orderkey % 13 = 0 then o_orderkey % 5 end as cancel_code, o_custkey % 97 = 0 as is_internal from orders),
  wide as (select *, case cancel_code when 0 then 'New order created' when 1 then 'Lead time cannot be met' when 2 then 'Unusable files' end as cancellation_reason
           from base left join (select order_id, is_closed, closed_at, case when order_id % 13 = 0 then created_at + interval 2 day end as cancelled_at from mart_orders) st using (order_id) left join quoted using (order_id)
           {SIDE_SQL}),
  flags as (select *, coalesce(date_diff('hour', sourced_at, cancelled_at) < 48, false) and coalesce(cancellation_reason = 'New order created', false) as recreated from wide),
  f as (select *, quote_status = 'cart' as is_cart, case when quote_status <> 'cart' then coalesce(first_submitted_at, created_at) end as submitted_at, sourced_at is not null as is_sourced,
               case when is_closed and not recreated then subtotal_cents else 0 end as closed_cents, case when sourced_at is not null and not recreated then subtotal_cents else 0 end as sourced_cents,
               case when coalesce(production_finalized_at < coalesce(shipped_at, timestamp '2100-01-01'), false) and not coalesce(has_winning_bid, false) then production_cost_usd_cents else first_cost_usd_cents end as po_cost_usd_cents,
               coalesce(active_supplier_id, winning_supplier_id) as supplier_id, case when is_closed then subtotal_cents - coalesce(quoted_cents, 0) - coalesce(shipping_line_cents, 0) > 5000 end as has_amount_gap from flags),
  g as (select *, case when is_sourced and not recreated then coalesce(po_cost_usd_cents, 0) + coalesce(shipping_line_cents, 0) else 0 end as sourced_cost_cents from f where not is_internal or sourced_cents > 0),
  u as (select 'current' as origin, * exclude (recreated, is_internal, cancel_code, quote_status), null as channel from g
        union all by name select 'legacy' as origin, o_orderkey + 10000000 as order_id, o_custkey as contact_id, o_orderdate as created_at, o_orderdate as closed_at, true as is_closed, round(o_totalprice * 100)::bigint as closed_cents, channel from legacy_orders)
select * from u where not (coalesce(is_cart, false) and contact_id is null and n_lines is null)"""


def dealt_by_order(t):
    """The tables with orders and their lines in buckets of the order, where every side of an order reads them, the day rates as a table whose size is known, so that documents stay where they are,
    and the bids as both funnels need them.

    Lines without order belong to no side of any order."""
    hubs = {"orders": (t["orders"], "o_orderkey"), "lineitem": (t["lineitem"].filter("l_orderkey is not null"), "l_orderkey")}
    dealt = {name: cut_bucketed(df.repartition(key), f"{name}-by-order", key) for name, (df, key) in hubs.items()}
    t = Derived(t, dealt, {"rates": cut_lineage(frames.rates(t), "rates")})
    return Derived(t, dealt, {"rates": t["rates"], "marked_bids": cut_bucketed(marked_bids(sourcing.behaviour(t), ["n_responses"]), "marked-bids", "order_id")})


def order_stages(t):
    return frames.mart_orders(t).select("order_id", "is_closed", "closed_at", F.when(F.col("order_id") % 13 == 0, add_part("created_at", 2, "day")).alias("cancelled_at"))


def quoted(t):
    quotes = frames.documents(t).filter("doc_type = 'quote'").groupBy("order_id").agg(F.max(F.struct("revision", "doc_id", "subtotal_cents")).alias("_q"))
    return quotes.select("order_id", F.col("_q.subtotal_cents").alias("quoted_cents"))


def order_fact_frame(t):
    k = F.col("o_orderkey")
    base = t["orders"].select(
        k.alias("order_id"), F.when(k % 50 != 7, F.col("o_custkey")).alias("contact_id"), F.col("o_orderdate").alias("created_at"),
        F.when((k % 17 == 0) | (k % 50 == 7), "cart").otherwise("final").alias("quote_status"), cents("o_totalprice").alias("subtotal_cents"),
        F.when(k % 13 == 0, k % 5).alias("cancel_code"), (F.col("o_custkey") % 97 == 0).alias("is_internal"),
    )
    # Sides are built where the orders and lines were dealt. Each group is one plan on top of the order ids, and written once, in buckets that the fact joins as they are.
    dealt = dealt_by_order(t)
    ids = dealt["orders"].select(k.alias("order_id")).filter("order_id is not null").distinct()
    builds = {"order-documents": [order_stages, quoted], "order-logistics": [], "order-sourcing": []}
    builds = {group: [*first, *[partial(side, name=name) for name in SIDE_GROUPS[group]]] for group, first in builds.items()}
    sides = cut_all({group: (lambda parts=parts: wide_fact_assembly(ids, "order_id", [build(dealt) for build in parts])) for group, parts in builds.items()}, len(builds), "order_id")
    legacy = frames.legacy_orders(t).select(
        (k + 10_000_000).alias("order_id"), F.col("o_custkey").alias("contact_id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("closed_at"),
        F.lit(True).alias("is_closed"), cents("o_totalprice").alias("closed_cents"), "channel",
    )
    return P.order_fact(base, sides, legacy, CANCELLATIONS)


@register("order_fact", ORDER_FACT)
def order_fact(t):
    return order_fact_frame(t)


PARTNER_COLUMNS = {
    "order": "order_id", "contact": "contact_id", "client": "client_id", "created_at": "created_at", "closed_at": "closed_at", "technology": "technology", "region": "region", "value": "value",
}


@register("partner_share", S.ctes(S.MART_ORDERS, S.CONTACTS) + """
    select order_id as "order", contact_id as contact, coalesce(md5('company' || o.company_id), md5('contact' || contact_id)) as client, o.created_at, closed_at, technology, region, subtotal_cents / 100 as value
    from mart_orders o left join (select contact_id, region from contacts) using (contact_id) where o.created_at >= timestamp '1999-01-01'""")
def partner_share(t):
    people = frames.contacts(t).select("contact_id", "region")
    mart = frames.mart_orders(t).join(people, "contact_id", "left").withColumns({"value": F.col("subtotal_cents") / F.lit(100), "client_id": contacts.P.client_id()})
    return P.partner_share(mart, PARTNER_COLUMNS, "created_at", 2, AS_OF)
