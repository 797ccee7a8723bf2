"""Supplier, auction and bid queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import register
from millrace.functions.columns import cents
from millrace.plans import sourcing as P
from millrace.sources import frames

BEHAVIOUR = """behaviour as (
  with c as (select b.*, winning_bid_id, auction_type, amount_cents, coalesce(bid_id = winning_bid_id, false) as is_winning
             from (select * from (select *, row_number() over (partition by auction_id, supplier_id order by not is_active, placed_at desc nulls last, bid_id) as idx from bids) where idx = 1) b
             join (select auction_id, winning_bid_id, auction_type, amount_cents from auctions) a using (auction_id)),
       r as (select *, row_number() over (partition by auction_id order by assigned_at, bid_id) as assigned_rank,
                    rank() over (partition by order_id, supplier_id order by not is_winning, coalesce(response_type, '~'), coalesce(placed_at, timestamp '1970-01-01') desc) as wr,
                    bool_or(is_winning) over (partition by auction_id) as won, max(case when is_winning then bid_cents end) over (partition by auction_id) as w_cents,
                    max(case when is_winning then lead_time end) over (partition by auction_id) as w_lead,
                    count(*) filter (where response_type = 'countered') over (partition by auction_id) as n_counter from c)
  select bid_id, auction_id, order_id, supplier_id, auction_type, is_rfq, assigned_at, seen_at, placed_at, response_type, assigned_rank, is_winning,
         case when wr = 1 and is_winning then 1 when wr = 1 and response_type = 'countered' then 0 end::bigint as win_rate,
         case when won then bid_cents / nullif(w_cents, 0) end as share_of_winning_bid, case when won then lead_time / nullif(w_lead, 0) end as share_of_winning_lead_time,
         case when won then n_counter end as n_counter_bids, amount_cents * margin_pct / 100 as margin_cents, bid_cents from r)"""


def behaviour(t):
    """Bids against their auctions; a job that has written their marks gives them as a table."""
    if (marked := t.get("marked_bids")) is not None:
        return marked
    return P.bid_behaviour(frames.bids(t), frames.auctions(t))


@register("auction_history", S.ctes(S.AUCTIONS) + """
    , w as (select order_id, arg_min(auction_id, (started_at, auction_id)) as f, arg_max(auction_id, (finished_at, auction_id)) as l from auctions where winning_bid_id is not null group by 1),
      r as (select a.*, row_number() over (partition by order_id order by started_at desc, auction_id) as recency_idx,
                   row_number() over (partition by order_id, auction_type order by started_at desc, auction_id) as recency_idx_type from auctions a)
    select r.*, coalesce(f = auction_id, false) as is_first_successful, coalesce(l = auction_id, false) as is_last_successful, recency_idx_type = 1 as is_latest_of_type,
           auction_type = 'RDA' and recency_idx_type = 1 and coalesce(l = auction_id, false) as is_sourced_by_auction from r left join w using (order_id)""")
def auction_history(t):
    return P.auction_history(frames.auctions(t))


@register("auctions_per_order", S.ctes(S.AUCTIONS) + """
    select order_id, arg_max(auction_type, (started_at, auction_id)) filter (where winning_bid_id is not null) as last_winning_type, bool_or(winning_bid_id is not null) as has_winning_bid,
           count(distinct auction_id) as n_auctions from auctions group by 1""")
def auctions_per_order(t):
    return P.auctions_per_order(frames.auctions(t))


@register("bid_behaviour", f"{S.ctes(S.AUCTIONS, BEHAVIOUR)} select * from behaviour")
def bid_behaviour(t):
    return behaviour(t)


@register("auction_funnel", f"""{S.ctes(S.AUCTIONS, BEHAVIOUR)}
    , g as (select order_id, count(distinct auction_id) as n_auctions, count(*) as n_assigned, count(distinct case when seen_at is not null then bid_id end) as n_seen,
           count(distinct case when placed_at is not null then bid_id end) as n_responses, count(distinct case when response_type in ('accepted', 'countered') then bid_id end) as n_positive,
           count(distinct case when response_type = 'countered' then bid_id end) as n_countered, count(distinct case when response_type = 'rejected' then bid_id end) as n_rejected,
           bool_or(is_winning) as has_winning_bid, bool_or(is_winning and coalesce(response_type = 'accepted', false)) as has_accepted_winning_bid from behaviour where not is_rfq group by 1),
      w as (select *, row_number() over (partition by order_id order by assigned_at, supplier_id, margin_cents) as a, row_number() over (partition by order_id order by assigned_at desc, supplier_id desc, margin_cents desc) as z
            from behaviour where not is_rfq and is_winning)
    select g.*, l.supplier_id, l.margin_cents as winning_margin_cents, f.margin_cents as first_winning_margin_cents from g
    left join w l on l.order_id = g.order_id and l.z = 1 left join w f on f.order_id = g.order_id and f.a = 1""")
def auction_funnel(t):
    return P.auction_funnel(behaviour(t))


@register("rfq_funnel", f"""{S.ctes(S.AUCTIONS, BEHAVIOUR)}
    select order_id, bool_or(is_winning) as is_sourced_by_rfq, count(distinct supplier_id) as n_suppliers_asked, count(distinct case when placed_at is not null then supplier_id end) as n_suppliers_answered,
           count(distinct auction_id) as n_rfqs, count(*) as n_requests, count(placed_at) as n_answers from behaviour where is_rfq group by 1""")
def rfq_funnel(t):
    return P.rfq_funnel(behaviour(t))


@register("supplier_capabilities", """
    with b as (select l_suppkey as supplier_id, l_partkey % 4 as technology_id, p_type, p_size % 4 as material, p_size % 3 as process from lineitem join part on p_partkey = l_partkey),
         st as (select distinct supplier_id, technology_id from b union select s_suppkey, 9 from supplier), f as (select distinct supplier_id, technology_id, p_type as finish from b where p_type <> 'PROMO'),
         m as (select distinct supplier_id, technology_id, 'material ' || material as material, material % 3 as material_process from b),
         p as (select distinct supplier_id, technology_id, process from b where technology_id <> 1)
    select supplier_id, technology_id, finish, material, process::bigint as process from st left join f using (supplier_id, technology_id) left join m using (supplier_id, technology_id)
      left join p using (supplier_id, technology_id) where technology_id <> 2
    union all
    select supplier_id, technology_id, finish, material, q.process from (select * from st where technology_id = 2) left join f using (supplier_id, technology_id) left join m using (supplier_id, technology_id)
      left join (select distinct supplier_id, process from p) q using (supplier_id) where q.process = material_process""")
def supplier_capabilities(t):
    size = F.col("p_size")
    base = t["lineitem"].select("l_suppkey", "l_partkey").join(t["part"], F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("supplier_id"), (F.col("l_partkey") % 4).alias("technology_id"), "p_type", (size % 4).alias("m"), (size % 3).alias("process_id")
    )
    k = ["supplier_id", "technology_id"]
    technologies = base.select(*k).union(t["supplier"].select("s_suppkey", F.lit(9).cast("long"))).distinct()
    finishes = base.filter("p_type <> 'PROMO'").select(*k, F.col("p_type").alias("finish")).distinct()
    materials = base.select(*k, F.concat(F.lit("material "), F.col("m").cast("string")).alias("material"), (F.col("m") % 3).alias("material_process")).distinct()
    processes = base.filter("technology_id <> 1").select(*k, "process_id").distinct()
    return P.supplier_capabilities(technologies, finishes, materials, processes, 2)


@register("supplier_capacity", S.ctes(S.MILESTONES, S.BIDS) + """
    , w as (select o_orderkey % 50 as supplier_id, greatest(created_at, timestamp '1998-09-01') as a, shipped_at as b, round(o_totalprice * 100)::bigint as cents, promised_at, shipped_at
            from milestones where cancelled_at is null),
      d as (select supplier_id, cents, unnest(generate_series(a, b - interval 1 day, interval 1 day)) as date from w where b > timestamp '1998-09-01')
    select supplier_id, date, count(*) as in_progress, sum(cents)::bigint as load_cents, null::bigint as seen, null::bigint as positive, null::bigint as assigned, null::bigint as on_time, null::bigint as late from d group by 1, 2
    union all select supplier_id, assigned_at, null, null, count(seen_at), count(*) filter (where response_type in ('accepted', 'countered')), count(*), null, null from bids where assigned_at >= timestamp '1998-09-01' group by 1, 2
    union all select supplier_id, promised_at, null, null, null, null, null, count(*) filter (where shipped_at <= promised_at), count(*) filter (where shipped_at > promised_at) from w where promised_at >= timestamp '1998-09-01' group by 1, 2""")
def supplier_capacity(t):
    work = frames.milestones(t).filter("cancelled_at is null").select(
        (F.col("o_orderkey") % 50).alias("supplier_id"), F.col("created_at").alias("start_at"), F.col("shipped_at").alias("end_at"), cents("o_totalprice").alias("cents"),
        "promised_at", (F.col("shipped_at") <= F.col("promised_at")).alias("is_on_time"),
    )
    return P.supplier_capacity(work, frames.bids(t), work, "1998-09-01")
