"""Commission queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import register
from millrace.functions.columns import cents
from millrace.functions.dates import add_part
from millrace.plans import commissions as P

BIG = 40_000_000
ROLES = ["outside", "strategic", "inside", "strategic lead", "inside lead", "director"]

RULES = f"""targets as (
  select n_nationkey::bigint as rep_id, ({ROLES!r})[(n_nationkey % 6 + 1)::int] as role, case when n_regionkey = 1 then 'na' else 'row' end as region, (n_nationkey // 6 * 6 + 3)::bigint as lead_id, v.start_date, v.end_date,
         v.m::bigint * 900000000 + n_nationkey::bigint * 10000000 as monthly_target_cents, v.m::bigint * 1200000000 as lead_target_cents, (50 + n_nationkey % 5 * 10)::bigint as monthly_fee_bp,
         (30 + n_nationkey % 3 * 5)::bigint as quarterly_fee_bp, 80::bigint as above_fee_bp, case when v.m = 1 and n_nationkey % 4 = 0 then 150000 else 0 end::bigint as compensation_cents
  from nation cross join (values (1, timestamp '1996-01-01', timestamp '1998-07-01'), (2, timestamp '1998-07-01', timestamp '2001-01-01')) v(m, start_date, end_date)),
rules as (select * exclude (start_date, end_date), unnest(generate_series(start_date, end_date - interval 1 day, interval 1 month)) as month from targets)"""

DEALS = """deals as (
  select o_orderkey as order_id, c_nationkey::bigint as rep_id, case when o_orderkey % 3 = 0 then c_nationkey::bigint end as bdr_id, case when c_custkey % 4 <> 0 then c_custkey // 5 end as company_id,
         case when n_regionkey = 1 then 'na' else 'row' end as region, case when o_orderstatus <> 'O' then o_orderdate + to_days((o_orderkey % 9 + 1)::int) end as closed_at,
         case when o_orderstatus = 'F' then o_orderdate + to_days((o_orderkey % 60 + 10)::int) end as sourced_at, case when o_orderkey % 13 = 0 then o_orderdate + to_days((o_orderkey % 120)::int) end as cancelled_at,
         case when o_orderkey % 5 <> 0 then o_orderdate + to_days((o_orderkey % 50 + 20)::int) end as delivered_at, round(o_totalprice * 100)::bigint as subtotal_cents,
         case when o_orderkey % 7 <> 0 then o_orderkey % 50 * 100 end as shipping_cents, round(o_totalprice * 100)::bigint + o_orderkey % 1000 * 100 as crm_cents, o_orderkey % 37 = 0 as has_gap, c_custkey % 3 = 0 as is_strategic
  from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"""


def targets(t):
    k = F.col("n_nationkey")
    spans = [(1, "1996-01-01", "1998-07-01"), (2, "1998-07-01", "2001-01-01")]
    each = F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(a).cast("timestamp_ntz").alias("start_date"), F.lit(b).cast("timestamp_ntz").alias("end_date")) for m, a, b in spans
    ])
    rows = t["nation"].select("n_nationkey", "n_regionkey", F.inline(each))
    return rows.select(
        k.cast("long").alias("rep_id"), F.get(F.array(*[F.lit(r) for r in ROLES]), k % 6).alias("role"), F.when(F.col("n_regionkey") == 1, "na").otherwise("row").alias("region"),
        (F.floor(k / F.lit(6)) * 6 + 3).alias("lead_id"), "start_date", "end_date", (F.col("m") * 900_000_000 + k * 10_000_000).cast("long").alias("monthly_target_cents"),
        (F.col("m").cast("long") * 1_200_000_000).alias("lead_target_cents"), (k % 5 * 10 + 50).cast("long").alias("monthly_fee_bp"), (k % 3 * 5 + 30).cast("long").alias("quarterly_fee_bp"),
        F.lit(80).cast("long").alias("above_fee_bp"), F.when((F.col("m") == 1) & (k % 4 == 0), 150_000).otherwise(0).cast("long").alias("compensation_cents"),
    )


def deals(t):
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    rows = t["orders"].join(t["customer"], F.col("o_custkey") == c).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    rep = F.col("c_nationkey").cast("long")
    status = F.col("o_orderstatus")
    return rows.select(
        k.alias("order_id"), rep.alias("rep_id"), F.when(k % 3 == 0, rep).alias("bdr_id"), F.when(c % 4 != 0, F.floor(c / F.lit(5))).alias("company_id"),
        F.when(F.col("n_regionkey") == 1, "na").otherwise("row").alias("region"), F.when(status != "O", add_part("o_orderdate", k % 9 + 1, "day")).alias("closed_at"),
        F.when(status == "F", add_part("o_orderdate", k % 60 + 10, "day")).alias("sourced_at"), F.when(k % 13 == 0, add_part("o_orderdate", k % 120, "day")).alias("cancelled_at"),
        F.when(k % 5 != 0, add_part("o_orderdate", k % 50 + 20, "day")).alias("delivered_at"), cents("o_totalprice").alias("subtotal_cents"),
        F.when(k % 7 != 0, k % 50 * 100).alias("shipping_cents"), (cents("o_totalprice") + k % 1000 * 100).alias("crm_cents"), (k % 37 == 0).alias("has_gap"), (c % 3 == 0).alias("is_strategic"),
    )


@register("commission_rules", f"{S.ctes(RULES)} select * from rules")
def commission_rules(t):
    return P.commission_rules(targets(t))


FEE = "((subtotal_cents - coalesce(shipping_cents, 0)) * monthly_fee_bp + 5000) // 10000"
MONTHLY = f"""monthly as (
  with j as (select d.*, r.role, r.monthly_fee_bp, date_trunc('month', closed_at)::timestamp as cm, {FEE} as f, coalesce(bdr_id = d.rep_id, false) and r.role = 'outside' as bdr, coalesce(subtotal_cents - shipping_cents > {BIG}, false) as big,
                    cancelled_at is null as live
             from deals d join rules r on r.rep_id = d.rep_id and r.month = date_trunc('month', closed_at)),
       g as (select d.*, r.role, r.monthly_fee_bp, date_trunc('month', cancelled_at)::timestamp as gm, {FEE} as f, coalesce(bdr_id = d.rep_id, false) and r.role = 'outside' as bdr
             from deals d join rules r on r.rep_id = d.rep_id and r.month = date_trunc('month', cancelled_at)
             where date_trunc('month', closed_at) between date_trunc('month', cancelled_at) - interval 3 month and date_trunc('month', cancelled_at) - interval 1 month),
       w as (select 'owner' as who union all select 'bdr'),
       u as (select order_id, rep_id, cm as month, case who when 'owner' then 'Deal Monthly Base' else 'BDR Monthly Base' end as plan, who,
                    case when who = 'bdr' and closed_at > timestamp '1999-04-01' then ((subtotal_cents - coalesce(shipping_cents, 0)) * monthly_fee_bp * 2 + 5000) // 10000 else f end as cents
             from j, w where (who = 'owner' or bdr) and (live or date_trunc('month', cancelled_at) <> cm)
             union all select order_id, rep_id, cm, 'Big Deals Excluded', who, -f from j, w where (who = 'owner' or bdr) and live and big and (sourced_at is null or date_trunc('month', sourced_at) > cm)
             union all select order_id, rep_id, cm, 'Significant Amount Gap Deals Excluded', who, -f from j, w where (who = 'owner' or bdr) and live and has_gap
             union all select order_id, rep_id, date_trunc('month', sourced_at)::timestamp, 'Big Deals Commission', who, f from j, w where (who = 'owner' or bdr) and big and closed_at < date_trunc('month', sourced_at)
             union all select order_id, rep_id, date_trunc('month', delivered_at)::timestamp, 'Significant Amount Gap Deals Commission', who, (crm_cents * monthly_fee_bp + 5000) // 10000 from j, w where (who = 'owner' or bdr) and live and has_gap
             union all select order_id, rep_id, gm, 'Cancellations Deduction', who, -f from g, w where who = 'owner' or bdr
             union all select null, rep_id, month, 'Ramping Compensation', 'owner', compensation_cents from rules
             union all select null, r.rep_id, r.month, 'BDR Handover fee', 'bdr', sum(case when handover_at < timestamp '1999-04-01' then 35000 when out then 40000 else 20000 end)::bigint
               from (select c_nationkey as rep, timestamp '1996-06-01' + to_days((c_custkey * 11 % 1500)::int) as handover_at, c_custkey % 2 = 0 as out from customer where c_custkey % 9 <> 0) h
               join rules r on r.rep_id = h.rep and r.month = date_trunc('month', handover_at) where r.role = 'outside' group by 2, 3),
       k as (select * from u where month is not null and cents is not null)
  select order_id, rep_id, month, plan, who, cents from k
  union all select order_id, rep_id, month, 'Deal Monthly Total', 'total', sum(cents)::bigint from k group by 1, 2, 3)"""


def monthly(t):
    k = F.col("c_custkey")
    companies = t["customer"].select(
        F.col("c_nationkey").cast("long").alias("handover_rep_id"), add_part(F.lit("1996-06-01").cast("timestamp_ntz"), k * 11 % 1500, "day").alias("handover_at"),
        (k % 2 == 0).alias("true_outbound"), F.when(k % 9 != 0, k).alias("owner_id"),
    )
    return P.commission_monthly(deals(t), P.commission_rules(targets(t)), companies, BIG, "1999-04-01", "1999-04-01")


@register("commission_monthly", f"{S.ctes(RULES, DEALS, MONTHLY)} select * from monthly")
def commission_monthly(t):
    return monthly(t)


SCALE_SQL = ", ".join(f"({step}, {bonus}::double)" for step, bonus in P.BONUS_SCALE)
STEP = "least(floor(closed_cents * 20 / nullif(target_cents, 0) + 0.5), 30)::bigint"

QUARTERLY = f"""quarterly as (
  with scale as (select * from (values {SCALE_SQL}) v(step, bonus)),
       live as (select *, date_trunc('quarter', closed_at)::timestamp as q, date_trunc('month', closed_at) as m, subtotal_cents - coalesce(shipping_cents, 0) as amount from deals where cancelled_at is null and closed_at is not null),
       rg as (select region, q, sum(amount)::bigint as closed_cents from live group by 1, 2),
       rq as (select *, date_trunc('quarter', month)::timestamp as q from rules),
       dt as (select q, region, rep_id, sum(monthly_target_cents)::bigint as target_cents from rq where role = 'director' group by 1, 2, 3),
       mg as (select l.*, r.role as rrole, r.lead_id from live l join rules r on r.rep_id = l.rep_id and r.month = m),
       ld as (select lead_id, q, sum(amount)::bigint as closed_cents from mg group by 1, 2),
       lt as (select q, rep_id, role, sum(lead_target_cents)::bigint as target_cents from rq where role in ('strategic lead', 'inside lead') group by 1, 2, 3),
       b as (select dt.q, dt.rep_id, 'Quarterly Director' as plan, closed_cents, target_cents, 2000000 as base from dt join rg on rg.region = dt.region and rg.q = dt.q
             union all select lt.q, lt.rep_id, 'Quarterly Leads', closed_cents, target_cents, case role when 'inside lead' then 400000 else 750000 end from lt join ld on ld.lead_id = lt.rep_id and ld.q = lt.q),
       ow as (select g.*, case when rrole = 'inside' then h.owner_id else rep_id end as seller from mg g left join (
                select distinct c_custkey // 5 as company_id, v.f as valid_from, v.t as valid_to, (c_custkey // 5 + v.i) % 25 as owner_id from customer cross join (values (1, timestamp '1995-01-01', timestamp '1998-01-01'), (2, timestamp '1998-01-01', null)) v(i, f, t)) h
              on h.company_id = g.company_id and closed_at >= valid_from and (valid_to is null or closed_at < valid_to)),
       sd as (select seller, q, sum(case when is_strategic then amount else 0 end)::bigint as strategic_cents, sum(amount)::bigint as closed_cents from ow group by 1, 2),
       st as (select q, rep_id, quarterly_fee_bp, above_fee_bp, sum(monthly_target_cents)::bigint as target_cents from rq where role in ('strategic', 'strategic lead') group by 1, 2, 3, 4),
       sj as (select st.*, strategic_cents, closed_cents, closed_cents * 4 > target_cents * 3 as paid from st join sd on sd.seller = st.rep_id and sd.q = st.q),
       u as (select q + interval 2 month as month, rep_id, plan, closed_cents, target_cents, {STEP} * 5 as percent_of_target,
                    case when closed_cents * 4 > target_cents * 3 then floor(base * bonus + 0.5)::bigint end as cents from b left join scale on step = {STEP}
             union all select q + interval 2 month, rep_id, 'Quarterly Strategic', closed_cents, target_cents, null, case when paid then (strategic_cents * quarterly_fee_bp + 5000) // 10000 end from sj
             union all select q + interval 2 month, rep_id, 'Quarterly Overperformance', closed_cents, target_cents, null,
                              case when paid and strategic_cents > target_cents then ((strategic_cents - target_cents) * above_fee_bp + 5000) // 10000 end from sj)
  select * from u where cents is not null)"""


def quarterly(t):
    company = F.floor(F.col("c_custkey") / F.lit(5))
    spans = [(1, "1995-01-01", "1998-01-01"), (2, "1998-01-01", None)]
    each = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(a).cast("timestamp_ntz").alias("valid_from"), F.lit(b).cast("timestamp_ntz").alias("valid_to")) for i, a, b in spans
    ])
    owners = t["customer"].select(company.alias("company_id"), F.inline(each)).distinct()
    owners = owners.select("company_id", "valid_from", "valid_to", ((F.col("company_id") + F.col("i")) % 25).alias("owner_id"))
    return P.commission_quarterly(deals(t), P.commission_rules(targets(t)), owners, [("director", "Quarterly Director", 2_000_000)])


@register("commission_quarterly", f"{S.ctes(RULES, DEALS, QUARTERLY)} select * from quarterly")
def commission_quarterly(t):
    return quarterly(t)


@register("commission_total", f"""{S.ctes(RULES, DEALS, MONTHLY, QUARTERLY)}
    select month, rep_id, plan, sum(cents)::bigint as cents from (select month, rep_id, plan, cents from monthly where who <> 'total' union all select month, rep_id, plan, cents from quarterly) where cents <> 0 group by 1, 2, 3""")
def commission_total(t):
    return P.commission_total(monthly(t), quarterly(t))


@register("onboarding_bonus", """
    with a as (select n_nationkey as agent_id, case when n_nationkey % 4 = 0 then timestamp '1998-05-01' end as end_at, unnest([n_nationkey, n_nationkey + 25, n_nationkey + 50, n_nationkey + 5000]) as supplier_id from nation),
         k as (select a.agent_id, a.end_at, a.supplier_id::bigint as supplier_id, date_trunc('quarter', timestamp '1997-01-01' + to_days((s_suppkey * 17 % 700)::int))::timestamp as bonus_from from a left join supplier on s_suppkey = a.supplier_id),
         w as (select *, bonus_from + interval 12 month - interval 1 day as bonus_until from k),
         r as (select supplier_id, quarter, sum(cents)::bigint as revenue_cents from (
                 select l_suppkey as supplier_id, date_trunc('quarter', l_shipdate)::timestamp as quarter, round(l_extendedprice * 100)::bigint as cents
                 from lineitem join (select distinct supplier_id, bonus_from, bonus_until from w) d on d.supplier_id = l_suppkey where l_shipdate between bonus_from and bonus_until and l_returnflag = 'N' and l_linestatus = 'O' and l_linenumber = 1
                 union all select distinct supplier_id, bonus_from, 0 from w) group by 1, 2),
         j as (select w.*, quarter, revenue_cents, coalesce(quarter < bonus_until, false) as ok from w left join r on r.supplier_id = w.supplier_id),
         x as (select *, case when bonus_from = quarter then 5000 else 0 end as ob,
                      case when ok then case when quarter >= timestamp '1998-01-01' then case when revenue_cents > 3000000 then 60000 when revenue_cents > 2000000 then 30000 when revenue_cents > 1000000 then 20000 when revenue_cents > 500000 then 10000 else 0 end
                           else case when revenue_cents >= 6000000 then 20000 when revenue_cents >= 3000000 then 10000 else 0 end end else 0 end as eb from j)
    select agent_id::bigint as agent_id, supplier_id, quarter, revenue_cents, bonus_from, bonus_until, ok as is_eligible, ob::bigint as onboarding_cents, eb::bigint as engagement_cents,
           case when ok and coalesce(end_at is null or date_trunc('quarter', end_at) > quarter, false) then ob + eb else 0 end::bigint as payable_cents, case when ok then ob + 60000 else 0 end::bigint as potential_cents from x""")
def onboarding_bonus(t):
    k = F.col("n_nationkey")
    agents = t["nation"].select(
        k.alias("agent_id"), F.lit("1997-01-01").cast("timestamp_ntz").alias("start_at"), F.when(k % 4 == 0, F.lit("1998-05-01").cast("timestamp_ntz")).alias("end_at"),
        F.concat_ws(",", *[(k + n).cast("string") for n in (0, 25, 50, 5000)]).alias("suppliers"),
    )
    s = F.col("s_suppkey")
    suppliers = t["supplier"].select(s.alias("supplier_id"), add_part(F.lit("1997-01-01").cast("timestamp_ntz"), s * 17 % 700, "day").alias("created_at"))
    orders = t["lineitem"].filter("l_returnflag = 'N' and l_linestatus = 'O' and l_linenumber = 1").select(
        F.col("l_suppkey").alias("supplier_id"), F.col("l_shipdate").alias("sourced_at"), cents("l_extendedprice").alias("cents")
    )
    return P.onboarding_bonus(agents, suppliers, orders, "1998-01-01")
