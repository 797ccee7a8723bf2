"""Customer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, register
from millrace.functions.columns import cents
from millrace.functions.dates import add_part
from millrace.plans import customers as P
from millrace.sources import frames

COHORT_AS_OF = "1997-03-15 00:00:00"


def entity_sql(k):
    return f"""
      select {k}, min(created_at) as became_created_at, min(submitted_at) as became_opportunity_at, min(closed_at) as became_customer_at,
             max(created_at) as recent_created_at, max(closed_at) as recent_closed_at, count(*) as n_orders, count(submitted_at) as n_submitted,
             count(*) filter (where is_closed) as n_closed, nullif(sum(subtotal_cents) filter (where is_closed), 0)::bigint as closed_sales_cents,
             arg_min(technology, (submitted_at, order_id)) filter (where submitted_at is not null) as first_submitted_technology,
             arg_min(technology, (closed_at, order_id)) filter (where is_closed) as first_closed_technology,
             (list(closed_at order by closed_at) filter (where is_closed))[2] as second_closed_at,
             sum(subtotal_cents) filter (where date_trunc('month', closed_at) = date_trunc('month', became))::bigint as closed_sales_new_cents,
             sum(subtotal_cents - cost_cents) filter (where closed_at < became + interval 90 day)::bigint as margin_90d_cents,
             sum(subtotal_cents - cost_cents) filter (where closed_at < became + interval 24 month)::bigint as margin_24m_cents
      from (select *, min(closed_at) over (partition by {k}) as became from mart_orders where {k} is not null) group by 1"""


FIELDS = """became_created_at became_opportunity_at became_customer_at recent_created_at recent_closed_at n_orders n_submitted n_closed
closed_sales_cents first_submitted_technology first_closed_technology second_closed_at closed_sales_new_cents margin_90d_cents margin_24m_cents""".split()


def numbers_sql(k):
    return f"""
      select order_id, rank() over w as closed_number, dense_rank() over (partition by {k} order by closed_at::date) as project_number,
             lag(closed_at) over (partition by {k} order by closed_at, order_id) as previous_closed_at,
             date_diff('day', lag(closed_at) over (partition by {k} order by closed_at, order_id), closed_at) as days_since_previous
      from mart_orders where is_closed and {k} is not null window w as (partition by {k} order by closed_at)"""


def _pick(alias, names, suffix):
    return ", ".join(f"{alias}.{n} as {n}_{suffix}" for n in names)


def _same_month(first, at):
    return f"coalesce(date_diff('month', {first}, {at}) = 0, false)"


NUMBERS = ["closed_number", "project_number", "previous_closed_at", "days_since_previous"]

LIFECYCLE_SQL = f"""{S.ctes(S.MART_ORDERS)},
  o as (select *, coalesce(md5('company' || company_id), md5('contact' || contact_id)) as client_id from mart_orders),
  a as ({entity_sql('contact_id')}), b as ({entity_sql('company_id')}), na as ({numbers_sql('contact_id')}), nb as ({numbers_sql('company_id')}),
  cl as (select client_id, min(created_at) as became_created_at_client, min(closed_at) as became_customer_at_client from o group by 1)
select o.order_id, o.contact_id, o.company_id, o.client_id, {_pick('a', FIELDS, 'contact')}, {_pick('b', FIELDS, 'company')},
       {_pick('na', NUMBERS, 'contact')}, {_pick('nb', NUMBERS, 'company')}, became_created_at_client, became_customer_at_client,
       {_same_month('a.became_created_at', 'created_at')} as created_order_is_from_new_contact,
       {_same_month('b.became_created_at', 'created_at')} as created_order_is_from_new_company,
       {_same_month('became_created_at_client', 'created_at')} as created_order_is_from_new_client,
       {_same_month('a.became_customer_at', 'closed_at')} as closed_order_is_from_new_contact,
       {_same_month('b.became_customer_at', 'closed_at')} as closed_order_is_from_new_company,
       {_same_month('became_customer_at_client', 'closed_at')} as closed_order_is_from_new_client
from o left join a on a.contact_id = o.contact_id left join b on b.company_id = o.company_id left join cl on cl.client_id = o.client_id
left join na on na.order_id = o.order_id left join nb on nb.order_id = o.order_id"""


@register("customer_lifecycle", LIFECYCLE_SQL)
def customer_lifecycle(t):
    return P.customer_lifecycle(frames.mart_orders(t))


@register("order_series", S.ctes(S.MART_ORDERS) + """
    , p as (select *, min(closed_at) over (partition by company_id) as t1 from mart_orders where company_id is not null),
      q as (select *, min(case when created_at > t1 + interval 7 day then created_at end) over (partition by company_id) as c2 from p),
      r as (select *, min(case when closed_at > c2 then closed_at end) over (partition by company_id) as d2 from q),
      s as (select *, min(case when created_at > d2 + interval 7 day then created_at end) over (partition by company_id) as c3 from r),
      u as (select *, min(case when closed_at > c3 then closed_at end) over (partition by company_id) as d3 from s)
    select distinct company_id, t1 as first_closed_at, c2 as series_two_created_at, d2 as series_two_closed_at, c3 as series_three_created_at, d3 as series_three_closed_at from u""")
def order_series(t):
    return P.order_series(frames.mart_orders(t), "company_id")


@register("rfm_segments", S.ctes(S.MART_ORDERS) + """
    , c as (select * from mart_orders where is_closed),
      aov as (select sum(subtotal_cents)::bigint / count(*) as aov from c where closed_at >= timestamp '2000-09-01' and subtotal_cents <> 0),
      b as (select contact_id, date_diff('day', max(closed_at), timestamp '2001-09-01') as recency, count(distinct closed_at::date) as frequency,
                   sum(subtotal_cents)::bigint / count(*) as monetary from c group by 1),
      s as (select *, case when recency <= 90 then 4 when recency <= 180 then 3 when recency <= 365 then 2 else 1 end::bigint as r_score,
                   least(frequency, 4)::bigint as f_score,
                   case when monetary >= aov * 2 then 4 when monetary >= aov then 3 when monetary >= aov / 2 then 2 else 1 end::bigint as m_score from b, aov)
    select contact_id, aov, recency, frequency, monetary, r_score, f_score, m_score,
           case when r_score > 2 and f_score > 2 and m_score > 2 then '1 Core Value' when r_score > 2 and f_score > 2 then '4 Small Regular'
                when r_score > 2 and m_score > 2 then '2 Core Development' when r_score > 2 then '6 Basic Development'
                when f_score > 2 and m_score > 2 then '3 Core Maintenance' when f_score > 2 then '7 Basic Maintenance'
                when m_score > 2 then '5 Core Churn' else '8 Low Value Churn' end as rfm_segment
    from s""")
def rfm_segments(t):
    return P.rfm_segments(frames.mart_orders(t), "contact_id", AS_OF)


@register("potential_tier", """
    with s as (select c_custkey as company_id, timestamp '2001-01-01' + to_months((c_custkey % 3)::int) as snapshot_at, round(c_acctbal * 100)::bigint as score from customer
               union all select c_custkey, timestamp '2001-02-01', round(c_acctbal * 50)::bigint from customer where c_custkey % 2 = 0),
         p as (select snapshot_at, quantile_cont(score, 0.8) as p80, quantile_cont(score, 0.6) as p60 from s group by 1)
    select company_id, snapshot_at, score, tier from (
      select company_id, s.snapshot_at, score, case when score > p80 then 'high' when score > p60 then 'medium' else 'low' end as tier,
             row_number() over (partition by company_id order by s.snapshot_at, score) as rn from s join p using (snapshot_at)) where rn = 1""")
def potential_tier(t):
    base = t["customer"].select(
        F.col("c_custkey").alias("company_id"),
        add_part(F.lit("2001-01-01").cast("timestamp_ntz"), F.col("c_custkey") % 3, "month").alias("snapshot_at"), cents("c_acctbal").alias("score"),
    )
    again = t["customer"].filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("company_id"), F.lit("2001-02-01").cast("timestamp_ntz").alias("snapshot_at"),
        F.round(F.col("c_acctbal") * 50).cast("long").alias("score"),
    )
    return P.potential_tier(base.unionByName(again), "company_id", "snapshot_at", "score")


@register("retention_episodes", S.ctes(S.MART_ORDERS) + """
    , r as (select contact_id, closed_at, order_id, lag(closed_at) over w as before, lead(closed_at) over w as after_ from mart_orders where is_closed
            window w as (partition by contact_id order by closed_at, order_id)),
      p as (select *, case when date_diff('day', closed_at, coalesce(after_, timestamp '2001-09-01')) > 365 then closed_at + interval 365 day end as own,
                   coalesce(date_diff('day', before, closed_at) > 365, false) as reactivated, before is null as is_first from r),
      f as (select *, lead(own) over (partition by contact_id order by closed_at, order_id) as nxt from p where own is not null or reactivated or is_first)
    select contact_id, case when is_first then closed_at end as activated_at, reactivated, case when reactivated then closed_at end as reactivated_at,
           coalesce(own, nxt) as churned_at, coalesce(own, nxt) is not null as churned,
           row_number() over (partition by contact_id order by closed_at desc, order_id desc) = 1 as is_latest,
           row_number() over (partition by contact_id order by closed_at, order_id) as activation_count
    from f where reactivated or is_first""")
def retention_episodes(t):
    return P.retention_episodes(frames.mart_orders(t), "contact_id", AS_OF)


SINCE_SQL = """since as (
  select contact_id, became_customer_at, technology, region, company_id, channel_type from
    (select contact_id, min(closed_at) as became_customer_at, arg_min(technology, (closed_at, order_id)) as technology from mart_orders where is_closed group by 1)
    join contacts using (contact_id))"""

CLV_SQL = f"""{SINCE_SQL},
  recent as (select * from since where channel_type <> 'outbound' and date_trunc('month', became_customer_at) >= timestamp '1994-09-01'
             and date_trunc('month', became_customer_at) < timestamp '1997-03-01'),
  sizes as (select technology, region, date_diff('month', became_customer_at, timestamp '1997-03-15') - 1 as cohort, count(*) as contacts from recent group by 1, 2, 3),
  run as (select *, sum(contacts) over (partition by technology, region order by cohort desc rows between 5 preceding and current row)::bigint as running_contacts from sizes),
  sales as (select r.technology, r.region, date_diff('month', became_customer_at, sourced_at) as cohort, count(distinct contact_id) as active,
                   sum(subtotal_cents - cost_cents)::bigint as margin_cents
            from mart_orders join recent r using (contact_id)
            where is_sourced and date_diff('month', sourced_at, timestamp '1997-03-15') > 0
              and date_trunc('month', became_customer_at) >= timestamp '1997-03-01' - to_months((6 + date_diff('month', became_customer_at, sourced_at))::int)
            group by 1, 2, 3),
  v as (select run.technology, run.region, run.cohort, running_contacts, margin_cents, margin_cents / active as sales_per_contact, active / running_contacts as retention
        from run left join sales s on s.technology = run.technology and s.region = run.region and s.cohort = run.cohort),
  clv as (select technology, region, cohort, running_contacts, margin_cents, sales_per_contact, retention, round(retention * sales_per_contact, 2) as clv,
                 round(sum(retention * sales_per_contact * 0.93::double) over (partition by technology, region order by cohort desc rows between 23 preceding and current row), 2) as clv_24m
          from v)"""


@register("cohort_clv", S.ctes(S.MART_ORDERS, S.CONTACTS, CLV_SQL) + " select * from clv")
def cohort_clv(t):
    return P.cohort_clv(frames.mart_orders(t), frames.contacts(t), COHORT_AS_OF)


TYPED_SQL = """typed as (
  select contact_id, lead_at, case when company_id is null then 'freemailer' when lead_number > 1 then 'inside_company_customer' else 'first_company_customer' end as contact_type
  from contacts left join (select contact_id, row_number() over (partition by company_id order by lead_at, contact_id) as lead_number
                           from contacts where lead_at is not null and company_id is not null) using (contact_id))"""


@register("cohort_clv_90d", S.ctes(S.MART_ORDERS, S.CONTACTS, SINCE_SQL, TYPED_SQL) + """
    , lim as (select timestamp '1997-03-15' - interval 90 day as l)
    select contact_type, s.technology, region, count(distinct contact_id) as cohort_size, sum(subtotal_cents - cost_cents)::bigint as margin_cents,
           sum(subtotal_cents - cost_cents)::bigint / count(distinct contact_id) * 0.93::double as clv_90d
    from mart_orders o join since s using (contact_id) join typed using (contact_id), lim
    where became_customer_at > l - interval 24 month and became_customer_at < l and sourced_at < became_customer_at + interval 90 day
    group by 1, 2, 3""")
def cohort_clv_90d(t):
    return P.cohort_clv_90d(frames.mart_orders(t), frames.contacts(t), COHORT_AS_OF)


@register("lead_bid_price", S.ctes(S.MART_ORDERS, S.CONTACTS, CLV_SQL, TYPED_SQL) + """
    , tech as (select contact_id, arg_min(technology, (created_at, order_id)) as tech from mart_orders group by 1),
      l as (select t.contact_id, contact_type, region, case when tech = 'IM' then 'CNC' else coalesce(tech, '3DP') end as technology,
                   case when contact_id % 3 <> 0 then (contact_id % 97) / 97 * 0.81::double else 0.0001::double end as conversion
            from typed t join contacts using (contact_id) left join tech using (contact_id) where t.lead_at is not null)
    select contact_id, l.technology, l.region, contact_type, clv_24m, conversion,
           round(conversion * clv_24m * case when l.region = 'AMERICA' and contact_type = 'first_company_customer' then 2.5::double
             when contact_type = 'first_company_customer' then 1.6::double else 0.67::double end, 4) as bid_cents
    from l left join clv v on v.technology = l.technology and v.region = l.region and v.cohort = 1""")
def lead_bid_price(t):
    scores = t["customer"].filter("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("contact_id"), (F.col("c_custkey") % 97 / F.lit(97)).alias("predicted"), F.lit("1997-01-01").alias("scored_at")
    )
    return P.lead_bid_price(frames.contacts(t), frames.mart_orders(t), scores, COHORT_AS_OF)
