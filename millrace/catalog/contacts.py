"""Contact, company and client queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.customers import entity_sql
from millrace.catalog.registry import AS_OF, register
from millrace.functions.dates import add_part
from millrace.plans import contacts as P
from millrace.plans import customers as K
from millrace.sources import frames
from millrace.sources.session import cut_lineage

TRACKING = {"home": "1994-09-01", "abroad": "1994-11-01", "first_party": "1996-01-05", "landing": "1996-03-25"}

MERGED = f"""merged as (
  with k as (select *, coalesce(nullif(token, ''), contact_id::varchar) as person from web_contacts),
       f as (select * from (select person, lower(source) as source, source_data_1 as d1, source_data_2 as d2, split_part(first_url, '#', 1) as url, first_visit_at as visit,
               row_number() over (partition by person order by least(first_visit_at, created_at), contact_id) as rn from k) where rn = 1)
  select contact_id, company_id, country, created_at, f.source, d1 as source_data_1, d2 as source_data_2, url as first_url, {S.page('url')} as first_page, visit as first_visit_at,
         case when (coalesce(contains(f.source, 'offline'), false) and coalesce(contains(lower(d1), 'import'), false) and created_at > timestamp '1994-11-18')
                or (coalesce(lower(d1) = 'integration', false) and coalesce(d2 = 'list-1', false)) then 'outbound' else 'inbound' end as channel_type
  from k join f using (person))"""

CHANNELS = """channels as (
  with g as (select m.*, coalesce(page_group, 'Ungrouped') as grp, date_diff('second', first_visit_at, created_at) as wait from merged m left join page_groups on page = lower(first_page)),
       c as (select *, case when channel_type = 'outbound' then 'outbound'
               when coalesce(country <> 'NATION_1', true) and created_at < timestamp '1994-11-01' then 'unknown_channel_old_row'
               when country = 'NATION_1' and created_at < timestamp '1994-09-01' then 'unknown_channel_old_home'
               when wait < 10 and created_at < timestamp '1996-01-05' then 'unknown_channel_no_web_session'
               when wait < 0 and created_at >= timestamp '1996-01-05' then 'unknown_channel_no_web_session'
               when source = 'offline' and lower(source_data_1) in ('analytics', 'api', 'conversations') then 'unknown_channel_no_web_session'
               when contains(first_url, 'utm_source=youtube') then 'youtube' when contains(first_url, 'utm_medium=display') then 'display'
               when source = 'organic_search' and grp = 'Homepage' then 'branded_organic_search'
               when source = 'direct_traffic' and contains(first_url, '/manufacture') and created_at <= timestamp '1996-03-25' then 'unknown_channel'
               when source is null then 'unknown_channel' else source end as channel from g)
  select contact_id, company_id, created_at, channel_type, channel,
         case when channel like 'unknown_channel%' then 'unknown' when channel in ('social_media', 'referrals', 'other_campaigns', 'email_marketing') then 'other'
              when channel in ('branded_organic_search', 'direct_traffic') then 'direct/brand' else channel end as channel_grouped,
         case when channel not like 'unknown_channel%' then grp end as first_page_grouped, case when channel not like 'unknown_channel%' then first_page end as first_page_seen,
         case when channel not like 'unknown_channel%' and contains(first_url, '?') then split_part(first_url, '?', 2) end as first_page_query,
         case when channel not like 'unknown_channel%' then source_data_1 end as drilldown_1, case when channel not like 'unknown_channel%' then source_data_2 end as drilldown_2
  from c)"""


def merged(t):
    return P.identity_merge(frames.web_contacts(t), "1994-11-18", "list-1")


def channels(t):
    return P.channel_attribution(merged(t), frames.page_groups(t), "NATION_1", TRACKING)


@register("identity_merge", f"{S.ctes(S.WEB_CONTACTS, MERGED)} select * from merged")
def identity_merge(t):
    return merged(t)


@register("channel_attribution", f"{S.ctes(S.WEB_CONTACTS, MERGED, S.PAGE_GROUPS, CHANNELS)} select * from channels")
def channel_attribution(t):
    return channels(t)


@register("landing_page_attribution", f"""
    with p as (select *, split_part({S.page('url')}, '/', 2) as first from pages)
    select case when lower(first) in ('js', 's3') then 'en' when length(first) = 2 then lower(first) else 'en' end as language,
           coalesce({S.param('url', 'utm_source')}, {S.param('url', 'ref')}) as utm_source, {S.param('url', 'abt')} as test_name, {S.param('url', 'page')} as variant, count(*) as n_pages
    from p group by 1, 2, 3, 4""")
def landing_page_attribution(t):
    return P.landing_page_attribution(t["pages"])


LEADS = """leads as (
  with c as (select contact_id, lead_at, first_url, case when contact_id % 4 <> 0 then contact_id * 3 end as first_cart_id from contacts join web_contacts using (contact_id)),
       carts as (select contact_id, created_at as cart_at, technology, case when order_id % 9 = 0 then 'plugin' end as platform,
                        row_number() over (partition by contact_id order by created_at, order_id) as rn from mart_orders where contact_id % 3 <> 0),
       l as (select c_custkey as contact_id, timestamp '1995-01-01' + to_days((c_custkey % 300)::int) as first_upload_at from customer where c_custkey % 5 = 0)
  select c.contact_id, least(first_upload_at, lead_at, cart_at) as lead_date, technology,
         case when least(first_upload_at, lead_at, cart_at) >= timestamp '1995-02-01' then
           case when contains(lower(first_url), 'shallow') then 'shallowlink' when contains(lower(first_url), 'quicklink') then 'quicklink' when platform is not null then platform
                when carts.contact_id is not null then 'cart' when first_cart_id is not null and k.o_orderkey is null and s.o_orderkey is not null then 'deleted_cart'
                when first_cart_id is not null and s.o_orderkey is null then 'empty_cart' else 'unknown_cart_details' end else 'legacy' end as lead_type
  from c left join l on l.contact_id = c.contact_id left join carts on carts.contact_id = c.contact_id and rn = 1
  left join (select o_orderkey from orders where o_orderkey % 6 <> 0) k on k.o_orderkey = first_cart_id left join (select o_orderkey from orders where o_orderkey % 10 <> 9) s on s.o_orderkey = first_cart_id)"""


def leads(t):
    k = F.col("contact_id")
    people = frames.contacts(t).select("contact_id", "lead_at").join(frames.web_contacts(t).select("contact_id", "first_url"), "contact_id")
    people = people.withColumn("first_cart_id", F.when(k % 4 != 0, k * 3))
    carts = frames.mart_orders(t).filter(k % 3 != 0).select("contact_id", "order_id", "created_at", "technology", F.when(F.col("order_id") % 9 == 0, F.lit("plugin")).alias("platform"))
    legacy = t["customer"].filter("c_custkey % 5 = 0").select(
        F.col("c_custkey").alias("contact_id"), add_part(F.lit("1995-01-01").cast("timestamp_ntz"), F.col("c_custkey") % 300, "day").alias("first_upload_at")
    )
    order_id = F.col("o_orderkey").alias("order_id")
    return P.lead_qualification(
        people, legacy, carts, t["orders"].filter("o_orderkey % 6 <> 0").select(order_id), t["orders"].filter("o_orderkey % 10 <> 9").select(order_id), "1995-02-01"
    )


@register("lead_qualification", f"{S.ctes(S.WEB_CONTACTS, S.MART_ORDERS, LEADS)} select * from leads")
def lead_qualification(t):
    return leads(t)


@register("team_membership", """
    with u as (select c_custkey as contact_id, c_custkey as email, case when c_custkey % 3 = 0 then c_custkey % 10 end as team_id,
                      case when c_custkey % 3 = 0 then timestamp '2024-01-01' + to_days((c_custkey % 10)::int) end as team_created_at from customer),
         i as (select user_id as email, user_id % 10 as team_id, timestamp '2024-01-01' + to_days((user_id % 10)::int) as team_created_at,
                      case event_type when 'purchase' then 'Accepted' when 'click' then 'Pending' when 'error' then 'Revoked' else 'Draft' end as status, ts as invited_at, ts + interval 1 hour as updated_at
               from events where event_id % 7 = 0 or user_id % 2 = 0),
         a as (select email, min(invited_at) as a_at, min(updated_at) as a_up from i where status = 'Accepted' and email % 5 <> 1 group by 1),
         o as (select email, team_id as o_team, team_created_at as o_created, min(invited_at) as o_at, max(status) as o_status
               from i where status in ('Pending', 'Revoked') and email not in (select email from a) group by 1, 2, 3)
    select contact_id, coalesce(team_id, o_team) as team_id, coalesce(team_created_at, o_created) as team_created_at, coalesce(min(a_at), min(o_at)) as invited_at,
           min(a_up) as accepted_at, lower(coalesce(min(case when a_at is not null then 'accepted' end), min(o_status))) as invite_status
    from u left join a using (email) left join o using (email) where team_created_at is not null or o_created is not null group by 1, 2, 3""")
def team_membership(t):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    k, u = F.col("c_custkey"), F.col("user_id")
    users = t["customer"].select(
        k.alias("contact_id"), k.alias("email"), F.when(k % 3 == 0, k % 10).alias("team_id"), F.when(k % 3 == 0, add_part(start, k % 10, "day")).alias("team_created_at")
    )
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "Accepted").when(kind == "click", "Pending").when(kind == "error", "Revoked").otherwise("Draft")
    invites = t["events"].filter("event_id % 7 = 0 or user_id % 2 = 0").select(
        u.alias("email"), (u % 10).alias("team_id"), add_part(start, u % 10, "day").alias("team_created_at"),
        F.when((status == "Accepted") & (u % 5 == 1), "Draft").otherwise(status).alias("status"), F.col("ts").alias("invited_at"), add_part("ts", 1, "hour").alias("updated_at"),
    )
    return P.team_membership(users, invites)


TITLES = ["graduate student", "CEO and founder", "purchasing lead", "design engineer", "accountant"]

CONTACT_DIM = f"""contact_dim as (
  with o as ({entity_sql('contact_id')}),
       b as (select c.*, (['graduate student', 'CEO and founder', 'purchasing lead', 'design engineer', 'accountant'])[(c.contact_id % 6 + 1)::int] as job_title, channel, channel_grouped, first_page_grouped, lead_date, lead_type,
                    became_opportunity_at, became_customer_at, n_submitted, n_closed, closed_sales_cents, first_closed_technology
             from (select contact_id, company_id, country, created_at from contacts) c left join channels h using (contact_id) left join leads using (contact_id) left join o using (contact_id))
  select contact_id, company_id, country, created_at, job_title, channel, channel_grouped, first_page_grouped, lead_date, lead_type, became_opportunity_at, became_customer_at, n_submitted, n_closed,
         closed_sales_cents, first_closed_technology,
         case when company_id is null then 1 when lead_date is not null then rank() over (partition by company_id order by lead_date) end as inside_lead_number,
         case when company_id is null then 1 when became_opportunity_at is not null then rank() over (partition by company_id order by became_opportunity_at) end as inside_opportunity_number,
         case when company_id is null then 1 when became_customer_at is not null then rank() over (partition by company_id order by became_customer_at) end as inside_customer_number,
         case contact_id % 6 when 0 then 'University' when 1 then 'Manager' when 2 then 'Procurement' when 3 then 'Engineer or Designer' when 4 then 'Other' end as job_role,
         company_id is not null as is_part_of_company, coalesce(md5('company' || company_id), md5('contact' || contact_id)) as client_id
  from (select * exclude (company_id), b.company_id from b))"""

COMPANY_DIM = f"""company_dim as (
  with o as ({entity_sql('company_id')}),
       r as (select company_id, closed_at, order_id, lag(closed_at) over w as before, lead(closed_at) over w as after_ from mart_orders where is_closed and company_id is not null
             window w as (partition by company_id order by closed_at, order_id)),
       p as (select *, case when date_diff('day', closed_at, coalesce(after_, timestamp '2001-09-01')) > 365 then closed_at + interval 365 day end as own,
                    coalesce(date_diff('day', before, closed_at) > 365, false) as reactivated, before is null as is_first from r),
       f as (select *, lead(own) over (partition by company_id order by closed_at, order_id) as nxt from p where own is not null or reactivated or is_first),
       ret as (select * from (select company_id, coalesce(own, nxt) as churned_at, coalesce(own, nxt) is not null as is_churned,
                 row_number() over (partition by company_id order by closed_at desc, order_id desc) as back, row_number() over (partition by company_id order by closed_at, order_id) as activation_count
               from f where reactivated or is_first) where back = 1),
       av as (select sum(subtotal_cents)::bigint / count(*) as aov from mart_orders where is_closed and closed_at >= timestamp '2000-09-01' and subtotal_cents <> 0 and company_id is not null),
       rf as (select *, case when recency <= 90 then 4 when recency <= 180 then 3 when recency <= 365 then 2 else 1 end::bigint as r_score, least(frequency, 4)::bigint as f_score,
                     case when monetary >= aov * 2 then 4 when monetary >= aov then 3 when monetary >= aov / 2 then 2 else 1 end::bigint as m_score
              from (select company_id, date_diff('day', max(closed_at), timestamp '2001-09-01') as recency, count(distinct closed_at::date) as frequency,
                           sum(subtotal_cents)::bigint / count(*) as monetary from mart_orders where is_closed and company_id is not null group by 1), av),
       c as (select company_id, count(*) as n_contacts, max(inside_lead_number) as n_inside_leads, max(inside_customer_number) as n_inside_customers, min(lead_date) as became_lead_at,
                    arg_min(lead_type, (lead_date, contact_id)) filter (where lead_type is not null and lead_date is not null) as lead_type,
                    arg_min(country, (created_at, contact_id)) filter (where country is not null) as country,
                    arg_min(channel, (created_at, contact_id)) as channel, arg_min(channel_grouped, (created_at, contact_id)) as channel_grouped,
                    arg_min(struct_pack(g := first_page_grouped), (created_at, contact_id)).g as first_page_grouped
             from contact_dim where company_id is not null group by 1)
  select c.*, became_opportunity_at, became_customer_at, recent_closed_at, n_submitted, n_closed, closed_sales_cents, second_closed_at, is_churned, churned_at, activation_count,
         r_score, f_score, m_score,
         case when r_score > 2 and f_score > 2 and m_score > 2 then '1 Core Value' when r_score > 2 and f_score > 2 then '4 Small Regular'
              when r_score > 2 and m_score > 2 then '2 Core Development' when r_score > 2 then '6 Basic Development'
              when f_score > 2 and m_score > 2 then '3 Core Maintenance' when f_score > 2 then '7 Basic Maintenance'
              when m_score > 2 then '5 Core Churn' when r_score is not null then '8 Low Value Churn' end as rfm_segment
  from c left join o using (company_id) left join ret using (company_id) left join rf using (company_id))"""

DIM_BASE = S.ctes(S.WEB_CONTACTS, S.MART_ORDERS, MERGED, S.PAGE_GROUPS, CHANNELS, LEADS, CONTACT_DIM)


def contact_dim(t):
    k = F.col("contact_id")
    people = frames.contacts(t).select("contact_id", "company_id", "country", "created_at")
    people = people.withColumn("job_title", F.get(F.array(*[F.lit(x) for x in TITLES]), (k % 6).cast("int")))
    return P.contact_dimension(people, channels(t), K.entity_summary(frames.mart_orders(t), "contact_id"), leads(t))


def company_dim(t, contact):
    orders = frames.mart_orders(t)
    return P.company_dimension(
        contact, K.entity_summary(orders, "company_id"), K.retention_episodes(orders, "company_id", AS_OF), K.rfm_segments(orders, "company_id", AS_OF)
    )


@register("contact_dimension", f"{DIM_BASE} select * from contact_dim")
def contact_dimension(t):
    return contact_dim(t)


@register("company_dimension", f"{DIM_BASE}, {COMPANY_DIM} select * from company_dim")
def company_dimension(t):
    return company_dim(t, contact_dim(t))


@register("client_dimension", f"""{DIM_BASE}, {COMPANY_DIM}
    select client_id, contact_id, null::bigint as company_id, 'contact' as type, became_opportunity_at, became_customer_at, n_submitted, n_closed, closed_sales_cents, channel, channel_grouped
    from contact_dim where not is_part_of_company
    union select md5('company' || company_id), null, company_id, 'company', became_opportunity_at, became_customer_at, n_submitted, n_closed, closed_sales_cents, channel, channel_grouped from company_dim""")
def client_dimension(t):
    contact = cut_lineage(contact_dim(t), "contact-dimension")
    return P.client_dimension(contact, company_dim(t, contact))


@register("user_and_supplier_dims", """
    with reg as (select n_nationkey as nation_id, case r_name when 'AMERICA' then 'US' when 'EUROPE' then 'EU' else 'ROW' end as market from nation join region on r_regionkey = n_regionkey),
         a as (select * from (select o_custkey as party_id, 'company ' || o_orderkey % 50 as company_name, lpad((o_orderkey % 99999)::varchar, 5, '0') as postal_code,
                 row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1),
         su as (select * from (select l_suppkey as party_id, l_shipdate as last_sign_in_at, l_orderkey % 53 = 0 as is_internal,
                 row_number() over (partition by l_suppkey order by l_shipdate, l_orderkey * 10 + l_linenumber) as rn from lineitem) where rn = 1)
    select 'user' as party, c_custkey as party_id, c_name as name, company_name, postal_code, market, date_diff('day', si, timestamp '2001-09-01') as days_since_sign_in,
           not coalesce(date_diff('day', si, timestamp '2001-09-01') >= 365, false) as is_active
    from (select *, case when c_custkey % 9 <> 0 then timestamp '2000-01-01' + to_days((c_custkey * 3 % 600)::int) end as si from customer)
    left join a on a.party_id = c_custkey left join reg on nation_id = c_nationkey
    union all
    select 'supplier', s_suppkey, upper(left(s_name, 1)) || lower(substr(s_name, 2)), null, null, market, date_diff('day', last_sign_in_at, timestamp '2001-09-01'),
           not coalesce(date_diff('day', last_sign_in_at, timestamp '2001-09-01') >= 365, false)
    from supplier left join su on su.party_id = s_suppkey left join reg on nation_id = s_nationkey where not coalesce(is_internal, false)""")
def user_and_supplier_dims(t):
    regions = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nation_id"), F.when(F.col("r_name") == "AMERICA", "US").when(F.col("r_name") == "EUROPE", "EU").otherwise("ROW").alias("market")
    )
    k = F.col("c_custkey")
    users = t["customer"].select(
        k.alias("party_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"),
        F.when(k % 9 != 0, add_part(F.lit("2000-01-01").cast("timestamp_ntz"), k * 3 % 600, "day")).alias("last_sign_in_at"),
    )
    o = F.col("o_orderkey")
    addresses = t["orders"].select(
        F.col("o_custkey").alias("party_id"), o.alias("address_id"), F.col("o_orderdate").alias("created_at"),
        F.concat(F.lit("company "), (o % 50).cast("string")).alias("company_name"), F.lpad((o % 99999).cast("string"), 5, "0").alias("postal_code"),
    )
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation_id"))
    supplier_users = t["lineitem"].select(
        F.col("l_suppkey").alias("party_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("user_id"), F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("last_sign_in_at"), (F.col("l_orderkey") % 53 == 0).alias("is_internal"),
    )
    return P.user_and_supplier_dims(users, addresses, suppliers, supplier_users, regions, AS_OF)


@register("ad_click_attribution", """
    with c as (select c_custkey as contact_id, case when c_custkey % 3 = 0 then c_custkey * 2 end as click_ref, case when c_custkey % 2 = 0 then 'adwords' else 'bing' end as source,
                      case when c_custkey % 5 <> 0 then c_custkey % 40 end as group_1, c_custkey % 37 as group_2, case when c_custkey % 4 <> 0 then c_custkey % 60 end as keyword_1, c_custkey % 45 as keyword_2,
                      c_custkey % 31 as campaign_1, c_custkey % 23 as campaign_2, timestamp '1995-01-01' + to_days((c_custkey % 50)::int) as visit,
                      (['desktop', 'Computer', 'c', 'TABLET', 'm', 'watch'])[(c_custkey % 6 + 1)::int] as device from customer),
         cl as (select event_id as click_id, user_id % 20 as campaign_id, event_id % 50 as keyword_id, user_id % 30 as group_id, ts as clicked_at, case when event_type = 'click' then 'mobile' end as device from events where event_type <> 'view'),
         kw as (select source, group_id, keyword_id, min(campaign_id) as campaign_id, min(campaign_group) as campaign_group from (
                  select distinct case when p_partkey % 3 = 0 then 'adwords' else 'bing' end as source, p_partkey % 41 as group_id, p_partkey % 53 as keyword_id, p_partkey % 25 as campaign_id,
                         case when p_partkey % 25 % 7 = 0 then 'Display' else 'Group' || p_partkey % 25 % 7 end as campaign_group from part where p_partkey % 4 <> 1) group by 1, 2, 3),
         cp as (select distinct case when p_partkey % 3 = 0 then 'adwords' else 'bing' end as source, p_partkey % 25 as campaign_id,
                         case when p_partkey % 25 % 7 = 0 then 'Display' else 'Group' || p_partkey % 25 % 7 end as campaign_group from part where p_partkey % 25 < 22),
         j as (select c.*, cl.click_id, cl.campaign_id as c_campaign, cl.keyword_id as c_keyword, cl.group_id as c_group, cl.clicked_at, cl.device as c_device,
                 coalesce(k1.campaign_id, k2.campaign_id, k3.campaign_id, k4.campaign_id) as k_campaign, coalesce(k1.keyword_id, k2.keyword_id, k3.keyword_id, k4.keyword_id) as k_keyword,
                 coalesce(k1.group_id, k2.group_id, k3.group_id, k4.group_id) as k_group, coalesce(k1.campaign_group, k2.campaign_group, k3.campaign_group, k4.campaign_group) as k_name
               from c left join cl on cl.click_id = click_ref
               left join kw k1 on click_id is null and k1.source = c.source and k1.group_id = group_1 and k1.keyword_id = keyword_1
               left join kw k2 on click_id is null and k2.source = c.source and k2.group_id = group_1 and k2.keyword_id = keyword_2
               left join kw k3 on click_id is null and k3.source = c.source and k3.group_id = group_2 and k3.keyword_id = keyword_1
               left join kw k4 on click_id is null and k4.source = c.source and k4.group_id = group_2 and k4.keyword_id = keyword_2),
         m as (select j.*, coalesce(m0.campaign_id, m1.campaign_id, m2.campaign_id) as m_campaign, coalesce(m0.campaign_group, m1.campaign_group, m2.campaign_group) as m_name
               from j left join cp m0 on m0.source = 'adwords' and m0.campaign_id = c_campaign
               left join cp m1 on click_id is null and k_keyword is null and m1.source = j.source and m1.campaign_id = campaign_1
               left join cp m2 on click_id is null and k_keyword is null and m2.source = j.source and m2.campaign_id = campaign_2)
    select contact_id, source, coalesce(c_campaign, k_campaign, m_campaign) as campaign_id, coalesce(m_name, k_name) as campaign_group,
           case when keyword_1 is not null and coalesce(m_name, k_name, '') <> 'Display' then coalesce(c_keyword, k_keyword) end as keyword_id,
           case when keyword_1 is not null and coalesce(m_name, k_name, '') <> 'Display' then coalesce(c_group, k_group) end as group_id,
           date_trunc('day', coalesce(clicked_at, visit))::timestamp as click_date,
           case when regexp_matches(lower(coalesce(c_device, device)), 'desktop|computer|^c$') then 'Desktop' when regexp_matches(lower(coalesce(c_device, device)), 'tablet|^t$') then 'Tablet'
                when regexp_matches(lower(coalesce(c_device, device)), 'mobile|^m$') then 'Mobile' else lower(coalesce(c_device, device)) end as device
    from m""")
def ad_click_attribution(t):
    k, p = F.col("c_custkey"), F.col("p_partkey")
    devices = F.array(*[F.lit(x) for x in ("desktop", "Computer", "c", "TABLET", "m", "watch")])
    people = t["customer"].select(
        k.alias("contact_id"), F.when(k % 3 == 0, k * 2).alias("click_ref"), F.when(k % 2 == 0, "adwords").otherwise("bing").alias("source"),
        F.when(k % 5 != 0, k % 40).alias("group_1"), (k % 37).alias("group_2"), F.when(k % 4 != 0, k % 60).alias("keyword_1"), (k % 45).alias("keyword_2"),
        (k % 31).alias("campaign_1"), (k % 23).alias("campaign_2"), add_part(F.lit("1995-01-01").cast("timestamp_ntz"), k % 50, "day").alias("first_visit_at"),
        F.get(devices, (k % 6).cast("int")).alias("device"),
    )
    clicks = t["events"].filter("event_type <> 'view'").select(
        F.col("event_id").alias("click_id"), (F.col("user_id") % 20).alias("campaign_id"), (F.col("event_id") % 50).alias("keyword_id"),
        (F.col("user_id") % 30).alias("group_id"), F.col("ts").alias("clicked_at"), F.when(F.col("event_type") == "click", "mobile").alias("device"),
    )
    source = F.when(p % 3 == 0, "adwords").otherwise("bing").alias("source")
    name = F.when(p % 25 % 7 == 0, "Display").otherwise(F.concat(F.lit("Group"), (p % 25 % 7).cast("string"))).alias("campaign_group")
    keywords = t["part"].filter("p_partkey % 4 <> 1").select(source, (p % 41).alias("group_id"), (p % 53).alias("keyword_id"), (p % 25).alias("campaign_id"), name).distinct()
    keywords = keywords.groupBy("source", "group_id", "keyword_id").agg(F.min("campaign_id").alias("campaign_id"), F.min("campaign_group").alias("campaign_group"))
    campaigns = t["part"].filter("p_partkey % 25 < 22").select(source, (p % 25).alias("campaign_id"), name).distinct()
    return P.ad_click_attribution(people, clicks, keywords, campaigns)
