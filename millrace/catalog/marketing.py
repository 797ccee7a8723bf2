"""Advertising, e-mail, search and page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import register
from millrace.functions.columns import cents
from millrace.plans import marketing as P
from millrace.sources import frames


@register("url_traffic_report", f"""
    select {S.host('url')} as host, case when {S.path('url')} = '' then 0 else len(string_split(regexp_replace({S.path('url')}, '/$', ''), '/')) end::bigint as path_depth,
           {S.param('url', 'utm_source')} as utm_source, count(*) as n_pages from pages group by 1, 2, 3""")
def url_traffic_report(t):
    return P.url_traffic_report(t["pages"])


@register("json_property_rollup", """
    select user_id, event_type, sum(k) as sum_k, max(k) as max_k, count(k) as n_k, sum(missing) as sum_missing, max(missing) as max_missing, count(missing) as n_missing
    from (select user_id, event_type, try_cast(json_extract_string(p, '$.k') as double) as k, try_cast(json_extract_string(p, '$.volume.value') as double) as missing
          from (select *, nullif(props, '')::json as p from events)) group by 1, 2""")
def json_property_rollup(t):
    events = t["events"].withColumn("props", F.nullif("props", F.lit("")))
    return P.json_property_rollup(events, {"k": "$.k", "missing": "$.volume.value"}, ["user_id", "event_type"])


@register("email_funnel", """
    with e as (select case when user_id % 3 <> 0 then user_id % 20 end as group_id, day(ts) as campaign, user_id as recipient,
                      case event_type when 'signup' then 'SENT' when 'view' then 'DELIVERED' when 'click' then 'CLICK' when 'purchase' then 'OPEN' when 'error' then case when event_id % 5 = 0 then 'DROPPED' else 'BOUNCE' end end as type,
                      event_id % 7 = 0 as filtered, (['MOBILE', 'DESKTOP', 'TABLET'])[(event_id % 3 + 1)::int] as device from events),
         r as (select coalesce(group_id, campaign) as campaign_id, recipient, min(case when type = 'OPEN' and not filtered then device end) as device, count(*) filter (where type = 'SENT') as p_sent,
                      count(*) filter (where type = 'DROPPED') as dropped, count(*) filter (where type = 'DELIVERED') as delivered, count(*) filter (where type = 'BOUNCE') as bounced,
                      count(*) filter (where type = 'OPEN' and not filtered) as opened, count(*) filter (where type = 'CLICK' and not filtered) as clicked from e group by 1, 2),
         c as (select p_partkey as campaign_id, p_name as campaign_name from part where p_partkey % 6 <> 0)
    select r.campaign_id, campaign_name, c_custkey as contact_id, md5(recipient::varchar) as recipient, coalesce(device, 'UNKNOWN') as device, p_sent - dropped as sent, p_sent - dropped > 0 as is_sent,
           delivered, delivered > 0 as is_delivered, bounced, opened, opened > 0 as is_opened, clicked, clicked > 0 as is_clicked
    from r left join c using (campaign_id) left join (select c_custkey from customer where c_custkey % 4 <> 0) on c_custkey = recipient where p_sent > 0""")
def email_funnel(t):
    u, e, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    type_ = (
        F.when(kind == "signup", "SENT").when(kind == "view", "DELIVERED").when(kind == "click", "CLICK").when(kind == "purchase", "OPEN")
        .when(e % 5 == 0, "DROPPED").otherwise("BOUNCE")
    )
    devices = F.array(*[F.lit(x) for x in ("MOBILE", "DESKTOP", "TABLET")])
    events = t["events"].select(
        F.when(u % 3 != 0, u % 20).alias("group_id"), F.dayofmonth("ts").cast("long").alias("campaign_id"), u.alias("recipient"), type_.alias("type"),
        (e % 7 == 0).alias("filtered"), F.get(devices, (e % 3).cast("int")).alias("device"),
    )
    campaigns = t["part"].filter("p_partkey % 6 <> 0").select(F.col("p_partkey").alias("campaign_id"), F.col("p_name").alias("campaign_name"))
    people = t["customer"].filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("recipient"), F.col("c_custkey").alias("contact_id"))
    return P.email_funnel(events, campaigns, people)


NAMES = "['SN_EN_US_branded', 'DN_DE_DACH_manufacturing', 'SN_FR_FR_cnc-machining', 'SN_EN_UKI_3d-printing', 'VN_IT_IT_video', 'SN_NL_NEUR_sheet-metal', 'SN_ES_ES_other']"

SPEND = f"""spend as (
  with raw as (select event_id, ts, user_id % 20 as campaign_id, event_id % 50 as keyword_id, event_type, round(value * 100)::bigint as cents,
                      ({NAMES})[(user_id % 20 % 7 + 1)::int] as reported_name, case when user_id % 2 = 0 then 'adwords' else 'bing' end as source from events),
       names as (select source, campaign_id, arg_max(reported_name, (ts, reported_name)) as last_name from raw where event_type in ('click', 'view') group by 1, 2),
       kw as (select date_trunc('day', ts)::timestamp as date, source, campaign_id, coalesce(case when campaign_id % 5 <> 0 then ({NAMES})[(campaign_id % 7 + 1)::int] end, last_name) as campaign_name, keyword_id,
                     count(*) as impressions, count(*) filter (where event_type = 'click') as clicks, sum(cents)::bigint as cost_cents
              from raw join names using (source, campaign_id) where event_type in ('click', 'view') group by 1, 2, 3, 4, 5),
       cc as (select date_trunc('day', ts)::timestamp as date, source, campaign_id, ({NAMES})[(campaign_id % 7 + 1)::int] as campaign_name, count(*) as impressions,
                     count(*) filter (where event_type = 'click') as clicks, sum(cents)::bigint as cost_cents from raw group by 1, 2, 3, 4),
       ks as (select date, source, campaign_id, sum(impressions)::bigint as i, sum(clicks)::bigint as c, sum(cost_cents)::bigint as m from kw group by 1, 2, 3),
       u as (select date, source, campaign_id, campaign_name, keyword_id, impressions, clicks, cost_cents from kw
             union all select cc.date, cc.source, cc.campaign_id, campaign_name, null, impressions - coalesce(i, 0), clicks - coalesce(c, 0), cost_cents - coalesce(m, 0)
             from cc left join ks on ks.date = cc.date and ks.source = cc.source and ks.campaign_id = cc.campaign_id where cost_cents - coalesce(m, 0) not between -3 and 3)
  select *, split_part(campaign_name, '_', 1) as campaign_network, split_part(campaign_name, '_', 2) as campaign_language, split_part(campaign_name, '_', 3) as campaign_market,
         split_part(campaign_name, '_', 4) as campaign_detail,
         case split_part(campaign_name, '_', 3) when 'US' then 'US/CA' when 'DACH' then 'DACH' when 'FR' then 'FR' when 'UKI' then 'UKI' when 'IT' then 'IT' when 'NEUR' then 'NEUR' else 'Other' end as market_group,
         case when split_part(campaign_name, '_', 1) in ('DN', 'VN') then 'Display' when contains(campaign_name, 'cnc-machining') then 'CNC' when contains(campaign_name, '3d-printing') then '3DP'
              when contains(campaign_name, 'manufacturing') then 'Manufacturing' when contains(campaign_name, 'branded') then 'Brand' when contains(campaign_name, 'sheet-metal') then 'SM' else 'Other' end as campaign_group
  from u)"""


def spend(t):
    names = F.array(*[F.lit(x) for x in ("SN_EN_US_branded", "DN_DE_DACH_manufacturing", "SN_FR_FR_cnc-machining", "SN_EN_UKI_3d-printing", "VN_IT_IT_video", "SN_NL_NEUR_sheet-metal", "SN_ES_ES_other")])
    campaign = (F.col("user_id") % 20).alias("campaign_id")
    click = (F.col("event_type") == "click").cast("int")
    raw = t["events"].select(
        F.col("ts").alias("at"), campaign, (F.col("event_id") % 50).alias("keyword_id"), "event_type", cents("value").alias("cost_cents"), F.lit(1).alias("impressions"),
        click.alias("clicks"), F.get(names, (F.col("user_id") % 20 % 7).cast("int")).alias("reported_name"), F.when(F.col("user_id") % 2 == 0, "adwords").otherwise("bing").alias("source"),
    )
    listed = t["events"].select(campaign, F.get(names, (F.col("user_id") % 20 % 7).cast("int")).alias("campaign_name")).filter("campaign_id % 5 <> 0").distinct()
    shown = raw.filter(F.col("event_type").isin("click", "view"))
    keywords = P.keyword_performance([(s, shown.filter(F.col("source") == s), listed) for s in ("adwords", "bing")])
    campaigns = raw.withColumn("date", F.to_date("at")).withColumnRenamed("reported_name", "campaign_name")
    return P.ad_spend_daily(keywords, campaigns)


@register("ad_spend_daily", f"{S.ctes(SPEND)} select * from spend")
def ad_spend_daily(t):
    return spend(t)


@register("ad_spend_weekly_monthly", f"""{S.ctes(SPEND)}
    select 'week' as grain, source, campaign_group, date_trunc('week', date)::timestamp as start, sum(clicks)::bigint as clicks, sum(cost_cents)::bigint as cost_cents from spend group by all
    union all select 'month', source, campaign_group, date_trunc('month', date)::timestamp, sum(clicks)::bigint, sum(cost_cents)::bigint from spend group by all""")
def ad_spend_weekly_monthly(t):
    return P.spend_by_grain(spend(t), ["week", "month"])


@register("search_console", S.ctes(S.PAGE_GROUPS) + f"""
    , r as (select url, 'kw ' || page_id % 17 as keywords, page_id % 100 / 10 as position, length(html)::bigint as impressions, page_id % 50 as clicks from pages),
      p as (select *, {S.page('url')} as page from r), t as (select distinct url || 'kw ' || page_id % 17 as target_id from pages where page_id % 4 = 0)
    select url, p.page, case when length(split_part(p.page, '/', 2)) = 2 then split_part(p.page, '/', 2) else 'en' end as language, keywords, coalesce(page_group, 'Ungrouped') as page_group,
           position, impressions, clicks, t.target_id is not null as is_target
    from p left join page_groups g on g.page = lower(p.page) left join t on t.target_id = url || keywords""")
def search_console(t):
    k = F.col("page_id")
    word = F.concat(F.lit("kw "), (k % 17).cast("string"))
    rows = t["pages"].select("url", word.alias("keywords"), (k % 100 / F.lit(10)).alias("position"), F.length("html").cast("long").alias("impressions"), (k % 50).alias("clicks"))
    targets = t["pages"].filter("page_id % 4 = 0").select(F.concat("url", word).alias("target_id"))
    return P.search_console(rows, frames.page_groups(t), targets)


@register("page_metrics", S.ctes(S.PAGE_GROUPS) + f"""
    , v as (select date_trunc('day', ts)::timestamp as date, url, (event_type = 'signup')::bigint as entrances, (event_type in ('view', 'click', 'signup'))::bigint as pageviews,
                   round(value * 1000)::bigint as time_ms from events join pages on page_id = event_id // 40),
      s as (select *, {S.host('url')} as host, {S.page('url')} as page from v where url <> '' and (entrances > 0 or pageviews > 0 or time_ms > 0)),
      g as (select date, host, url, s.page, coalesce(page_group, 'Ungrouped') as page_group,
                   case when length(split_part(s.page, '/', 2)) = 2 then replace(split_part(s.page, '/', 2), 'js', 'en') else 'en' end as language,
                   sum(entrances)::bigint as entrances, sum(pageviews)::bigint as pageviews, sum(time_ms)::bigint / count(*) as time_per_pageview
            from s left join page_groups p on p.page = lower(s.page) where regexp_matches(host, 'example.com$|example.net$') group by 1, 2, 3, 4, 5, 6)
    select *, time_per_pageview * pageviews as time_weighted, {S.param('url', 'ref')} as test_name, {S.param('url', 'page')} as test_variant from g""")
def page_metrics(t):
    kind = F.col("event_type")
    visits = t["events"].join(t["pages"].select("page_id", "url"), F.floor(F.col("event_id") / F.lit(40)) == F.col("page_id")).select(
        F.to_date("ts").alias("date"), "url", (kind == "signup").cast("int").alias("entrances"), kind.isin("view", "click", "signup").cast("int").alias("pageviews"),
        F.rint(F.col("value") * 1000).cast("long").alias("time_ms"),
    )
    return P.page_metrics(visits, frames.page_groups(t), ["example.com$", "example.net$"])


@register("marketing_sheets", S.ctes(S.MESSY_CUSTOMER) + """
    select case when c_custkey % 19 = 0 then null else timestamp '2001-01-01' + to_days((c_custkey % 28)::int) end as month, nullif(trim(nation_text), '') as country, nullif(trim(c_mktsegment), '') as category,
           try_cast(nation_text as bigint) as search_volume, try_cast(balance_cents as bigint) / 100 as cost, c_name as notes from messy_customer""")
def marketing_sheets(t):
    k = F.col("c_custkey")
    day = F.concat(F.lit("2001-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    sheet = frames.messy_customer(t).select(
        F.when(k % 19 == 0, "soon").otherwise(day).alias("month"), F.col("nation_text").alias("country"), F.col("c_mktsegment").alias("category"),
        F.col("nation_text").alias("search_volume"), F.col("balance_cents").alias("cost"), F.col("c_name").alias("notes"),
    )
    return P.marketing_sheets(sheet)
