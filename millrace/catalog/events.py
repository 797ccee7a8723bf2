"""Event, stage, status and calendar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, register
from millrace.functions.dates import add_part, day
from millrace.plans import calendar as C
from millrace.plans import events as P
from millrace.sources import frames
from millrace.sources.session import cut_lineage

SAMPLES = [
    "Completed the order", "Created a new order", "Aftership says completed", "Canceled an auction after review", "Opened a Dispute", "Created a new reorder, now completed",
    "Updated quote with dispute", "Processed payment", "Shippo label", "order accepted and completed", "Quote was deleted after a dispute", "Customer Dispute closed",
]
SAMPLES_SQL = "[" + ", ".join(f"'{s}'" for s in SAMPLES) + "]"

CLASSIFIED = f"""classified as (
  select *, case when contains(d, 'created a new order') then 100 when contains(d, 'created a new reorder') then 101 when contains(d, 'completed') then 102 when contains(d, 'order accepted') then 103
                 when contains(d, 'dispute') then 105 when contains(d, 'canceled an auction') then 222 else -9 end::bigint as std_event_id
  from (select event_id, user_id as order_id, ts, ({SAMPLES_SQL})[(event_id % 12 + 1)::int] as description, lower(({SAMPLES_SQL})[(event_id % 12 + 1)::int]) as d from events)
  where not regexp_matches(d, 'aftership|shippo') and regexp_matches(d, 'completed|canceled an auction|dispute'))"""


def classified(t):
    text = F.get(F.array(*[F.lit(s) for s in SAMPLES]), (F.col("event_id") % 12).cast("int"))
    return P.order_event_classification(t["events"].select("event_id", F.col("user_id").alias("order_id"), "ts", text.alias("description")), "description")


@register("order_event_classification", f"{S.ctes(CLASSIFIED)} select event_id, order_id, ts, description, std_event_id from classified")
def order_event_classification(t):
    return classified(t)


@register("order_event_milestones", f"""{S.ctes(CLASSIFIED)}
    select order_id, min(ts) filter (where std_event_id = 102) as first_completed_at, max(ts) filter (where std_event_id = 102) as last_completed_at,
           min(ts) filter (where std_event_id = 105) as first_disputed_at, min(ts) filter (where std_event_id = 222) as auction_canceled_at from classified group by 1""")
def order_event_milestones(t):
    return P.event_milestones(classified(t), "order_id", "ts")


STAGES = """stages as (
  with raw as (select user_id as deal_id, event_id, ts as changed_at, event_type, event_id % 4 as m from events),
       u as (select deal_id, event_id, changed_at, case event_type when 'signup' then 'New' when 'purchase' then 'Won - In production' when 'error' then 'Closed - Canceled' end as stage
             from raw where changed_at < timestamp '2024-01-10'
             union select deal_id, event_id, changed_at, case event_type when 'signup' then case when m = 0 then 'New' else 'In review - New' end when 'click' then 'In review - Ongoing'
                    when 'purchase' then case when m < 2 then 'In review - Completed' else 'Won - In production' end when 'error' then case when m < 2 then 'In review - Rejected' else 'Closed - Canceled' end end
             from raw where changed_at >= timestamp '2024-01-10')
  select *, lead(stage) over w as next_stage, lead(changed_at) over w as next_changed_at, date_diff('minute', changed_at, lead(changed_at) over w) as minutes_in_stage
  from u where stage is not null window w as (partition by deal_id order by changed_at, event_id))"""


def stages(t):
    kind, m = F.col("event_type"), F.col("event_id") % 4
    base = t["events"].select(F.col("user_id").alias("deal_id"), "event_id", F.col("ts").alias("changed_at"), "event_type")
    old = F.when(kind == "signup", "New").when(kind == "purchase", "Won - In production").when(kind == "error", "Closed - Canceled")
    new = (
        F.when(kind == "signup", F.when(m == 0, "New").otherwise("In review - New")).when(kind == "click", "In review - Ongoing")
        .when(kind == "purchase", F.when(m < 2, "In review - Completed").otherwise("Won - In production"))
        .when(kind == "error", F.when(m < 2, "In review - Rejected").otherwise("Closed - Canceled"))
    )
    return P.stage_history(
        base.withColumn("stage", old).drop("event_type"), base.withColumn("stage", new).drop("event_type"), "2024-01-10", day("changed_at")
    )


@register("deal_stage_history", f"{S.ctes(STAGES)} select * from stages")
def deal_stage_history(t):
    return stages(t)


@register("deal_stage_timeline", f"""{S.ctes(STAGES)}
    , d as (select deal_id, min(changed_at) filter (where stage like 'Won%') as won_at, min(changed_at) filter (where stage = 'Closed - Canceled') as cancelled_at,
                   arg_min(minutes_in_stage, (changed_at, event_id)) filter (where stage = 'New' and next_stage is not null) as minutes_in_new from stages group by 1),
      o as (select o_orderkey as order_id, o_orderkey % 200 as deal_id, case when o_orderstatus = 'F' then o_orderdate end as accepted_at, case when o_orderstatus = 'P' then o_orderdate + interval 1 day end as in_production_at,
                   case o_orderstatus when 'F' then 'completed' when 'P' then 'canceled' end as supply_status, case when o_orderkey % 3 = 0 then 'lost' else 'open' end as crm_status from orders)
    select order_id, deal_id, coalesce(accepted_at, in_production_at, won_at) is not null as is_closed, coalesce(accepted_at, in_production_at, won_at) as closed_at, cancelled_at, minutes_in_new,
           case when crm_status = 'lost' and supply_status = 'canceled' then 'lost' else coalesce(supply_status, crm_status) end as order_status from o left join d using (deal_id)""")
def deal_stage_timeline(t):
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    orders = t["orders"].select(
        k.alias("order_id"), (k % 200).alias("deal_id"), F.when(status == "F", F.col("o_orderdate")).alias("accepted_at"),
        F.when(status == "P", add_part("o_orderdate", 1, "day")).alias("in_production_at"),
        F.when(status == "F", "completed").when(status == "P", "canceled").alias("supply_status"), F.when(k % 3 == 0, "lost").otherwise("open").alias("crm_status"),
    )
    return P.deal_stage_timeline(stages(t), orders)


REVIEWS = """reviews as (
  with r as (select *, sum(case when stage = 'In review - New' then 1 else 0 end) over (partition by deal_id order by changed_at, event_id rows unbounded preceding) as n from stages where stage like 'In review%'),
       g as (select deal_id, nullif(n, 0)::bigint as iteration, min(changed_at) filter (where stage = 'In review - New') as new_at, min(changed_at) filter (where stage = 'In review - Ongoing') as ongoing_at,
                    min(changed_at) filter (where stage = 'In review - Completed') as completed_at, min(changed_at) filter (where stage = 'In review - Rejected') as rejected_at,
                    sum(minutes_in_stage) filter (where stage = 'In review - New')::bigint as minutes_new, sum(minutes_in_stage) filter (where stage = 'In review - Ongoing')::bigint as minutes_ongoing
             from r group by 1, 2)
  select (deal_id || lpad(iteration::varchar, 2, '0'))::bigint as review_id, deal_id, iteration, new_at, ongoing_at, coalesce(rejected_at, completed_at) as review_completed_at,
         case when rejected_at is not null then 'rejected' when completed_at is not null then 'completed' end as result, minutes_new, minutes_ongoing from g)"""


def reviews(t):
    return P.review_iterations(cut_lineage(stages(t), "stages"), day("changed_at"))


@register("review_iterations", f"{S.ctes(STAGES, REVIEWS)} select * from reviews")
def review_iterations(t):
    return reviews(t)


@register("reviews_per_deal", f"""{S.ctes(STAGES, REVIEWS)}
    select deal_id, max(iteration) as n_reviews, sum(minutes_new)::bigint as minutes_new, sum(minutes_ongoing)::bigint as minutes_ongoing, max(review_completed_at) as last_review_completed_at from reviews group by 1""")
def reviews_per_deal(t):
    return P.reviews_per_deal(reviews(t))


STATUS = """status_rows as (
  with u as (select o_orderkey as order_id, 0 as i, 'created_at' as status, created_at as start_date from milestones union all select o_orderkey, 1, 'shipped_at', shipped_at from milestones
             union all select o_orderkey, 2, 'delivered_at', delivered_at from milestones union all select o_orderkey, 3, 'cancelled_at', cancelled_at from milestones)
  select order_id, status, start_date, coalesce(lead(start_date) over (partition by order_id order by start_date, i), case when status <> 'cancelled_at' then timestamp '2001-09-01' end) as end_date
  from u where start_date is not null)"""
STATUS_COLUMNS = {"created_at": "created_at", "shipped_at": "shipped_at", "delivered_at": "delivered_at", "cancelled_at": "cancelled_at"}


def history(t):
    return P.status_history(frames.milestones(t).withColumnRenamed("o_orderkey", "order_id"), "order_id", STATUS_COLUMNS, ["cancelled_at"], AS_OF)


@register("status_history", f"{S.ctes(S.MILESTONES, STATUS)} select *, date_diff('day', start_date, end_date) as days_in_status, replace(status, '_at', '') as label from status_rows")
def status_history(t):
    return history(t)


@register("status_history_daily", f"""{S.ctes(S.MILESTONES, STATUS)}
    select order_id, status, count(*) as n_days, min(date) as first_day, max(date) as last_day from (
      select order_id, status, unnest(generate_series(start_date, end_date - interval 1 day, interval 1 day)) as date from status_rows where end_date > start_date) group by 1, 2""")
def status_history_daily(t):
    daily = P.status_history_daily(history(t))
    return daily.groupBy("order_id", "status").agg(F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


HOLIDAYS_SQL = "holidays as (select distinct make_date(y::int, 1, 1) as date from generate_series(1994, 2025) g(y))"


def holidays(t):
    """New Year's Day of every year that matters."""
    years = t.spark.range(1994, 2026).toDF("y")
    return years.select(F.make_date("y", F.lit(1), F.lit(1)).alias("date"))


@register("business_calendar", S.ctes(HOLIDAYS_SQL) + """
    , h as (select unnest(generate_series(date_trunc('day', (select min(ts) from events)), date_trunc('day', (select max(ts) from events)) + interval 30 day - interval 1 hour, interval 1 hour)) as date_hour),
      b as (select date_hour, case when isodow(date_hour) <= 5 and hour(date_hour) between 9 and 17 and date_hour::date not in (select date from holidays) then date_hour end as bh from h),
      f as (select date_hour, coalesce(bh, lead(bh ignore nulls) over (order by date_hour)) as business_hour, bh is not null as is_business_hour from b),
      e as (select date_trunc('hour', ts) as hr, count(*) as n from events group by 1)
    select date_hour, business_hour, is_business_hour, coalesce(n, 0) as n_events from f left join e on hr = date_hour where date_hour < (select date_trunc('day', max(ts)) + interval 1 day from events)""")
def business_calendar(t):
    return C.business_calendar(t["events"], "ts", holidays(t))


@register("business_minutes", S.ctes(S.TIMED_INTERVAL, HOLIDAYS_SQL) + """
    , h as (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-11-30', interval 1 hour)) as date_hour),
      b as (select date_hour, case when isodow(date_hour) <= 5 and hour(date_hour) between 9 and 17 and date_hour::date not in (select date from holidays) then date_hour end as bh from h),
      f as (select date_hour, bh is not null as inside, lead(bh ignore nulls) over (order by date_hour) as nxt from b),
      s as (select i.*, case when a.inside then started_at else a.nxt end as business_start, case when z.inside then finished_at else z.nxt end as business_end
            from timed_interval i join f a on a.date_hour = date_trunc('hour', started_at) join f z on z.date_hour = date_trunc('hour', finished_at)),
      d as (select *, date_diff('day', business_start, business_end) as days,
                   list_sum([case when isodow(business_start::date + x::int) = 7 and x > 0 or isodow(business_start::date + x::int) = 6 then 1 else 0 end for x in range(0, date_diff('day', business_start, business_end) + 1)])::bigint as weekend
            from s)
    select o_orderkey, o_custkey, started_at, finished_at, business_start, business_end, date_diff('minute', started_at, finished_at) as minutes,
           date_diff('minute', business_start, business_end) - 60 * ((days - weekend) * 15 + weekend * 24) as business_minutes from d""")
def business_minutes(t):
    return C.business_minutes_job(frames.timed_interval(t), "started_at", "finished_at", holidays(t))
