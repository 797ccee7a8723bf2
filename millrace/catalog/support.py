"""Ticket, interaction, question and dispute queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.events import CLASSIFIED, classified
from millrace.catalog.registry import register
from millrace.functions.dates import add_part
from millrace.plans import support as P

START = "2024-01-01"
GROUPS = ["Partner Success", "Customer Care", "Supply Ops", "Sales", "Technical Review", "Logistics", "Finance", "Project Manager EU", "Misc"]
SOURCES = ["email", "phone", "portal", "outbound_email", "feedback_widget"]
RATINGS = [103, 102, 100, -102, -103, 7]


def pick(values, position):
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def sent_at(conv, turn):
    return add_part(add_part(F.lit(START).cast("timestamp_ntz"), conv % 20, "day"), turn * 7, "hour")


TICKETS = f"""talk as (select conv_id as ticket_id, conv_id * 100 + turn as message_id, turn, role, timestamp '2024-01-01' + to_days((conv_id % 20)::int) + to_hours(turn * 7) as created_at from conversations),
tickets as (select ticket_id, min(created_at) as created_at, min(created_at) filter (where role = 'assistant') as first_responded_at, case when ticket_id % 5 <> 0 then max(created_at) end as resolved_at,
                   ({GROUPS!r})[(ticket_id % 9 + 1)::int] as grp, ({SOURCES!r})[(ticket_id % 5 + 1)::int] as source, ticket_id % 3 = 0 as is_internal_requester from talk group by ticket_id),
merges as (
  with b as (select ticket_id, message_id, created_at, case ticket_id % 6 when 0 then 'Ticket closed and merged into ' || (ticket_id + 1) when 1 then 'Tickets ' || (ticket_id - 1) || ', ' || (ticket_id + 4) || ' merged into this'
                    when 2 then 'ticket merged into ' || ticket_id else 'hello' end as body from talk where turn = 0)
  select ticket_id, created_at as merged_at, message_id, linked::bigint as linked_ticket_id, is_merged, not is_merged as has_incoming, is_merged and linked::bigint = ticket_id as is_merged_with_self
  from (select *, regexp_matches(body, '\\d+.?$') as is_merged, unnest(regexp_extract_all(body, '\\d+')) as linked from b where regexp_matches(lower(body), 'ticket.*merged into')))"""


def talk(t):
    conv, turn = F.col("conv_id"), F.col("turn")
    return t["conversations"].select(conv.alias("ticket_id"), (conv * 100 + turn).alias("message_id"), "turn", "role", sent_at(conv, turn).alias("created_at"))


def tickets(t):
    k = F.col("ticket_id")
    heads = talk(t).groupBy("ticket_id").agg(
        F.min("created_at").alias("created_at"), F.min(F.when(F.col("role") == "assistant", F.col("created_at"))).alias("first_responded_at"), F.max("created_at").alias("_last")
    )
    return heads.select(
        "ticket_id", "created_at", "first_responded_at", F.when(k % 5 != 0, F.col("_last")).alias("resolved_at"), pick(GROUPS, k % 9).alias("group"), pick(SOURCES, k % 5).alias("source"),
        (k % 3 == 0).alias("is_internal_requester"), (k * 7).alias("deal_ref"), F.when(k % 2 == 0, k * 11).alias("document_ref"), (k + 1_000_000).alias("po_ref"),
    )


def merges(t):
    k = F.col("ticket_id")
    text = k.cast("string")
    body = (
        F.when(k % 6 == 0, F.concat(F.lit("Ticket closed and merged into "), (k + 1).cast("string")))
        .when(k % 6 == 1, F.concat(F.lit("Tickets "), (k - 1).cast("string"), F.lit(", "), (k + 4).cast("string"), F.lit(" merged into this")))
        .when(k % 6 == 2, F.concat(F.lit("ticket merged into "), text)).otherwise("hello")
    )
    return P.merge_events(talk(t).filter("turn = 0").withColumn("body", body))


@register("ticket_merge_events", f"{S.ctes(TICKETS)} select * from merges")
def ticket_merge_events(t):
    return merges(t)


TEAM_SQL = """case when regexp_matches(grp, 'Partner|Suppliers') then 'Partner Support' when regexp_matches(grp, 'Customer|^Project Manager') then 'Customer Team' when contains(grp, 'Supply') then 'Supply'
  when grp = 'Sales' then 'Sales' when grp = 'Technical Review' then 'Mechanical Engineering' when grp = 'Logistics' then 'Logistics' when grp = 'Finance' then 'Finance' end"""

TICKET_FACT = f"""ticket_fact as (
  with r as (select * from merges where not is_merged_with_self),
       l as (select * from (select ticket_id, linked_ticket_id, is_merged, row_number() over (partition by ticket_id order by merged_at desc, linked_ticket_id desc, message_id) as rn from r) where rn = 1),
       i as (select r.ticket_id, min(o.created_at) as c, min(o.first_responded_at) as f, min(o.resolved_at) as s from r join tickets o on o.ticket_id = r.linked_ticket_id where has_incoming group by 1),
       s as (select * from (select user_id as ticket_id, event_id as survey_id, ({RATINGS!r})[(event_id % 6 + 1)::int] as rating, row_number() over (partition by user_id order by event_id) as rn from events where event_type = 'click') where rn = 1),
       op as (select user_id as ticket_id, min(ts) as first_open_at from events where event_type = 'signup' group by 1),
       t as (select t.*, least(t.created_at, c) as c2, least(t.first_responded_at, f) as f2, least(t.resolved_at, s) as s2 from tickets t left join i using (ticket_id))
  select t.ticket_id, coalesce(d.o, p.o, q.o) as order_id, grp as "group", {TEAM_SQL} as team, source, c2 as created_at, f2 as first_response_at, s2 as resolved_at, first_open_at,
         date_diff('day', c2, s2) as days_to_resolution, date_diff('day', c2, f2) as days_to_first_response,
         case rating when 103 then 'extremely satisfied' when 102 then 'satisfied' when 100 then 'other' when -102 then 'dissatisfied' when -103 then 'extremely dissatisfied' end as satisfaction,
         l.linked_ticket_id, not coalesce(l.is_merged, false) as is_primary
  from t left join l using (ticket_id) left join s using (ticket_id) left join op using (ticket_id)
  left join (select o_custkey, min(o_orderkey) as o from orders where o_orderstatus = 'F' group by 1) d on d.o_custkey = t.ticket_id * 7
  left join (select o_orderkey, o_orderkey as o from orders where o_orderkey % 5 <> 0) p on p.o_orderkey = case when t.ticket_id % 2 = 0 then t.ticket_id * 11 end
  left join (select o_orderkey + 1000000 as k, o_orderkey as o from orders) q on q.k = t.ticket_id + 1000000)"""


def ticket_facts(t):
    k = F.col("o_orderkey")
    references = [
        (t["orders"].filter("o_orderstatus = 'F'"), "deal_ref", "o_custkey", "o_orderkey"),
        (t["orders"].filter("o_orderkey % 5 <> 0"), "document_ref", "o_orderkey", "o_orderkey"),
        (t["orders"].withColumn("po_number", k + 1_000_000), "po_ref", "po_number", "o_orderkey"),
    ]
    surveys = t["events"].filter("event_type = 'click'").select(F.col("user_id").alias("ticket_id"), F.col("event_id").alias("survey_id"), pick(RATINGS, F.col("event_id") % 6).alias("rating"))
    opened = t["events"].filter("event_type = 'signup'").select(F.col("user_id").alias("ticket_id"), F.col("ts").alias("changed_at"))
    return P.ticket_fact(tickets(t), merges(t), references, surveys, opened)


@register("ticket_fact", f"{S.ctes(TICKETS, TICKET_FACT)} select * from ticket_fact")
def ticket_fact(t):
    return ticket_facts(t)


@register("ticket_tags", """
    with x as (select conv_id as ticket_id, case when turn % 4 = 3 then '[]' else '[' || role || ', t' || turn || ', ' || role || conv_id % 4 || ', a, b,c]' end as tags from conversations where turn < 5)
    select ticket_id, trim(tag) as tag from (select ticket_id, unnest(string_split(regexp_replace(tags, '[\\[\\]]', '', 'g'), ',')) as tag from x where tags <> '[]') where trim(tag) <> ''""")
def ticket_tags(t):
    turn = F.col("turn")
    tags = F.concat(
        F.lit("["), "role", F.lit(", t"), turn.cast("string"), F.lit(", "), "role", (F.col("conv_id") % 4).cast("string"), F.lit(", a, b,c]"),
    )
    rows = t["conversations"].filter("turn < 5").select(F.col("conv_id").alias("ticket_id"), F.when(turn % 4 == 3, "[]").otherwise(tags).alias("tags"))
    return P.ticket_tags(rows)


INTERACTIONS = f"""interactions as (
  with f as (select f.*, is_internal_requester from ticket_fact f join (select ticket_id, is_internal_requester from tickets) using (ticket_id)),
       m as (select message_id, ticket_id, created_at, turn % 3 as source_code, (message_id % 7) as category, role = 'system' as is_private, case when message_id % 13 = 0 then 'Dev Ops' else role end as agent from talk),
       r as (select 'message' as feed, message_id as interaction_id, m.ticket_id, order_id, m.created_at, team,
                    case when agent = 'Dev Ops' then 'Dev Ops' when source_code = 2 and category = 6 then 'agent reply' when is_private then 'note' when category = 3 then 'agent reply' else 'customer reply' end as kind
             from m join f using (ticket_id) where not (source_code = 2 and category = 3) and source <> 'phone'
             union all
             select 'ticket', ticket_id, ticket_id, order_id, created_at, team, case when source = 'portal' then 'portal' when (source = 'email' and is_internal_requester) or source = 'outbound_email' then 'agent initiation'
                    when source in ('email', 'feedback_widget') then 'customer initiation' end from f where source <> 'phone'),
       e as (select distinct event_id as interaction_id, unnest(case when event_id % 4 = 0 then [null] else [user_id, user_id + 1] end) as order_id, ts as created_at,
                    case event_type when 'purchase' then 'Note' when 'click' then 'Email' when 'view' then 'Incoming_email' when 'error' then 'Call' else 'Task' end as kind from events)
  select 'support' as source, interaction_id, order_id, created_at, kind, case kind when 'agent reply' then 'Outgoing Email' when 'agent initiation' then 'Outgoing Email' when 'customer reply' then 'Incoming Email'
         when 'customer initiation' then 'Incoming Email' when 'portal' then 'Portal' when 'note' then 'Note' end as interaction_type, team from r
  union all select 'crm', interaction_id, order_id, created_at, kind, case when kind = 'Email' then 'Outgoing Email' else kind end, null from e)"""


def interactions(t):
    m = F.col("message_id")
    messages = talk(t).select(
        "message_id", "ticket_id", "created_at", (F.col("turn") % 3).alias("source_code"), (m % 7).alias("category"), (F.col("role") == "system").alias("is_private"),
        F.when(m % 13 == 0, "Dev Ops").otherwise(F.col("role")).alias("agent"),
    )
    facts = ticket_facts(t).join(tickets(t).select("ticket_id", "is_internal_requester"), "ticket_id")
    u, kind = F.col("user_id"), F.col("event_type")
    type_ = F.when(kind == "purchase", "NOTE").when(kind == "click", "EMAIL").when(kind == "view", "INCOMING_EMAIL").when(kind == "error", "CALL").otherwise("TASK")
    deals = F.when(F.col("event_id") % 4 == 0, "[]").otherwise(F.concat(F.lit("["), u.cast("string"), F.lit(", "), (u + 1).cast("string"), F.lit("]")))
    crm = t["events"].select(
        F.col("event_id").alias("engagement_id"), F.col("ts").alias("created_at"), type_.alias("type"), F.concat(F.lit("["), u.cast("string"), F.lit("]")).alias("contact_ids"),
        deals.alias("deal_ids"), F.lit("[7, 8]").alias("company_ids"),
    )
    return P.interactions_fact(P.ticket_interactions(messages, facts), P.engagements(crm))


@register("interactions_fact", f"{S.ctes(TICKETS, TICKET_FACT, INTERACTIONS)} select * from interactions")
def interactions_fact(t):
    return interactions(t)


@register("interactions_per_order", f"""{S.ctes(TICKETS, TICKET_FACT, INTERACTIONS)}
    , k as (select *, source || '-' || interaction_id as id from interactions where order_id is not null and interaction_type <> 'Portal')
    select order_id, count(distinct id) as n_interactions, count(distinct id) filter (where source = 'support') as n_support, count(distinct id) filter (where interaction_type = 'Outgoing Email') as n_outgoing,
           count(distinct id) filter (where source = 'support' and interaction_type = 'Outgoing Email') as n_outgoing_support, count(distinct id) filter (where interaction_type = 'Incoming Email') as n_incoming,
           count(distinct id) filter (where source = 'support' and interaction_type = 'Note') as n_notes from k group by 1""")
def interactions_per_order(t):
    return P.interactions_per_order(interactions(t))


@register("questions_fact", S.ctes(S.DOCUMENTS) + """
    , q as (select event_id as question_id, event_id * 10 + event_id % 6 as document_id, event_id as order_id, ts as submitted_at, case when event_id % 3 <> 0 then ts + to_minutes(event_id % 9000) end as answered_at,
                   case when event_type = 'click' then props end as text, case event_type when 'view' then 'dimension_question' when 'click' then 'open_question' when 'error' then 'option_question' end as question_type
            from events where event_type in ('view', 'click', 'error'))
    select *, answered_at is not null as is_answered, round(date_diff('minute', submitted_at, answered_at) / 1440, 2) as days_to_answer from q where document_id in (select doc_id from documents where is_active)""")
def questions_fact(t):
    k = F.col("event_id")
    base = t["events"].select(
        k.alias("question_id"), (k * 10 + k % 6).alias("document_id"), k.alias("order_id"), F.col("ts").alias("submitted_at"),
        F.when(k % 3 != 0, add_part("ts", k % 9000, "minute")).alias("answered_at"), "event_type", F.col("props").alias("text"),
    )
    feeds = {
        "dimension_question": base.filter("event_type = 'view'").drop("event_type", "text"), "open_question": base.filter("event_type = 'click'").drop("event_type"),
        "option_question": base.filter("event_type = 'error'").drop("event_type", "text"),
    }
    from_documents = t["lineitem"].filter("l_linestatus = 'O'")
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 2).otherwise(4)
    active = from_documents.select((F.col("l_orderkey") * 10 + flag + 1).alias("document_id"))
    return P.questions_fact(feeds, active)


@register("disputes_and_complaints", S.ctes(CLASSIFIED) + """
    , li as (select l_orderkey as order_id, min(l_shipdate) as line_at from lineitem where l_returnflag = 'R' and l_linenumber = 1 group by 1),
      d as (select user_id as order_id, event_id as dispute_id, coalesce(line_at, ts) as disputed_at, case when event_id % 2 = 0 then 'refund' else 'remake' end as requested_outcome, 'type ' || event_id % 3 as dispute_type
            from events left join li on li.order_id = user_id where event_type = 'error' and user_id % 3 <> 0),
      l as (select * exclude (rn) from (select *, row_number() over (partition by order_id order by disputed_at desc, dispute_id desc) as rn from d) where rn = 1),
      o as (select order_id, min(ts) as disputed_at from classified where std_event_id = 105 and ts < timestamp '2024-01-20' group by 1),
      u as (select *, 'disputes' as system from l union all select order_id, null, disputed_at, null, null, 'event texts' from o where order_id not in (select order_id from l)),
      rf as (select l_orderkey as order_id, min(l_shipdate + interval 30 day) as refund_at from lineitem where l_returnflag = 'R' group by 1),
      rm as (select user_id as order_id, min(ts) as remake_at from events where event_type = 'purchase' and event_id % 4 = 0 group by 1)
    select u.*, least(refund_at, remake_at) as resolved_at, date_diff('hour', disputed_at, least(refund_at, remake_at)) as hours_to_resolution,
           case when least(refund_at, remake_at) = refund_at then 'refund' when least(refund_at, remake_at) = remake_at then 'remake' end as resolution
    from u left join rf using (order_id) left join rm using (order_id)""")
def disputes_and_complaints(t):
    e = F.col("event_id")
    order = F.col("user_id").alias("order_id")
    disputes = t["events"].filter("event_type = 'error' and user_id % 3 <> 0").select(
        order, e.alias("dispute_id"), F.col("ts").alias("created_at"), F.when(e % 2 == 0, "refund").otherwise("remake").alias("outcome"), F.concat(F.lit("type "), (e % 3).cast("string")).alias("type")
    )
    returned = t["lineitem"].filter("l_returnflag = 'R'")
    line_issues = returned.filter("l_linenumber = 1").select(F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("created_at"))
    legacy = classified(t).filter((F.col("std_event_id") == 105) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))).select("order_id", F.col("ts").alias("at"))
    refunds = returned.select(F.col("l_orderkey").alias("order_id"), add_part("l_shipdate", 30, "day").alias("at"))
    remakes = t["events"].filter("event_type = 'purchase' and event_id % 4 = 0").select(order, F.col("ts").alias("at"))
    return P.disputes_fact(disputes, line_issues, legacy, refunds, remakes)


# Codes of dispute issues.
ISSUES = {1: "tolerance_issue", 2: "surface_finish_issue", 3: "incomplete_order_issue", 4: "incorrect_material_issue", 5: "missing_threads_issue", 6: "parts_damaged_issue", 7: "other_issue"}


@register("dispute_line_flags", "select l_orderkey as line_key, min(l_shipdate) as disputed_at, max(l_quantity)::bigint as affected_quantity, " + ", ".join(
    f"max(case when l_linenumber = {code} then 1 else 0 end)::bigint as has_{name}" for code, name in ISSUES.items()
) + " from lineitem where l_returnflag = 'R' group by 1")
def dispute_line_flags(t):
    issues = t["lineitem"].filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("line_key"), F.col("l_shipdate").alias("created_at"), F.col("l_linenumber").alias("kind"), F.col("l_quantity").cast("long").alias("quantity")
    )
    return P.dispute_line_flags(issues, ISSUES)


@register("complaints_fact", """
    with c as (select event_id as complaint_id, case when event_id % 4 <> 0 then event_id end as order_id, ts as created_at, case when event_id % 5 <> 0 then ts + to_days((event_id % 30)::int) end as decided_at, event_type as claim from events where event_type in ('error', 'signup'))
    select c.*, o_orderstatus as order_status, date_diff('day', created_at, decided_at) as days_to_decision from c left join orders on o_orderkey = order_id""")
def complaints_fact(t):
    k = F.col("event_id")
    complaints = t["events"].filter(F.col("event_type").isin("error", "signup")).select(
        k.alias("complaint_id"), F.when(k % 4 != 0, k).alias("order_id"), F.col("ts").alias("created_at"), F.when(k % 5 != 0, add_part("ts", k % 30, "day")).alias("decided_at"), F.col("event_type").alias("claim")
    )
    return P.complaints_fact(complaints, t["orders"].select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status")))
