"""Tickets, interactions, questions and disputes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import is_true, ladder
from millrace.functions.dates import boundary_diff
from millrace.operators.joins import multi_list_product, split_to_rows, waterfall_resolve
from millrace.operators.keyed import join_known, only_matching
from millrace.operators.sets import union_all
from millrace.operators.windows import first_rows

# Support team by group name (pattern, team), first match wins.
TEAMS = [
    ("Partner|Suppliers|^Legacy Order Fulfilment$", "Partner Support"),
    ("Customer|^Project Manager|^TrustPilot$|^Inbox$|^Legal$", "Customer Team"),
    ("Supply", "Supply"),
    ("^Sales$", "Sales"),
    ("^In Review - Supply RFQ$|^Technical Review$", "Mechanical Engineering"),
    ("^Broken tracking links$|^Logistics$", "Logistics"),
    ("^Finance$", "Finance"),
]

# Survey rating codes.
SATISFACTION = {103: "extremely satisfied", 102: "satisfied", 100: "other", -102: "dissatisfied", -103: "extremely dissatisfied"}

# Interaction kinds of the ticket system and the type they report as.
INTERACTION_TYPES = {
    "agent reply": "Outgoing Email", "agent initiation": "Outgoing Email", "customer reply": "Incoming Email",
    "customer initiation": "Incoming Email", "portal": "Portal", "note": "Note",
}


def merge_events(messages: DataFrame) -> DataFrame:
    """One row per merge named in a ticket's messages: a text ending in a number means this ticket was merged away,
    any other means that the named tickets came in. All ids in the text count.

    messages: ticket_id, message_id, created_at, body.
    """
    merges = messages.filter(F.lower("body").rlike("ticket.*merged into"))
    ids = F.regexp_extract_all("body", F.lit(r"(\d+)"), F.lit(1))
    out = merges.withColumns({"is_merged": F.col("body").rlike(r"\d+.?$"), "_id": F.explode(ids)})
    linked = F.col("_id").cast("long")
    return out.select(
        "ticket_id", F.col("created_at").alias("merged_at"), "message_id", linked.alias("linked_ticket_id"), "is_merged", (~F.col("is_merged")).alias("has_incoming"),
        (F.col("is_merged") & (linked == F.col("ticket_id"))).alias("is_merged_with_self"),
    )


def ticket_fact(tickets: DataFrame, merges: DataFrame, references: list[tuple[DataFrame, str, str, str]], surveys: DataFrame, open_status: DataFrame) -> DataFrame:
    """One row per ticket: order it belongs to, team, clocks that include tickets merged into it, survey result.

    tickets: ticket_id, created_at, first_responded_at, resolved_at, group, source, ... ; references: as in waterfall_resolve.
    """
    real = merges.filter(~F.col("is_merged_with_self"))
    latest = first_rows(real, ["ticket_id"], ["-merged_at", "-linked_ticket_id", "message_id"]).select("ticket_id", "linked_ticket_id", F.col("is_merged").alias("_merged"))
    stamps = ["created_at", "first_responded_at", "resolved_at"]
    other = tickets.select(F.col("ticket_id").alias("linked_ticket_id"), *[F.col(x).alias(f"_{x}") for x in stamps])
    incoming = real.filter("has_incoming").select("ticket_id", "linked_ticket_id").distinct().join(other, "linked_ticket_id")
    incoming = incoming.groupBy("ticket_id").agg(*[F.min(f"_{x}").alias(f"_in_{x}") for x in stamps])
    out = tickets.join(incoming, "ticket_id", "left").withColumns({f"first_{x}": F.least(x, f"_in_{x}") for x in stamps})
    out = out.join(latest, "ticket_id", "left").join(open_status.groupBy("ticket_id").agg(F.min("changed_at").alias("first_open_at")), "ticket_id", "left")
    out = waterfall_resolve(out, references, "order_id")
    survey = first_rows(surveys, ["ticket_id"], ["survey_id"]).select("ticket_id", "survey_id", "rating")
    out = out.join(survey, "ticket_id", "left")
    team = ladder([(F.col("group").rlike(pattern), name) for pattern, name in TEAMS])
    return out.select(
        "ticket_id", "order_id", "group", team.alias("team"), "source", F.col("first_created_at").alias("created_at"), F.col("first_first_responded_at").alias("first_response_at"),
        F.col("first_resolved_at").alias("resolved_at"), "first_open_at", boundary_diff("first_created_at", "first_resolved_at", "day").alias("days_to_resolution"),
        boundary_diff("first_created_at", "first_first_responded_at", "day").alias("days_to_first_response"),
        ladder([(F.col("rating") == code, label) for code, label in SATISFACTION.items()]).alias("satisfaction"), "linked_ticket_id", (~is_true("_merged")).alias("is_primary"),
    )


def ticket_tags(tickets: DataFrame) -> DataFrame:
    """Bracketed tag list to one row per tag, however many there are."""
    listed = tickets.filter(F.col("tags").isNotNull() & (F.col("tags") != "[]")).select("ticket_id", F.regexp_replace("tags", r"[\[\]]", "").alias("_tags"))
    return split_to_rows(listed, "_tags", ",", "tag").drop("_tags")


def ticket_interactions(messages: DataFrame, tickets: DataFrame) -> DataFrame:
    """Messages of tickets (public notes and phone tickets do not count) and the opening of each ticket.

    messages: ticket_id, message_id, created_at, source_code, category, is_private, is_incoming, agent.
    """
    talk = messages.filter(~((F.col("source_code") == 2) & (F.col("category") == 3)))
    spoken = talk.join(tickets.filter("source <> 'phone'").select("ticket_id", "source", "order_id", "team"), "ticket_id")
    kind = ladder([
        (F.col("agent") == "Dev Ops", "Dev Ops"), ((F.col("source_code") == 2) & (F.col("category") == 6), "agent reply"),
        (F.col("is_private"), "note"), (F.col("category") == 3, "agent reply"),
    ], "customer reply")
    replies = spoken.select(
        F.lit("message").alias("feed"), F.col("message_id").alias("interaction_id"), "ticket_id", "order_id", "created_at", "agent", "team", kind.alias("kind"), F.lit(False).alias("is_first"),
    )
    opening = ladder([
        (F.col("source") == "portal", "portal"),
        (((F.col("source") == "email") & F.col("is_internal_requester")) | (F.col("source") == "outbound_email"), "agent initiation"),
        (F.col("source").isin("email", "feedback_widget"), "customer initiation"),
    ])
    first = tickets.filter("source <> 'phone'").select(
        F.lit("ticket").alias("feed"), F.col("ticket_id").alias("interaction_id"), "ticket_id", "order_id", "created_at", F.lit(None).cast("string").alias("agent"), "team",
        opening.alias("kind"), F.lit(True).alias("is_first"),
    )
    return first_rows(union_all(replies, first), ["feed", "interaction_id"], ["ticket_id", "kind"])


def engagements(rows: DataFrame) -> DataFrame:
    """CRM engagements: one row per combination of the contacts, deals and companies they are linked to.

    rows: engagement_id, created_at, type, contact_ids, deal_ids, company_ids (bracketed text lists).
    """
    def ids(col: str) -> Column:
        pieces = F.split(F.regexp_replace(col, r"[\[\] ]", ""), ",")
        return F.transform(F.filter(pieces, lambda x: x != ""), lambda x: x.try_cast("bigint"))

    spread = multi_list_product(rows, {"contact_id": ids("contact_ids"), "deal_id": ids("deal_ids"), "company_id": ids("company_ids")})
    return spread.drop("contact_ids", "deal_ids", "company_ids")


def interactions_fact(ticket_side: DataFrame, crm_side: DataFrame) -> DataFrame:
    """All contacts with customers under one set of types."""
    label = ladder([(F.col("kind") == k, v) for k, v in INTERACTION_TYPES.items()])
    support = ticket_side.select(
        F.lit("support").alias("source"), "interaction_id", "order_id", "created_at", "kind", label.alias("interaction_type"), "team"
    )
    kind = F.initcap("type")
    crm = crm_side.select(
        F.lit("crm").alias("source"), F.col("engagement_id").alias("interaction_id"), F.col("deal_id").alias("order_id"), "created_at", kind.alias("kind"),
        F.when(kind == "Email", "Outgoing Email").otherwise(kind).alias("interaction_type"), F.lit(None).cast("string").alias("team"),
    )
    return support.unionByName(crm.distinct())


def interactions_per_order(interactions: DataFrame) -> DataFrame:
    known = interactions.filter(F.col("order_id").isNotNull() & (F.col("interaction_type") != "Portal"))
    mark = F.struct("source", "interaction_id")

    def n(cond: Column) -> Column:
        return F.count_distinct(F.when(cond, mark))

    support, kind = F.col("source") == "support", F.col("interaction_type")
    return known.groupBy("order_id").agg(
        F.count_distinct(mark).alias("n_interactions"), n(support).alias("n_support"), n(kind == "Outgoing Email").alias("n_outgoing"),
        n(support & (kind == "Outgoing Email")).alias("n_outgoing_support"), n(kind == "Incoming Email").alias("n_incoming"), n(support & (kind == "Note")).alias("n_notes"),
    )


def questions_fact(feeds: dict[str, DataFrame], active_documents: DataFrame) -> DataFrame:
    """Questions of several feeds on active documents, with the days until the answer.

    Each feed: question_id, document_id, order_id, submitted_at, answered_at, text.
    """
    out = None
    for kind, df in feeds.items():
        part = df.withColumn("question_type", F.lit(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    live = only_matching(out, active_documents, ["document_id"], "left_semi")
    return live.withColumns({
        "is_answered": F.col("answered_at").isNotNull(), "days_to_answer": F.round(boundary_diff("submitted_at", "answered_at", "minute") / F.lit(1440), 2),
    })


def disputes_fact(disputes: DataFrame, line_issues: DataFrame, legacy_events: DataFrame, refunds: DataFrame, remakes: DataFrame) -> DataFrame:
    """The latest dispute per order, from the dispute system or, for orders unknown there, from old event texts; with its first resolution.

    disputes: order_id, dispute_id, created_at, outcome, type; line_issues: order_id, created_at; legacy_events, refunds, remakes: order_id, at.
    """
    reported = line_issues.groupBy("order_id").agg(F.min("created_at").alias("_line_at"))
    dated = disputes.join(reported, "order_id", "left").withColumn("disputed_at", F.coalesce("_line_at", "created_at"))
    latest = first_rows(dated, ["order_id"], ["-disputed_at", "-dispute_id"]).select(
        "order_id", "dispute_id", "disputed_at", F.col("outcome").alias("requested_outcome"), F.col("type").alias("dispute_type"), F.lit("disputes").alias("system")
    )
    old = legacy_events.groupBy("order_id").agg(F.min("at").alias("disputed_at")).withColumn("system", F.lit("event texts"))
    both = latest.unionByName(only_matching(old, latest, ["order_id"], "left_anti"), allowMissingColumns=True)
    refund = refunds.groupBy("order_id").agg(F.min("at").alias("refund_at"))
    remake = remakes.groupBy("order_id").agg(F.min("at").alias("remake_at"))
    out = both.join(refund, "order_id", "left").join(remake, "order_id", "left").withColumn("resolved_at", F.least("refund_at", "remake_at"))
    how = F.when(F.col("resolved_at") == F.col("refund_at"), "refund").when(F.col("resolved_at") == F.col("remake_at"), "remake")
    return out.select(
        "order_id", "dispute_id", "disputed_at", "requested_outcome", "dispute_type", "system", "resolved_at",
        boundary_diff("disputed_at", "resolved_at", "hour").alias("hours_to_resolution"), how.alias("resolution"),
    )


def dispute_line_flags(issues: DataFrame, kinds: dict[int, str]) -> DataFrame:
    """Per line: first issue, affected quantity, a flag per kind of issue. issues: line_key, created_at, kind, quantity."""
    flags = [F.max(F.when(F.col("kind") == code, 1).otherwise(0)).alias(f"has_{name}") for code, name in kinds.items()]
    return issues.groupBy("line_key").agg(F.min("created_at").alias("disputed_at"), F.max("quantity").alias("affected_quantity"), *flags)


def complaints_fact(complaints: DataFrame, orders: DataFrame) -> DataFrame:
    """Complaints with their order and the days it took to decide them."""
    out = join_known(complaints, orders, "order_id", "complaint_id")
    return out.withColumn("days_to_decision", boundary_diff("created_at", "decided_at", "day"))
