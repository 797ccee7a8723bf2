"""Contacts, companies and clients: identity, channels, leads, teams and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import is_true, ladder, page_of, split_part, url_parameter
from millrace.functions.dates import boundary_diff, day
from millrace.operators.joins import disjunctive_join
from millrace.operators.keyed import join_known
from millrace.operators.ordered import rank_in_group
from millrace.operators.sets import union_distinct
from millrace.operators.windows import first_rows
from millrace.plans.customers import client_id
from millrace.sources.session import cut_lineage

# Words in a lower-case job title, first group found wins.
JOB_ROLES = [
    ("college|faculty|fellow|graduate|lecturer|learning|student|teacher", "University"),
    ("chief|director|executive|manag|ceo|coo|c-level|owner|cto|cmo|principal|president|vp|founder|head|chairman|partner|supervisor", "Manager"),
    ("purchas|buy|procur|order", "Procurement"),
    ("engin|mech|design|technic|product|research|develop|ingénieur", "Engineer or Designer"),
]

# Channels that fold into one group.
CHANNEL_GROUPS = {
    "display": "display", "youtube": "youtube",
    "social_media": "other", "referrals": "other", "other_campaigns": "other", "email_marketing": "other",
    "branded_organic_search": "direct/brand", "direct_traffic": "direct/brand",
}


def identity_merge(contacts: DataFrame, import_since: str, outbound_list: str) -> DataFrame:
    """Contacts that share a browser token take the source attributes of the earliest of them.

    contacts: contact_id, token, created_at, first_visit_at, source, source_data_1, source_data_2, first_url.
    """
    person = F.coalesce(F.nullif("token", F.lit("")), F.col("contact_id").cast("string"))
    attributes = F.struct(
        F.lower("source").alias("source"), F.col("source_data_1").alias("data_1"), F.col("source_data_2").alias("data_2"),
        split_part("first_url", "#", 1).alias("url"), F.col("first_visit_at").alias("visit"),
    )
    keyed = contacts.withColumn("_person", person)
    first = keyed.groupBy("_person").agg(F.min_by(attributes, F.struct(F.least("first_visit_at", "created_at"), "contact_id")).alias("_a"))
    merged = keyed.join(first, "_person")
    imported = is_true(F.col("_a.source").contains("offline")) & is_true(F.lower("_a.data_1").contains("import"))
    outbound = (imported & (F.col("created_at") > F.lit(import_since).cast("timestamp_ntz"))) | (
        is_true(F.lower("_a.data_1") == "integration") & is_true(F.col("_a.data_2") == outbound_list)
    )
    return merged.select(
        "contact_id", "company_id", "country", "created_at", F.col("_a.source").alias("source"), F.col("_a.data_1").alias("source_data_1"),
        F.col("_a.data_2").alias("source_data_2"), F.col("_a.url").alias("first_url"), page_of(F.col("_a.url")).alias("first_page"),
        F.col("_a.visit").alias("first_visit_at"), F.when(outbound, "outbound").otherwise("inbound").alias("channel_type"),
    )


def channel_attribution(people: DataFrame, page_groups: DataFrame, home_country: str, tracking: dict[str, str]) -> DataFrame:
    """Marketing channel by ordered rules over source, URL and timing.

    tracking: dates 'home' and 'abroad' (nothing known before), 'first_party' (own tracking starts),
    'landing' (direct hits on the landing page become known).
    """
    at = {k: F.lit(v).cast("timestamp_ntz") for k, v in tracking.items()}
    grouped = people.join(page_groups.withColumnRenamed("page", "_page"), F.lower("first_page") == F.col("_page"), "left").drop("_page")
    group = F.coalesce("page_group", F.lit("Ungrouped"))
    url, source, created = F.col("first_url"), F.col("source"), F.col("created_at")
    wait = boundary_diff("first_visit_at", "created_at", "second")
    home = F.col("country") == home_country
    channel = ladder([
        (F.col("channel_type") == "outbound", "outbound"),
        (~is_true(home) & (created < at["abroad"]), "unknown_channel_old_row"),
        (is_true(home) & (created < at["home"]), "unknown_channel_old_home"),
        ((wait < 10) & (created < at["first_party"]), "unknown_channel_no_web_session"),
        ((wait < 0) & (created >= at["first_party"]), "unknown_channel_no_web_session"),
        ((source == "offline") & F.lower("source_data_1").isin("analytics", "api", "conversations"), "unknown_channel_no_web_session"),
        (url.contains("utm_source=youtube"), "youtube"),
        (url.contains("utm_medium=display"), "display"),
        ((source == "organic_search") & (group == "Homepage"), "branded_organic_search"),
        ((source == "direct_traffic") & url.contains("/manufacture") & (created <= at["landing"]), "unknown_channel"),
        (source.isNull(), "unknown_channel"),
    ], source)
    out = grouped.withColumn("channel", channel)
    known = ~F.col("channel").startswith("unknown_channel")
    folded = ladder([(F.col("channel") == name, label) for name, label in CHANNEL_GROUPS.items()], F.col("channel"))
    return out.select(
        "contact_id", "company_id", "created_at", "channel_type", "channel", F.when(known, folded).otherwise("unknown").alias("channel_grouped"),
        F.when(known, group).alias("first_page_grouped"), F.when(known, F.col("first_page")).alias("first_page_seen"),
        F.when(known & url.contains("?"), split_part(url, "?", 2)).alias("first_page_query"),
        F.when(known, F.col("source_data_1")).alias("drilldown_1"), F.when(known, F.col("source_data_2")).alias("drilldown_2"),
    )


def landing_page_attribution(pages: DataFrame) -> DataFrame:
    """Cohort counts by language, campaign source and test variant of the first page."""
    first = split_part(page_of(F.col("url")), "/", 2)
    language = F.when(F.lower(first).isin("js", "s3"), "en").when(F.length(first) == 2, F.lower(first)).otherwise("en")
    source = F.coalesce(url_parameter("url", "utm_source"), url_parameter("url", "ref"))
    return pages.groupBy(
        language.alias("language"), source.alias("utm_source"), url_parameter("url", "abt").alias("test_name"), url_parameter("url", "page").alias("variant")
    ).agg(F.count(F.lit(1)).alias("n_pages"))


def lead_qualification(contacts: DataFrame, legacy: DataFrame, carts: DataFrame, kept_orders: DataFrame, all_orders: DataFrame, typed_since: str) -> DataFrame:
    """Date, technology and type of the moment a contact became a qualified lead.

    contacts: contact_id, lead_at, first_url, first_cart_id; carts: contact_id, order_id, created_at, technology, platform;
    kept_orders / all_orders: order_id (kept = with contents; all = every cart still stored).
    """
    first_cart = first_rows(carts, ["contact_id"], ["created_at", "order_id"]).select(
        "contact_id", F.col("created_at").alias("cart_at"), "technology", "platform", F.lit(True).alias("has_cart")
    )
    mark = F.lit(True)
    kept = kept_orders.select(F.col("order_id").alias("_kept"), mark.alias("in_kept"))
    stored = all_orders.select(F.col("order_id").alias("_stored"), mark.alias("in_all"))
    out = contacts.join(legacy, "contact_id", "left").join(first_cart, "contact_id", "left")
    out = join_known(out, kept.withColumnRenamed("_kept", "first_cart_id"), "first_cart_id", "contact_id")
    out = join_known(out, stored.withColumnRenamed("_stored", "first_cart_id"), "first_cart_id", "contact_id")
    lead = F.least("first_upload_at", "lead_at", "cart_at")
    has_first = F.col("first_cart_id").isNotNull()
    url = F.lower("first_url")
    kind = ladder([
        (is_true(url.contains("shallow")), F.lit("shallowlink")), (is_true(url.contains("quicklink")), F.lit("quicklink")),
        (F.col("platform").isNotNull(), F.col("platform")), (is_true("has_cart"), F.lit("cart")),
        (has_first & F.col("in_kept").isNull() & F.col("in_all").isNotNull(), F.lit("deleted_cart")),
        (has_first & F.col("in_all").isNull(), F.lit("empty_cart")),
    ], "unknown_cart_details")
    since = F.lit(typed_since).cast("timestamp_ntz")
    return out.select("contact_id", lead.alias("lead_date"), "technology", F.when(lead >= since, kind).otherwise("legacy").alias("lead_type"))


def team_membership(users: DataFrame, invites: DataFrame) -> DataFrame:
    """Team of each user with the invitation that led there; an accepted invitation hides all others.

    users: contact_id, email, team_id, team_created_at; invites: email, team_id, status, invited_at, updated_at.
    """
    accepted = invites.filter("status = 'Accepted'").groupBy("email").agg(F.min("invited_at").alias("a_at"), F.min("updated_at").alias("a_updated"))
    waiting = invites.filter(F.col("status").isin("Pending", "Revoked")).join(accepted.select("email"), "email", "left_anti")
    other = waiting.groupBy("email", F.col("team_id").alias("o_team"), F.col("team_created_at").alias("o_created")).agg(
        F.min("invited_at").alias("o_at"), F.max("status").alias("o_status")
    )
    out = users.join(accepted, "email", "left").join(other, "email", "left")
    team = F.coalesce("team_id", "o_team")
    out = out.filter(F.col("team_created_at").isNotNull() | F.col("o_created").isNotNull())
    accepted_status = F.when(F.col("a_at").isNotNull(), "accepted")
    return out.groupBy("contact_id", team.alias("team_id"), F.coalesce("team_created_at", "o_created").alias("team_created_at")).agg(
        F.coalesce(F.min("a_at"), F.min("o_at")).alias("invited_at"), F.min("a_updated").alias("accepted_at"),
        F.lower(F.coalesce(F.min(accepted_status), F.min("o_status"))).alias("invite_status"),
    )


def inside_numbers(contacts: DataFrame, dates: dict[str, str]) -> DataFrame:
    """Position of each contact inside its company by several dates: out -> date column. One ranking for all."""
    dated = contacts.filter(F.col("company_id").isNotNull()).select(
        "contact_id", "company_id", F.inline(F.array(*[F.struct(F.lit(out).alias("what"), F.col(col).alias("at")) for out, col in dates.items()]))
    )
    ranked = rank_in_group(dated.filter("at is not null"), ["company_id", "what"], "at", "n", F.trunc("at", "quarter"))
    return ranked.groupBy("contact_id").agg(*[F.max(F.when(F.col("what") == out, F.col("n"))).alias(out) for out in dates])


def contact_dimension(contacts: DataFrame, channels: DataFrame, orders_summary: DataFrame, leads: DataFrame) -> DataFrame:
    """One row per contact: attributes, role, channel, lead, orders and the position inside the company."""
    cols = ["became_opportunity_at", "became_customer_at", "n_submitted", "n_closed", "closed_sales_cents", "first_closed_technology"]
    facts = leads.select("contact_id", "lead_date", "lead_type").join(orders_summary.select("contact_id", *cols), "contact_id", "full")
    # the hub of this plan: used by the company ranking and by the output, so it is computed once
    base = cut_lineage(contacts.join(facts, "contact_id", "left"), "contact-base")
    numbers = inside_numbers(base, {
        "inside_lead_number": "lead_date", "inside_opportunity_number": "became_opportunity_at", "inside_customer_number": "became_customer_at",
    })
    out = base.join(channels.select("contact_id", "channel", "channel_grouped", "first_page_grouped"), "contact_id", "left")
    out = out.join(numbers, "contact_id", "left")
    title = F.lower("job_title")
    role = F.when(title.isNotNull(), ladder([(title.rlike(p), label) for p, label in JOB_ROLES], "Other"))
    first = {name: F.when(F.col("company_id").isNull(), F.lit(1)).otherwise(F.col(name)) for name in numbers.columns if name != "contact_id"}
    return out.withColumns(first | {"job_role": role, "is_part_of_company": F.col("company_id").isNotNull(), "client_id": client_id()})


def company_dimension(contact_dim: DataFrame, orders_summary: DataFrame, retention: DataFrame, rfm: DataFrame) -> DataFrame:
    """One row per company from its contacts (counts, oldest contact's attributes), orders, retention and RFM."""
    inside = contact_dim.filter(F.col("company_id").isNotNull())
    age = F.struct("created_at", "contact_id")
    lead = F.struct("lead_date", "contact_id")
    people = inside.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("n_contacts"), F.max("inside_lead_number").alias("n_inside_leads"), F.max("inside_customer_number").alias("n_inside_customers"),
        F.min("lead_date").alias("became_lead_at"),
        F.min_by("lead_type", F.when(F.col("lead_type").isNotNull() & F.col("lead_date").isNotNull(), lead)).alias("lead_type"),
        F.min_by("country", F.when(F.col("country").isNotNull(), age)).alias("country"),
        F.min_by(F.struct("channel", "channel_grouped", "first_page_grouped"), age).alias("_oldest"),
    )
    cols = ["became_opportunity_at", "became_customer_at", "recent_closed_at", "n_submitted", "n_closed", "closed_sales_cents", "second_closed_at"]
    latest = retention.filter("is_latest").select("company_id", F.col("churned").alias("is_churned"), "churned_at", "activation_count")
    out = people.join(orders_summary.select("company_id", *cols), "company_id", "left").join(latest, "company_id", "left")
    out = out.join(rfm.select("company_id", "r_score", "f_score", "m_score", "rfm_segment"), "company_id", "left")
    return out.select("*", "_oldest.*").drop("_oldest")


def client_dimension(contact_dim: DataFrame, company_dim: DataFrame) -> DataFrame:
    """Contacts without company and companies, under one client id."""
    cols = ["became_opportunity_at", "became_customer_at", "n_submitted", "n_closed", "closed_sales_cents", "channel", "channel_grouped"]
    alone = contact_dim.filter(~F.col("is_part_of_company")).select(
        "client_id", "contact_id", F.lit(None).cast("long").alias("company_id"), F.lit("contact").alias("type"), *cols
    )
    companies = company_dim.select(
        F.md5(F.concat(F.lit("company"), F.col("company_id").cast("string"))).alias("client_id"), F.lit(None).cast("long").alias("contact_id"), "company_id",
        F.lit("company").alias("type"), *cols,
    )
    return union_distinct(alone, companies)


def user_and_supplier_dims(users: DataFrame, addresses: DataFrame, suppliers: DataFrame, supplier_users: DataFrame, regions: DataFrame, as_of: str) -> DataFrame:
    """Users with their latest address and activity; suppliers with their first user and region; one frame of parties."""
    now = F.lit(as_of).cast("timestamp_ntz")
    address = first_rows(addresses, ["party_id"], ["-created_at", "-address_id"]).select("party_id", "company_name", "postal_code")
    people = users.join(address, "party_id", "left").join(regions, "nation_id", "left")
    ago = boundary_diff("last_sign_in_at", now, "day")
    people = people.select(
        F.lit("user").alias("party"), "party_id", "name", "company_name", "postal_code", "market", ago.alias("days_since_sign_in"),
        (~is_true(ago >= 365)).alias("is_active"),
    )
    first_user = first_rows(supplier_users, ["party_id"], ["created_at", "user_id"]).select("party_id", "last_sign_in_at", "is_internal")
    firms = suppliers.join(first_user, "party_id", "left").filter(~is_true("is_internal")).join(regions, "nation_id", "left")
    firms = firms.select(
        F.lit("supplier").alias("party"), "party_id", F.initcap(F.lower("name")).alias("name"), F.lit(None).cast("string").alias("company_name"),
        F.lit(None).cast("string").alias("postal_code"), "market", ago.alias("days_since_sign_in"), (~is_true(ago >= 365)).alias("is_active"),
    )
    return people.unionByName(firms)


def ad_click_attribution(contacts: DataFrame, clicks: DataFrame, keywords: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign, keyword and ad group of a contact: by click id, else by keyword ids, else by campaign ids.

    contacts: contact_id, click_ref, source, group_1, group_2, keyword_1, keyword_2, campaign_1, campaign_2, first_visit_at, device.
    The OR conditions become one equi join per alternative; the first alternative that matches wins.
    """
    click = first_rows(clicks, ["click_id"], ["clicked_at", "campaign_id"]).select(
        F.col("click_id").alias("click_ref"), F.struct("campaign_id", "keyword_id", "group_id", "clicked_at", "device").alias("c")
    )
    out = join_known(contacts, click, "click_ref", "contact_id")

    def combined(*cols: str) -> Column:
        parts = [F.col(x).cast("string") for x in cols]
        return F.when(F.col("c").isNull(), F.concat_ws("|", *parts)) if cols else F.lit(None)

    def complete(*cols: str) -> Column:
        whole = F.lit(True)
        for x in cols:
            whole = whole & F.col(x).isNotNull()
        return whole

    keyed = keywords.select(
        F.concat_ws("|", "source", F.col("group_id").cast("string"), F.col("keyword_id").cast("string")).alias("_kw"),
        F.col("campaign_id").alias("k_campaign"), F.col("keyword_id").alias("k_keyword"), F.col("group_id").alias("k_group"), F.col("campaign_group").alias("k_name"),
    )
    options = []
    for g in ("group_1", "group_2"):
        for kw in ("keyword_1", "keyword_2"):
            name = f"_on_{g}_{kw}"
            out = out.withColumn(name, F.when(complete("source", g, kw), combined("source", g, kw)))
            options.append((name, "_kw"))
    out = disjunctive_join(out, keyed, options, ["k_campaign", "k_keyword", "k_group", "k_name"])
    named = campaigns.select(
        F.concat_ws("|", "source", F.col("campaign_id").cast("string")).alias("_cp"), F.col("campaign_id").alias("m_campaign"), F.col("campaign_group").alias("m_name")
    )
    by_click = F.concat(F.lit("adwords|"), F.col("c.campaign_id").cast("string"))
    unknown = F.col("k_keyword").isNull()
    out = out.withColumns({
        "_cp0": by_click,
        "_cp1": F.when(unknown & complete("source", "campaign_1"), combined("source", "campaign_1")),
        "_cp2": F.when(unknown & complete("source", "campaign_2"), combined("source", "campaign_2")),
    })
    out = disjunctive_join(out, named, [("_cp0", "_cp"), ("_cp1", "_cp"), ("_cp2", "_cp")], ["m_campaign", "m_name"])
    group = F.coalesce("m_name", "k_name")
    detailed = (F.col("keyword_1").isNotNull()) & (F.coalesce(group, F.lit("")) != "Display")
    device = F.lower(F.coalesce("c.device", "device"))
    kind = ladder([
        (device.rlike("desktop|computer|^c$"), "Desktop"), (device.rlike("tablet|^t$"), "Tablet"), (device.rlike("mobile|^m$"), "Mobile"),
    ], device)
    return out.select(
        "contact_id", "source", F.coalesce("c.campaign_id", "k_campaign", "m_campaign").alias("campaign_id"), group.alias("campaign_group"),
        F.when(detailed, F.coalesce("c.keyword_id", "k_keyword")).alias("keyword_id"), F.when(detailed, F.coalesce("c.group_id", "k_group")).alias("group_id"),
        day(F.coalesce("c.clicked_at", "first_visit_at")).alias("click_date"), kind.alias("device"),
    )
