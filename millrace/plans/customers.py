"""Customer life cycle: order history per contact, company and client, RFM, retention, cohort value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import count_when, ladder, sum_when, zero
from millrace.functions.dates import add_part, boundary_diff, day, month
from millrace.operators.aggregates import percentile_tier
from millrace.operators.keyed import attach, join_known
from millrace.operators.ordered import BEFORE, GROUP, across, carry_over, in_chunks, inside, lag_delta, lead_values, running_total
from millrace.operators.windows import first_rows
from millrace.sources.session import cut_lineage

# Segment per (recency, frequency, monetary) being high.
RFM_SEGMENTS = {
    (True, True, True): "1 Core Value",
    (True, False, True): "2 Core Development",
    (False, True, True): "3 Core Maintenance",
    (True, True, False): "4 Small Regular",
    (False, False, True): "5 Core Churn",
    (True, False, False): "6 Basic Development",
    (False, True, False): "7 Basic Maintenance",
    (False, False, False): "8 Low Value Churn",
}


def quarter_of_close() -> Column:
    return F.trunc("closed_at", "quarter")


def as_of_ts(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def entity_summary(orders: DataFrame, k: str) -> DataFrame:
    """One row per entity: first, second and latest dates, counts, totals, first technologies.

    Two aggregates over the orders: what stands alone, then what depends on the first close.
    """
    known = orders.filter(F.col(k).isNotNull())
    closed, sub = F.col("is_closed"), F.col("submitted_at").isNotNull()
    close = F.struct("closed_at", "order_id")
    basic = known.groupBy(k).agg(
        F.min("created_at").alias("became_created_at"),
        F.min("submitted_at").alias("became_opportunity_at"),
        F.min("closed_at").alias("became_customer_at"),
        F.max("created_at").alias("recent_created_at"),
        F.max("closed_at").alias("recent_closed_at"),
        F.count(F.lit(1)).alias("n_orders"),
        count_when(sub).alias("n_submitted"),
        count_when(closed).alias("n_closed"),
        F.nullif(sum_when(closed, "subtotal_cents"), F.lit(0)).alias("closed_sales_cents"),
        F.min_by("technology", F.when(sub, F.struct("submitted_at", "order_id"))).alias("first_submitted_technology"),
        F.min_by("technology", F.when(closed, close)).alias("first_closed_technology"),
        F.min(F.when(closed, close)).alias("_first"),
    )
    since = known.filter(closed).join(basic.select(k, "_first"), k)
    first_at, margin = F.col("_first.closed_at"), F.col("subtotal_cents") - F.col("cost_cents")
    early = since.groupBy(k).agg(
        F.min(F.when(close > F.col("_first"), F.col("closed_at"))).alias("second_closed_at"),
        sum_when(month("closed_at") == month(first_at), "subtotal_cents").alias("closed_sales_new_cents"),
        sum_when(F.col("closed_at") < add_part(first_at, 90, "day"), margin).alias("margin_90d_cents"),
        sum_when(F.col("closed_at") < add_part(first_at, 24, "month"), margin).alias("margin_24m_cents"),
    )
    return basic.drop("_first").join(early, k, "left")


def closed_order_numbers(orders: DataFrame, k: str) -> DataFrame:
    """Closed orders numbered per entity: rank by close time, project (distinct close day) number, days since previous.

    Numbers count inside (entity, quarter) and add what earlier quarters hold, so equal close times and
    days, which never straddle a quarter, get equal numbers.
    """
    closed = orders.filter(F.col("is_closed") & F.col(k).isNotNull()).select("order_id", k, "closed_at")
    rows = in_chunks(closed, [k], quarter_of_close())
    before = across([k]).rowsBetween(*BEFORE)
    carry = carry_over(
        rows, {"_n": F.count(F.lit(1)), "_days": F.count_distinct(day("closed_at")), "_last": F.max("closed_at")},
        {"_n": F.sum("_n").over(before), "_days": F.sum("_days").over(before), "_last": F.lag("_last").over(across([k]))},
    )
    local = rows.withColumn("_day", day("closed_at")).withColumns({
        "_previous": F.lag("closed_at").over(inside(["closed_at", "order_id"])),
        "_rank": F.rank().over(inside(["closed_at"])),
        "_project": F.dense_rank().over(inside(["_day"])),
    })
    previous = F.coalesce("_previous", "_last")
    return local.join(carry, GROUP, "left").select(
        "order_id", (F.col("_rank") + zero("_n")).alias("closed_number"), (F.col("_project") + zero("_days")).alias("project_number"),
        previous.alias("previous_closed_at"), boundary_diff(previous, "closed_at", "day").alias("days_since_previous"),
    )


def customer_lifecycle(orders: DataFrame) -> DataFrame:
    """Every order with the life-cycle facts of its contact, its company and its client."""
    base = orders.select("order_id", "contact_id", "company_id", client_id().alias("client_id"), "created_at", "closed_at")
    client = base.filter(F.col("client_id").isNotNull()).groupBy("client_id").agg(
        F.min("created_at").alias("became_created_at_client"), F.min("closed_at").alias("became_customer_at_client")
    )

    def named(df: DataFrame, k: str, suffix: str) -> DataFrame:
        return df.select(F.col(k), *[F.col(x).alias(f"{x}_{suffix}") for x in df.columns if x != k])

    out = join_known(base, client, "client_id", "order_id")
    for k, suffix in (("contact_id", "contact"), ("company_id", "company")):
        out = join_known(out, named(entity_summary(orders, k), k, suffix), k, "order_id")
        out = out.join(named(closed_order_numbers(orders, k), "order_id", suffix), "order_id", "left")
    flags = {
        f"{what}_order_is_from_new_{who}": F.coalesce(boundary_diff(f"{first}_{who}", at, "month") == 0, F.lit(False))
        for who in ("contact", "company", "client")
        for what, first, at in (("created", "became_created_at", "created_at"), ("closed", "became_customer_at", "closed_at"))
    }
    return out.withColumns(flags).drop("created_at", "closed_at")


def client_id() -> Column:
    """Company when there is one, else the contact itself."""
    return F.coalesce(
        F.md5(F.concat(F.lit("company"), F.col("company_id").cast("string"))),
        F.md5(F.concat(F.lit("contact"), F.col("contact_id").cast("string"))),
    )


def order_series(orders: DataFrame, k: str) -> DataFrame:
    """Start and first close of an entity's second and third series of orders.

    A series starts with the first order created more than 7 days after the previous series'
    first close. Each date depends on the one before, so each is one grouped pass over the distinct
    (created, closed) pairs; pairs and the dates so far are written in between, which keeps every pass a
    join and a partial aggregate that a hot entity cannot pile up in one task.
    """
    pairs = cut_lineage(orders.filter(F.col(k).isNotNull()).select(k, "created_at", "closed_at").distinct(), "series-pairs")
    out = cut_lineage(pairs.groupBy(k).agg(F.min("closed_at").alias("first_closed_at")), "series-first")

    def next_date(dates: DataFrame, name: str, candidate: str, after: Column) -> DataFrame:
        found = pairs.join(dates, k).groupBy(k).agg(F.min(F.when(F.col(candidate) > after, F.col(candidate))).alias(name))
        return cut_lineage(dates.join(found, k), name)

    previous = "first_closed_at"
    for name in ("two", "three"):
        out = next_date(out, f"series_{name}_created_at", "created_at", add_part(previous, 7, "day"))
        out = next_date(out, f"series_{name}_closed_at", "closed_at", F.col(f"series_{name}_created_at"))
        previous = f"series_{name}_closed_at"
    return out


def rfm_segments(orders: DataFrame, k: str, as_of: str) -> DataFrame:
    """Recency, frequency and monetary scores of entities with closed orders, and their segment."""
    closed = orders.filter(F.col("is_closed") & F.col(k).isNotNull())
    now = as_of_ts(as_of)
    lately = closed.filter((F.col("closed_at") >= add_part(now, -12, "month")) & (F.col("subtotal_cents") != 0))
    average = lately.agg((F.sum("subtotal_cents") / F.count(F.lit(1))).alias("aov")).scalar()
    base = closed.groupBy(k).agg(
        F.max("closed_at").alias("_recent"), F.count_distinct(day("closed_at")).alias("frequency"),
        (F.sum("subtotal_cents") / F.count(F.lit(1))).alias("monetary"),
    ).withColumn("aov", average)
    recency, frequency, monetary, aov = (F.col(x) for x in ("recency", "frequency", "monetary", "aov"))
    scored = base.withColumn("recency", boundary_diff("_recent", now, "day")).withColumns({
        "r_score": ladder([(recency <= 90, 4), (recency <= 180, 3), (recency <= 365, 2)], 1),
        "f_score": ladder([(frequency >= 4, 4)], frequency.cast("int")),
        "m_score": ladder([(monetary >= aov * 2, 4), (monetary >= aov, 3), (monetary >= aov / 2, 2), (monetary < aov / 2, 1)]),
    })
    high = [F.col(x) > 2 for x in ("r_score", "f_score", "m_score")]
    steps = [
        ((high[0] == F.lit(r)) & (high[1] == F.lit(f)) & (high[2] == F.lit(m)), name) for (r, f, m), name in RFM_SEGMENTS.items()
    ]
    return scored.select(k, "aov", "recency", "frequency", "monetary", "r_score", "f_score", "m_score", ladder(steps).alias("rfm_segment"))


def potential_tier(scores: DataFrame, k: str, snapshot: str, score: str) -> DataFrame:
    """Tier of each entity's earliest score, judged inside its snapshot."""
    tiers = percentile_tier(scores, [snapshot], score, [(0.8, "high"), (0.6, "medium")], "low")
    return first_rows(tiers, [k], [snapshot, score])


def retention_episodes(orders: DataFrame, k: str, as_of: str, gap_days: int = 365) -> DataFrame:
    """Activation and reactivation points with the churn that ended each episode."""
    closed = orders.filter(F.col("closed_at").isNotNull() & F.col(k).isNotNull()).select(k, "closed_at", "order_id")
    order = ["closed_at", "order_id"]
    around = lag_delta(closed, [k], order, {"_before": "closed_at"}, quarter_of_close())
    around = lead_values(around, [k], order, {"_after": "closed_at"}, quarter_of_close())
    until = F.coalesce("_after", as_of_ts(as_of))
    points = around.withColumns({
        "_churned_at": F.when(boundary_diff("closed_at", until, "day") > gap_days, add_part("closed_at", gap_days, "day")),
        "reactivated": F.coalesce(boundary_diff("_before", "closed_at", "day") > gap_days, F.lit(False)),
        "_first": F.col("_before").isNull(),
    }).filter(F.col("_churned_at").isNotNull() | F.col("reactivated") | F.col("_first"))
    # from here on an entity has at most a few rows per year: gaps longer than gap_days lie between them
    w = Window.partitionBy(k).orderBy(*order)
    starts = points.withColumn("_next_churn", F.lead("_churned_at").over(w)).filter(F.col("reactivated") | F.col("_first"))
    number = F.row_number().over(Window.partitionBy(k).orderBy(*order))
    latest = F.row_number().over(Window.partitionBy(k).orderBy(*[F.col(x).desc() for x in order])) == 1
    churned_at = F.coalesce("_churned_at", "_next_churn")
    return starts.select(
        k, F.when(F.col("_first"), F.col("closed_at")).alias("activated_at"), "reactivated",
        F.when(F.col("reactivated"), F.col("closed_at")).alias("reactivated_at"), churned_at.alias("churned_at"),
        churned_at.isNotNull().alias("churned"), latest.alias("is_latest"), number.alias("activation_count"),
    )


def customers_since(orders: DataFrame, contacts: DataFrame) -> DataFrame:
    """Contacts that closed an order: when they became customers and with which technology."""
    first = orders.filter("is_closed").groupBy("contact_id").agg(
        F.min("closed_at").alias("became_customer_at"), F.min_by("technology", F.struct("closed_at", "order_id")).alias("technology"),
    )
    return first.join(contacts.select("contact_id", "region", "company_id", "channel_type"), "contact_id")


def cohort_clv(orders: DataFrame, contacts: DataFrame, as_of: str) -> DataFrame:
    """24-month value of a customer by months since the first purchase, technology and region."""
    this_month = F.trunc(as_of_ts(as_of), "month")
    keys = ["technology", "region"]
    inbound = customers_since(orders, contacts).filter("channel_type <> 'outbound'")
    joined_month = month("became_customer_at")
    recent = inbound.filter((joined_month >= F.add_months(this_month, -30)) & (joined_month < this_month))
    sizes = recent.groupBy(*keys, (boundary_diff("became_customer_at", as_of_ts(as_of), "month") - 1).alias("cohort")).agg(
        F.count(F.lit(1)).alias("contacts")
    )
    oldest_first = Window.partitionBy(*keys).orderBy(F.col("cohort").desc())
    sizes = sizes.withColumn("running_contacts", F.sum("contacts").over(oldest_first.rowsBetween(-5, 0)))
    bought = orders.filter(F.col("is_sourced") & (boundary_diff("sourced_at", as_of_ts(as_of), "month") > 0))
    bought = bought.select("contact_id", "sourced_at", (F.col("subtotal_cents") - F.col("cost_cents")).alias("margin"))
    age = boundary_diff("became_customer_at", "sourced_at", "month")
    sales = bought.join(recent, "contact_id").withColumn("cohort", age)
    sales = sales.filter(month("became_customer_at") >= F.add_months(this_month, (F.lit(-6) - F.col("cohort")).cast("int")))
    sales = sales.groupBy(*keys, "cohort").agg(F.count_distinct("contact_id").alias("active"), F.sum("margin").alias("margin_cents"))
    both = attach(sizes, sales, [*keys, "cohort"]).withColumns({
        "sales_per_contact": F.col("margin_cents") / F.col("active"),
        "retention": F.col("active") / F.col("running_contacts"),
    }).withColumn("clv", F.col("retention") * F.col("sales_per_contact"))
    total = F.sum(F.col("clv") * F.lit(0.93)).over(oldest_first.rowsBetween(-23, 0))
    return both.select(
        *keys, "cohort", "running_contacts", "margin_cents", "sales_per_contact", "retention",
        F.round("clv", 2).alias("clv"), F.round(total, 2).alias("clv_24m"),
    )


def contact_type(rank: str) -> Column:
    """Freemailer, first contact of a company to become a lead, or a later one."""
    return ladder([
        (F.col("company_id").isNull(), "freemailer"), (F.col(rank) > 1, "inside_company_customer"),
    ], "first_company_customer")


def lead_ranks(contacts: DataFrame) -> DataFrame:
    """Contacts with their position among the leads of their company."""
    leads = contacts.filter(F.col("lead_at").isNotNull() & F.col("company_id").isNotNull())
    leads = leads.select("contact_id", "company_id", "lead_at").withColumn("_one", F.lit(1))
    number = running_total(leads, ["company_id"], ["lead_at", "contact_id"], "_one", "lead_number", F.trunc("lead_at", "month"))
    return attach(contacts, number.select("contact_id", "lead_number"), ["contact_id"])


def cohort_clv_90d(orders: DataFrame, contacts: DataFrame, as_of: str) -> DataFrame:
    """Margin of the first 90 days per customer, by contact type, technology and region."""
    typed = lead_ranks(contacts).select("contact_id", contact_type("lead_number").alias("contact_type"))
    who = customers_since(orders, contacts).join(typed, "contact_id")
    limit = add_part(as_of_ts(as_of), -90, "day")
    who = who.filter((F.col("became_customer_at") > add_part(limit, -24, "month")) & (F.col("became_customer_at") < limit))
    spend = orders.select("contact_id", "sourced_at", (F.col("subtotal_cents") - F.col("cost_cents")).alias("margin")).join(who, "contact_id")
    early = spend.filter(F.col("sourced_at") < add_part("became_customer_at", 90, "day"))
    sized = early.groupBy("contact_type", "technology", "region").agg(
        F.count_distinct("contact_id").alias("cohort_size"), F.sum("margin").alias("margin_cents")
    )
    return sized.withColumn("clv_90d", F.col("margin_cents") / F.col("cohort_size") * F.lit(0.93))


def lead_bid_price(contacts: DataFrame, orders: DataFrame, scores: DataFrame, as_of: str) -> DataFrame:
    """Price worth paying for a lead: predicted conversion x value of a first-month customer x a type factor."""
    # Calibration of the score, floor for unscored leads, multipliers per contact type.
    calibration, unscored = 0.81, 0.0001
    value = cohort_clv(orders, contacts, as_of).filter("cohort = 1").select("technology", "region", "clv_24m")
    leads = lead_ranks(contacts).filter(F.col("lead_at").isNotNull()).withColumn("contact_type", contact_type("lead_number"))
    wanted = orders.groupBy("contact_id").agg(F.min_by("technology", F.struct("created_at", "order_id")).alias("_tech"))
    leads = attach(leads, wanted, ["contact_id"])
    tech = F.when(F.col("_tech") == "IM", F.lit("CNC")).otherwise(F.coalesce("_tech", F.lit("3DP")))
    leads = leads.withColumn("technology", tech)
    scored = attach(leads, first_rows(scores, ["contact_id"], ["scored_at"]).select("contact_id", "predicted"), ["contact_id"])
    priced = attach(scored, value, ["technology", "region"])
    chance = F.coalesce(F.col("predicted") * F.lit(calibration), F.lit(unscored))
    factor = ladder([
        ((F.col("region") == "AMERICA") & (F.col("contact_type") == "first_company_customer"), 2.5),
        (F.col("contact_type") == "first_company_customer", 1.6),
    ], 0.67)
    return priced.select(
        "contact_id", "technology", "region", "contact_type", "clv_24m", chance.alias("conversion"),
        F.round(chance * F.col("clv_24m") * factor, 4).alias("bid_cents"),
    )
