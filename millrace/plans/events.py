"""Event texts, deal stages, reviews and status histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ladder, sum_when
from millrace.functions.dates import boundary_diff, day
from millrace.operators.joins import interval_expand_join
from millrace.operators.ordered import lead_values, running_total
from millrace.operators.projections import classify_first_match

# Patterns of an event description and the standard event id; first match wins.
CARRIER_NOISE = "aftership|shippo"
RELEVANT = "completed|canceled an auction|dispute"
UNKNOWN_EVENT = -9
EVENT_PATTERNS = [
    ("created a new order", 100), ("created a new reorder", 101), ("completed", 102), ("order accepted", 103), ("order cancel(l?)ed", 104), ("dispute", 105),
    ("in_transit", 110), ("delivered", 111), ('changed order status to "shipped" on package', 112), ("updated order expected shipping date", 113),
    (r'moved order to "shipped_to_warehouse"(.*on|\.)', 114), (r'moved order to "shipped"(.*on|\.)', 115), ("partially shipped order", 116),
    ("created a new quote", 201), ("changing default order quote", 202), ("(quote).*(deleted)", 203), ('changed order status to "accepted"', 204),
    ("updated quote with", 205), ("cloned quote", 206), ("quote technology was updated", 207), ("accepted a counter-bid", 208), ("submitted a bid of type", 209),
    ("created an auction", 220), ("created an rfq auction", 221), ("canceled an auction", 222), ("accepted an auction", 223),
    ("submitted an rfq auction response", 224), ("uploaded a quote attachment", 230), ("deleted a quote attachment", 231),
    ("started payment process for quote", 240), ("processed pay later for", 241), ("processed payment", 242), ("requested a refund", 250), ("refunded the order", 251),
    ("archived quote", 260), ("docusign signed quote received", 270), ("created.*shipping line item", 310), ("deleted shipping line item", 311),
    ("added line item", 300), ("created a new line item", 301), ("updated.*line item", 302), ("uploaded a line item attachment", 303),
    ("deleted a line item attachment", 304), ("(deleted).*(line item)", 305), ("added first-time-offer", 900), ("cloned invoice", 910), ("updated invoice", 911),
    ("created purchase order", 920), ("cloned purchase_order", 921), ("created a new purchase order to reimburse supplier", 922),
    ("voided original purchase order to reimburse supplier", 923), ("updated purchase order with no action", 924), ("cocked purchase order", 925),
    ("created a hubspot deal", 930),
]


def order_event_classification(events: DataFrame, col: str) -> DataFrame:
    """Relevant free-text events with their standard id."""
    text = F.lower(col)
    kept = events.filter(~text.rlike(CARRIER_NOISE) & text.rlike(RELEVANT))
    return classify_first_match(kept, col, EVENT_PATTERNS, UNKNOWN_EVENT, "std_event_id")


def event_milestones(classified: DataFrame, k: str, ts: str) -> DataFrame:
    """First and last completion and first dispute and auction cancellation per order."""
    def when(event: int) -> Column:
        return F.when(F.col("std_event_id") == event, F.col(ts))

    return classified.groupBy(k).agg(
        F.min(when(102)).alias("first_completed_at"), F.max(when(102)).alias("last_completed_at"),
        F.min(when(105)).alias("first_disputed_at"), F.min(when(222)).alias("auction_canceled_at"),
    )


def stage_history(old: DataFrame, new: DataFrame, cut_over: str, chunk: Column) -> DataFrame:
    """Two stage feeds joined at a cut-over, with the next stage and the minutes spent.

    Both: deal_id, event_id, stage, changed_at. Unknown stages do not count.
    """
    at = F.lit(cut_over).cast("timestamp_ntz")
    both = old.filter(F.col("changed_at") < at).unionByName(new.filter(F.col("changed_at") >= at)).distinct()
    stated = both.filter(F.col("stage").isNotNull())
    nxt = lead_values(stated, ["deal_id"], ["changed_at", "event_id"], {"next_stage": "stage", "next_changed_at": "changed_at"}, chunk)
    return nxt.withColumn("minutes_in_stage", boundary_diff("changed_at", "next_changed_at", "minute"))


def deal_stage_timeline(history: DataFrame, orders: DataFrame) -> DataFrame:
    """Per order: when it closed and was cancelled, the first stay in 'New', resolved status."""
    left_new = (F.col("stage") == "New") & F.col("next_stage").isNotNull()
    per_deal = history.groupBy("deal_id").agg(
        F.min(F.when(F.col("stage").startswith("Won"), F.col("changed_at"))).alias("won_at"),
        F.min(F.when(F.col("stage") == "Closed - Canceled", F.col("changed_at"))).alias("cancelled_at"),
        F.min(F.when(left_new, F.struct("changed_at", "event_id", "minutes_in_stage"))).alias("_new"),
    )
    out = orders.join(per_deal, "deal_id", "left")
    closed = F.coalesce("accepted_at", "in_production_at", "won_at")
    status = F.when((F.col("crm_status") == "lost") & (F.col("supply_status") == "canceled"), F.col("crm_status"))
    return out.select(
        "order_id", "deal_id", closed.isNotNull().alias("is_closed"), closed.alias("closed_at"), "cancelled_at",
        F.col("_new.minutes_in_stage").alias("minutes_in_new"), F.coalesce(status, F.col("supply_status"), F.col("crm_status")).alias("order_status"),
    )


def review_iterations(history: DataFrame, chunk: Column) -> DataFrame:
    """Review rounds of a deal: a round starts with 'In review - New' and lasts until the next one."""
    stage = F.col("stage")
    reviews = history.filter(stage.startswith("In review"))
    started = reviews.withColumn("_new", F.when(stage.startswith("In review - New"), 1).otherwise(0))
    rounds = running_total(started, ["deal_id"], ["changed_at", "event_id"], "_new", "iteration", chunk)
    # stages before the first round belong to none
    rounds = rounds.withColumn("iteration", F.nullif("iteration", F.lit(0)))

    def first(name: str) -> Column:
        return F.min(F.when(stage.startswith(f"In review - {name}"), F.col("changed_at")))

    def total(name: str) -> Column:
        return sum_when(stage.startswith(f"In review - {name}"), "minutes_in_stage")

    out = rounds.groupBy("deal_id", "iteration").agg(
        first("New").alias("new_at"), first("Ongoing").alias("ongoing_at"), first("Completed").alias("completed_at"), first("Rejected").alias("rejected_at"),
        total("New").alias("minutes_new"), total("Ongoing").alias("minutes_ongoing"),
    )
    review_id = F.concat(F.col("deal_id").cast("string"), F.lpad(F.col("iteration").cast("string"), 2, "0")).cast("long")
    return out.select(
        review_id.alias("review_id"), "deal_id", "iteration", "new_at", "ongoing_at", F.coalesce("rejected_at", "completed_at").alias("review_completed_at"),
        F.when(F.col("rejected_at").isNotNull(), "rejected").when(F.col("completed_at").isNotNull(), "completed").alias("result"), "minutes_new", "minutes_ongoing",
    )


def reviews_per_deal(iterations: DataFrame) -> DataFrame:
    return iterations.groupBy("deal_id").agg(
        F.max("iteration").alias("n_reviews"), F.sum("minutes_new").alias("minutes_new"), F.sum("minutes_ongoing").alias("minutes_ongoing"),
        F.max("review_completed_at").alias("last_review_completed_at"),
    )


def status_history(orders: DataFrame, k: str, milestones: dict[str, str], final: list[str], as_of: str) -> DataFrame:
    """Milestone columns to status rows: each status lasts until the next milestone, an open one until as-of.

    All milestones of an order sit in one row, so the succession is an array sort inside the row: no shuffle.
    """
    names = list(milestones)
    entries = F.array(*[F.struct(day(col).alias("start"), F.lit(i).alias("i"), F.lit(name).alias("status")) for i, (name, col) in enumerate(milestones.items())])
    reached = F.array_sort(F.filter(entries, lambda e: e["start"].isNotNull()))
    rows = orders.select(k, reached.alias("_s")).select(k, "_s", F.posexplode("_s").alias("_p", "_e"))
    after = F.get(F.col("_s"), F.col("_p") + 1)["start"]
    open_end = F.when(~F.col("_e.status").isin(final), F.lit(as_of).cast("date"))
    out = rows.select(k, F.col("_e.status").alias("status"), F.col("_e.start").alias("start_date"), F.coalesce(after, open_end).alias("end_date"))
    labels = ladder([(F.col("status") == n, n.replace("_at", "")) for n in names])
    return out.withColumns({"days_in_status": F.datediff("end_date", "start_date"), "label": labels})


def status_history_daily(history: DataFrame) -> DataFrame:
    """One row per order and day in a status."""
    return interval_expand_join(history.filter("end_date is not null"), "start_date", "end_date")
