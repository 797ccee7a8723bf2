"""The order fact and the marts shared with partners."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import is_true, ladder, zero
from millrace.functions.dates import boundary_diff
from millrace.operators.joins import wide_fact_assembly
from millrace.operators.projections import base_projection, filter_test_traffic, period_filter
from millrace.operators.sets import union_relations

SAME_DAY_RECREATION_HOURS = 48


def order_fact(orders: DataFrame, sides: list[DataFrame], legacy: DataFrame, cancellations: Mapping[str, str]) -> DataFrame:
    """One row per order from its entity-level frames, with derived status and amounts; old orders united, bot carts dropped.

    orders: order_id, contact_id, created_at, quote_status, subtotal_cents, cancel_code, is_internal; each side has one row per order_id.
    """
    wide = wide_fact_assembly(orders, "order_id", sides)
    reason = ladder([(F.col("cancel_code") == code, text) for code, text in cancellations.items()])
    recreated = is_true(boundary_diff("sourced_at", "cancelled_at", "hour") < SAME_DAY_RECREATION_HOURS) & is_true(F.col("cancellation_reason") == "New order created")
    wide = wide.withColumn("cancellation_reason", reason).withColumns({
        "is_cart": F.col("quote_status") == "cart", "submitted_at": F.when(F.col("quote_status") != "cart", F.coalesce("first_submitted_at", "created_at")),
        "is_sourced": F.col("sourced_at").isNotNull(), "_recreated": recreated,
    })
    closed = is_true("is_closed") & ~F.col("_recreated")
    sourced = F.col("is_sourced") & ~F.col("_recreated")
    production_first = is_true(F.col("production_finalized_at") < F.coalesce("shipped_at", F.lit("2100-01-01").cast("timestamp_ntz"))) & ~is_true("has_winning_bid")
    po_cost = F.when(production_first, F.col("production_cost_usd_cents")).otherwise(F.col("first_cost_usd_cents"))
    wide = wide.withColumns({
        "closed_cents": F.when(closed, F.col("subtotal_cents")).otherwise(0), "sourced_cents": F.when(sourced, F.col("subtotal_cents")).otherwise(0),
        "po_cost_usd_cents": po_cost, "supplier_id": F.coalesce("active_supplier_id", "winning_supplier_id"),
        "has_amount_gap": F.when(is_true("is_closed"), F.col("subtotal_cents") - zero("quoted_cents") - zero("shipping_line_cents") > 5000),
    }).withColumn("sourced_cost_cents", F.when(sourced, F.coalesce("po_cost_usd_cents", F.lit(0.0)) + zero("shipping_line_cents")).otherwise(F.lit(0.0)))
    kept = filter_test_traffic(wide, [F.col("is_internal")], F.col("sourced_cents") > 0)
    both = union_relations({"current": kept.drop("_recreated", "is_internal", "cancel_code", "quote_status"), "legacy": legacy}, source_col="origin")
    bots = is_true("is_cart") & F.col("contact_id").isNull() & is_true(F.col("n_lines").isNull())
    return both.filter(~bots)


def partner_share(fact: DataFrame, columns: Mapping[str, str], ts: str, years: int, as_of: str) -> DataFrame:
    """Narrow, renamed and time-limited copy of a mart for a partner."""
    return base_projection(period_filter(fact, ts, years, "year", as_of), columns)
