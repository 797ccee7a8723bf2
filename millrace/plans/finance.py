"""Invoices, contribution margin, payments and billing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import count_when, is_true, ladder, sum_when, zero
from millrace.functions.dates import add_part, day
from millrace.operators.joins import fx_convert, semi_join
from millrace.plans.documents import recognition_day


def recognition(orders: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Revenue recognition date per order: the earlier of completion and a plausible delivery, unless listed."""
    listed = exceptions.select("order_id", F.col("recognized_at").alias("_listed"))
    delivered = F.when(F.col("shipped_at") > F.col("delivered_at"), F.col("completed_at")).otherwise(F.col("delivered_at"))
    return orders.join(listed, "order_id", "left").withColumn(
        "recognized_at", F.coalesce("_listed", F.least(delivered, F.col("completed_at")))
    ).drop("_listed")


def invoices_from_two_systems(old: DataFrame, new: DataFrame, rates: DataFrame, switch: str) -> DataFrame:
    """Old system's invoices before the switch day and the new system's from it on.

    The old one divides by the rate of the day; the new one takes the previous day's rate and treats an unknown
    rate as 1; credit memos count negative.
    """
    at = F.lit(switch).cast("timestamp_ntz")
    before = fx_convert(old.filter(F.col("created_at") < at), rates, "subtotal_cents", "currency", F.col("finalized_at"), "usd_cents")
    before = before.filter(F.col("finalized_at").isNotNull()).withColumn("remaining_cents", F.lit(None).cast("long"))
    after = new.filter(F.col("created_at") >= at).withColumn(
        "subtotal_cents", F.when(F.col("is_credit"), -F.col("subtotal_cents")).otherwise(F.col("subtotal_cents"))
    )
    after = fx_convert(after, rates, "subtotal_cents", "currency", add_part("created_at", -1, "day"), "_usd")
    after = after.withColumn("usd_cents", F.coalesce("_usd", F.col("subtotal_cents").cast("double")))
    cols = ["invoice_id", "order_id", "created_at", "status", "currency", "subtotal_cents", "usd_cents", "remaining_cents"]
    return before.select(*cols, F.lit("old").alias("system")).unionByName(after.select(*cols, F.lit("new").alias("system")))


def invoice_recognition(invoices: DataFrame, orders: DataFrame, exceptions: DataFrame, cut_over: str) -> DataFrame:
    """Invoices with the day their revenue is recognised."""
    listed = exceptions.select("invoice_id", F.col("recognized_at").alias("_listed"))
    joined = invoices.join(orders.select("order_id", "completed_at", "recognized_at"), "order_id", "left").join(listed, "invoice_id", "left")
    rule = recognition_day("created_at", "completed_at", "recognized_at", cut_over)
    when = F.coalesce("_listed", F.when(F.col("status") != "processing", day(rule).cast("timestamp_ntz")))
    return joined.select(*invoices.columns, when.alias("revenue_recognized_at"), when.isNotNull().alias("is_recognized"))


def contribution_margin(increments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Ledger of recognised costs (negative) and revenues."""
    cost = increments.filter("is_recognized").select(
        F.col("doc_id").alias("source_id"), F.lit("cost").alias("type"), "order_id",
        day("cost_recognized_at").alias("recognized_date"), (-F.col("cost_usd_cents")).alias("usd_cents"),
    )
    revenue = invoices.filter("is_recognized").select(
        F.col("invoice_id").alias("source_id"), F.lit("revenue").alias("type"), "order_id",
        day("revenue_recognized_at").alias("recognized_date"), "usd_cents",
    )
    return cost.unionByName(revenue)


def margin_per_order(ledger: DataFrame) -> DataFrame:
    cents = F.round("usd_cents", 0).cast("long")
    return ledger.withColumn("c", cents).groupBy("order_id").agg(
        F.coalesce(sum_when(F.col("type") == "cost", "c"), F.lit(0)).alias("cost_cents"),
        F.coalesce(sum_when(F.col("type") == "revenue", "c"), F.lit(0)).alias("revenue_cents"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("margin_cents"),
    )


def payment_label(orders: DataFrame, invoices: DataFrame, payments: DataFrame, available_from: str) -> DataFrame:
    """State of an order's payments from its invoice and credit balances, and how it was paid."""
    bill, memo = ~F.col("is_credit"), F.col("is_credit")
    balance = invoices.groupBy("order_id").agg(
        count_when(is_true("is_downpayment")).alias("n_downpayments"),
        (zero(sum_when(bill, "remaining_cents")) - zero(sum_when(memo, "unapplied_cents"))).alias("remaining"),
        zero(sum_when(bill, "subtotal_cents")).alias("invoiced"), (-zero(sum_when(memo, "subtotal_cents"))).alias("credited"),
    )
    paid = payments.filter("status <> 'new'").groupBy("order_id").agg(
        F.max("created_at").alias("paid_at"),
        F.max(F.when((F.col("status") != "failed") & (F.col("type") == "payment"), F.col("method"))).alias("method"),
        F.bool_or(F.col("status").isin("successful", "refunded") & (F.col("type") == "payment")).alias("success"),
        count_when((F.col("status") == "failed") & (F.col("type") == "payment")).alias("n_failed"),
    )
    out = orders.join(balance, "order_id", "left").join(paid, "order_id", "left")
    remaining, invoiced, credited = zero("remaining"), zero("invoiced"), zero("credited")
    net, subtotal, down = invoiced + credited, F.col("subtotal_cents"), zero("n_downpayments")
    settled = remaining == 0
    # The labels, in the order in which they are tried.
    label = ladder([
        (F.col("created_at") < F.lit(available_from).cast("timestamp_ntz"), "Not Available"),
        (invoiced == 0, "Not yet invoiced"),
        (settled & (invoiced == F.abs(credited)), "Fully Refunded"),
        (settled & (net >= subtotal), "Fully Paid"),
        (remaining < 0, "Credit on Account / Awaiting Refund"),
        ((down > 0) & settled & (net > 0) & (down == 1), "First Downpayment Paid"),
        ((down > 0) & settled & (net < subtotal), "Issued invoices have been paid"),
        ((down == 1) & (remaining > 0), "First Dowpayment Invoice Awaiting Payment"),
        ((down > 0) & (remaining > 0), "Awaiting Payment"),
        (down > 0, "other"),
        (settled & (net < subtotal), "Paid and Partially Refunded/Credit Applied"),
        ((remaining > 0) & (net > remaining), "Partial Amount Outstanding"),
        ((remaining > 0) & (net < subtotal), "Awaiting Payment and Partially Credited"),
        ((remaining > 0) & (net >= subtotal), "Awaiting Payment"),
    ], "other")
    success = is_true("success")
    instant = success & is_true(day("paid_at") == day("closed_at")) & is_true(F.col("method") != "bank transfer")
    return out.select(
        "order_id", remaining.alias("remaining_cents"), invoiced.alias("invoiced_cents"), credited.alias("credited_cents"), down.alias("n_downpayments"),
        label.alias("payment_label"), success.alias("is_auto_payment"), instant.alias("is_instant_payment"),
        F.coalesce("method", F.lit("manual")).alias("payment_method"), zero("n_failed").alias("n_failed_payments"),
    )


def sales_order_billing(sales_orders: DataFrame, orders: DataFrame, rates: DataFrame, test_orders: DataFrame, system_start: str) -> DataFrame:
    """Billing and billable status of sales orders; the previous day's rate applies."""
    real = sales_orders.join(test_orders, "order_id", "left_anti")
    valued = fx_convert(real, rates, "subtotal_cents", "currency", add_part("created_at", -1, "day"), "_usd")
    joined = valued.join(orders.select("order_id", "recognized_at"), "order_id", "left")
    start = F.lit(system_start).cast("timestamp_ntz")
    fulfilled, recognised, billed = F.col("fulfilled_at"), F.col("recognized_at"), F.col("status") == "Billed"
    billable = ladder([
        (billed, "Billed"),
        (fulfilled > start, "Eligible for invoicing"),
        (fulfilled.isNull() & (recognised > start), "Eligible for invoicing not fulfilled"),
        (fulfilled.isNull() & recognised.isNull(), "Not fulfilled not Eligible for invoicing"),
        (recognised < start, "before this system"),
    ], "Other")
    status = ladder([(F.col("status") == "Pending Approval", "Pending Billing"), (F.col("status") == "Closed", "Cancelled")], F.col("status"))
    return joined.select(
        "sales_order_id", "order_id", "subtotal_cents", F.coalesce("_usd", F.col("subtotal_cents").cast("double")).alias("usd_cents"),
        status.alias("billing_status"), billable.alias("billable_status"),
    )


def billing_terms(companies: DataFrame, settings: DataFrame) -> DataFrame:
    """Companies with parent/child type, number of children and platform payment settings."""
    children = companies.filter(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("company_id")).agg(F.count(F.lit(1)).alias("n_children"))
    out = companies.join(children, "company_id", "left").join(settings, "company_id", "left")
    return out.withColumn("company_type", F.when(F.col("parent_id").isNull(), "Parent").otherwise("Child"))


def discounts_fact(discount_lines: DataFrame, lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Discount lines of orders that have a document beyond the cart."""
    real = semi_join(lines, documents.filter("status <> 'cart'").select(F.col("order_id").alias("_o")), [("order_id", "_o")])
    out = discount_lines.join(real.select("line_id", "order_id"), "line_id")
    return out.withColumns({"has_discount": F.lit(True), "has_discount_code": F.col("code_id").isNotNull()})


def co2_estimate(lines: DataFrame, electricity: DataFrame, materials: DataFrame, logistics: DataFrame) -> DataFrame:
    """Grams of CO2 per order: machining (removed volume), raw material, and logistics.

    Fixed values: 0.33 kWh per removed cm3; material factors are per kilogram, weights in grams.
    """
    known = lines.join(electricity, "country", "left").join(materials, ["country", "material"], "left")
    machining = F.round((F.col("box_cm3") - F.col("volume_cm3")) * 0.33 * F.col("grid"), 0).cast("long")
    procurement = F.round(F.col("density") * F.col("box_cm3") * F.col("per_kg") * 0.001, 0).cast("long")
    valued = known.withColumns({"_m": machining, "_p": procurement}).filter("_m > 0")
    per_order = valued.groupBy("order_id").agg(F.sum("_m").alias("manufacturing_g"), F.sum("_p").alias("procurement_g"))
    return per_order.join(logistics, "order_id", "left")
