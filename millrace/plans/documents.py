"""Quotes, purchase orders and their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import count_when, half_even, is_true, ladder, sum_when, zero
from millrace.functions.dates import boundary_diff
from millrace.operators.joins import fx_convert, fx_convert_effective_date
from millrace.operators.keyed import attach
from millrace.operators.ordered import lag_delta, rank_in_group
from millrace.sources.session import cut_lineage

# Lead-time limits in days and the sourcing window in hours that goes with them.
SOURCING_WINDOWS = [(5, 6), (10, 15), (15, 24), (20, 32)]
LONGEST_WINDOW = 42


def line_item_rollup(lines: DataFrame, k: str) -> DataFrame:
    """Per document: counts, strict sums, flags, edit status, label lists and the leading line.

    lines: k, type, line_number, title, material, process, quantity, weight_g, volume_cm3, price_cents, manually_edited,
    has_note. Label lists use the distinct titles of a catalogue, so they stay short.
    """
    part, edited = F.col("type") == "part", F.col("manually_edited")

    def strict(value: str) -> Column:
        return F.when(count_when(part) == F.count(F.when(part, F.col(value))), sum_when(part, value))

    hits = count_when(part & edited)
    lead = F.struct((-F.col("quantity")).alias("q"), (-F.col("price_cents")).alias("p"), F.col("line_number").alias("n"), F.col("title").alias("t"))
    grouped = lines.groupBy(k).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("price_cents").alias("subtotal_cents"), count_when(part).alias("n_parts"),
        F.sum(F.when(part, F.col("quantity"))).alias("total_quantity"),
        strict("weight_g").alias("total_weight_g"), strict("volume_cm3").alias("total_volume_cm3"),
        F.when(hits == count_when(part), "all").when(hits > 0, "some").otherwise("none").alias("edited_status"), hits.alias("n_edited"),
        sum_when(part, "price_cents").alias("parts_cents"),
        F.sum(F.when(F.col("type") == "shipping", F.col("price_cents")).otherwise(0)).alias("shipping_cents"),
        F.sum(F.when(F.col("type") == "surcharge", F.col("price_cents")).otherwise(0)).alias("other_cents"),
        F.bool_or(F.when(part, is_true("has_note"))).alias("has_note"),
        F.min(F.when(part, lead)).alias("_lead"),
    )
    parts = lines.filter(part)
    counts = parts.groupBy(k).agg(F.count_distinct("material").alias("n_materials"), F.count_distinct("process").alias("n_processes"))
    titles = parts.select(k, "title").distinct().groupBy(k).agg(F.array_join(F.array_sort(F.collect_list("title")), ", ").alias("titles"))
    # the three groupings share the key, so these joins need no further shuffle
    joined = grouped.join(counts, k, "left").join(titles, k, "left")
    return joined.withColumn("leading_title", F.col("_lead.t")).drop("_lead")


def line_item_fact(lines: DataFrame, heads: DataFrame, rates: DataFrame, cut_over: str) -> DataFrame:
    """Price per line by the first price source that is known, in document currency and US dollars.

    lines carry manual_cents, auto_cents, unit_cents, tooling_cents, multiplier_pct, type; heads the dates and currency.
    """
    order = ["order_id", "type"]
    joined = lines.join(heads.select("doc_id", "currency", "created_at", "finalized_at", "closed_at"), "doc_id", "left")
    quantity = F.coalesce(F.nullif("quantity", F.lit(0)), F.lit(1))
    per_unit = F.col("auto_cents") * F.col("multiplier_pct") / (quantity * 100)
    price = ladder([
        (F.col("manual_cents").isNotNull(), F.col("manual_cents").cast("double")),
        ((F.col("type") != "part") & F.col("auto_cents").isNotNull(), F.col("auto_cents").cast("double")),
        (F.col("unit_cents").isNotNull(), (F.col("unit_cents") * quantity + zero("tooling_cents")).cast("double")),
    ], half_even(per_unit) * quantity)
    priced = joined.withColumn("price", price / F.lit(100))
    rule = ladder([
        (F.col("closed_at") >= F.lit(cut_over).cast("timestamp_ntz"), F.col("closed_at")),
        (F.col("finalized_at").isNotNull(), F.col("finalized_at")),
    ], F.col("created_at"))
    out = fx_convert_effective_date(priced, rates, "price", "currency", rule, "price_usd")
    edited = F.col("unit_cents").isNotNull() | F.col("manual_cents").isNotNull()
    return out.select(
        *order, "doc_id", "line_number", "part_id", "supplier_id", "cents", "quantity", "price", "rate_date", "price_usd", edited.alias("manually_edited"),
    )


def document_versions(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """Per order: first and main quote, quote totals, first, active and production purchase order.

    One pass picks what needs no other row, a second one judges purchase orders against the first.
    """
    valued = fx_convert(docs, rates, "subtotal_cents", "currency", F.col("finalized_at"), "usd_cents")
    quote, po = F.col("doc_type") == "quote", F.col("doc_type") == "purchase_order"
    final = po & F.col("finalized_at").isNotNull()
    latest = F.struct(F.coalesce("finalized_at", F.lit("0001-01-01").cast("timestamp_ntz")).alias("f"), "doc_id", "supplier_id", "usd_cents")
    fields = F.struct("finalized_at", "doc_id", "supplier_id", "usd_cents")
    one = valued.groupBy("order_id").agg(
        F.min(F.when(quote, F.struct("created_at", "doc_id", "is_admin"))).alias("q1"),
        F.max(F.when(quote, F.struct("revision", "doc_id", "created_at", "finalized_at"))).alias("q"),
        F.min(F.when(quote, F.col("finalized_at"))).alias("first_submitted_at"),
        F.max(F.when(quote, F.col("revision"))).alias("n_quote_versions"),
        F.bool_or(F.when(quote, F.col("is_admin"))).alias("has_admin_quote"),
        count_when(po).alias("n_purchase_orders"),
        F.min(F.when(final, fields)).alias("p1"),
        F.max(F.when(po & F.col("is_active"), latest)).alias("pa"),
    )
    judged = valued.filter(final).join(one.select("order_id", "p1"), "order_id", "left")
    days = boundary_diff("p1.finalized_at", "finalized_at", "day")
    # Days after sourcing within which a purchase order still counts as production.
    in_time = F.when(F.col("technology_id") == 2, days <= 2).otherwise(days <= 7) | (F.col("p1.doc_id") == F.col("doc_id"))
    two = judged.filter(in_time).groupBy("order_id").agg(F.max(fields).alias("pp"))
    lead = boundary_diff("q.created_at", "q.finalized_at", "day")
    out = one.join(two, "order_id", "left")
    return out.select(
        "order_id", F.col("q1.doc_id").alias("first_quote_id"), F.col("q1.is_admin").alias("first_quote_by_admin"),
        F.col("q.doc_id").alias("main_quote_id"), ladder([(lead <= days_, hours) for days_, hours in SOURCING_WINDOWS], LONGEST_WINDOW).alias("sourcing_window"),
        "first_submitted_at", "n_quote_versions", "has_admin_quote", "n_purchase_orders",
        F.col("p1.doc_id").alias("first_po_id"), F.col("p1.finalized_at").alias("sourced_at"), F.col("p1.supplier_id").alias("first_supplier_id"),
        F.col("p1.usd_cents").alias("first_cost_usd_cents"), F.col("pa.doc_id").alias("active_po_id"), F.col("pa.supplier_id").alias("active_supplier_id"),
        F.col("pp.doc_id").alias("production_po_id"), F.col("pp.finalized_at").alias("production_finalized_at"),
        F.col("pp.usd_cents").alias("production_cost_usd_cents"),
        is_true(F.col("p1.supplier_id") != F.col("pa.supplier_id")).alias("is_resourced"),
    )


def quote_lines(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """Lines of each order's main quote with the cost of the same line on its first active purchase order."""
    main = heads.filter("doc_type = 'quote'").groupBy("order_id").agg(F.max(F.struct("revision", "doc_id")).alias("_m"))
    quoted = lines.join(main.select(F.col("_m.doc_id").alias("doc_id")), "doc_id", "left_semi")
    cost = po_lines(lines).groupBy("order_id", "line_number").agg(F.min("cents").alias("cost_cents"))
    return quoted.join(cost, ["order_id", "line_number"], "left")


def po_lines(lines: DataFrame) -> DataFrame:
    """Lines of the first active purchase order of each order."""
    active = lines.filter("doc_type = 'purchase_order' and is_active")
    first = active.groupBy("order_id").agg(F.min("doc_id").alias("doc_id"))
    return active.join(first.select("doc_id"), "doc_id", "left_semi")


def reorder_detection(lines: DataFrame, identity: list[str], order: str, at: str, chunk: Column) -> DataFrame:
    """Lines of parts that a client ordered more than once, numbered by time; later ones are re-orders."""
    lines = cut_lineage(lines, "reorder-lines")
    distinct_orders = lines.select(*identity, order).distinct().groupBy(*identity).agg(F.count(F.lit(1)).alias("n_orders"))
    repeated = attach(lines, distinct_orders.filter("n_orders > 1"), identity, "inner").drop("n_orders")
    ranked = rank_in_group(repeated, identity, at, "rank", chunk)
    return ranked.withColumn("is_reorder", F.col("rank") > 1)


def purchase_order_increments(docs: DataFrame, orders: DataFrame, rates: DataFrame, exceptions: DataFrame, as_of: str, cut_over: str, chunk: Column | None) -> DataFrame:
    """Cost added by each successive purchase order of an order, and the day the cost is recognised.

    ``chunk`` of ``finalized_at`` spreads an order over tasks; None where the documents are dealt by order already, which then stay where they are.
    """
    pos = docs.filter("doc_type = 'purchase_order'")
    joined = pos.join(orders.select("order_id", "recognized_at", "completed_at", "delivered_at"), "order_id", "left")
    rule = ladder([
        ((F.col("recognized_at") >= F.lit(cut_over).cast("timestamp_ntz")) & (F.col("created_at") <= F.col("recognized_at")), F.col("recognized_at")),
        (F.col("created_at") <= F.col("delivered_at"), F.col("delivered_at")),
    ], F.col("created_at"))
    valued = fx_convert_effective_date(joined, rates, "subtotal_cents", "currency", rule, "usd_cents")
    steps = lag_delta(valued, ["order_id"], ["finalized_at", "doc_id"], {"_cents": "subtotal_cents", "_usd": "usd_cents", "_doc": "doc_id"}, chunk)
    listed = exceptions.select("doc_id", F.col("recognized_at").alias("_listed"))
    steps = steps.join(listed, "doc_id", "left")
    active = pos.groupBy("order_id").agg(F.bool_or("is_active").alias("_active"))
    steps = steps.join(active, "order_id", "left")
    day = recognition_day("finalized_at", "completed_at", "recognized_at", cut_over, as_of)
    recognised = F.coalesce("_listed", F.when(F.col("_active"), day))
    first = F.col("_doc").isNull()
    return steps.select(
        "order_id", "doc_id", "finalized_at", "currency", "rate_date",
        (F.col("subtotal_cents") - F.when(first, 0).otherwise(F.col("_cents"))).alias("cost_cents"),
        (F.col("usd_cents") - F.when(first, 0).otherwise(F.col("_usd"))).alias("cost_usd_cents"),
        recognised.alias("cost_recognized_at"), recognised.isNotNull().alias("is_recognized"),
    )


def recognition_day(dated: str, completed: str, recognized: str, cut_over: str, as_of: str | None = None) -> Column:
    """Before the cut-over: the later of document and completion (both past, when as_of is given).
    After it: the later of document and recognition, never before the cut-over."""
    cut = F.lit(cut_over).cast("timestamp_ntz")
    both = F.col(completed).isNotNull() & F.col(dated).isNotNull()
    if as_of:
        now = F.lit(as_of).cast("timestamp_ntz")
        both = both & (F.col(completed) <= now) & (F.col(dated) <= now)
    legacy = F.when(both, F.greatest(dated, completed))
    return F.when(is_true(legacy < cut), legacy).when(
        F.col(dated).isNotNull() & F.col(recognized).isNotNull(), F.greatest(F.greatest(dated, recognized), cut)
    )
