"""On-time rates, lateness, tracking, shipments, batches and logistics operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import all_of, count_when, is_true, ladder, text_flag
from millrace.functions.dates import add_part, boundary_diff, day
from millrace.operators.joins import coalesced_exception_override, fx_convert
from millrace.operators.keyed import attach, only_matching
from millrace.operators.ordered import lag_delta, lead_values, running_total
from millrace.operators.windows import first_rows
from millrace.sources.session import cut_lineage

# Words in a carrier message that tell of a delay logistics can resolve. Place names are left to the caller.
ALERT_WORDS = [
    "restriction", "attention", "missing", "company", "name", "e", "number", "ave", "contacted", "investigation", "message", "pre",
    "funds", "street", "about", "product", "receiving", "return", "either", "begun", "locate", "invoice", "improper", "authorization",
    "oversized", "overweight", "require", "commercial", "goods", "identification", "express", "claim", "accident", "situation", "classify",
    "commodity", "description", "insufficient", "breakdown", "composition", "itemized", "original", "get", "opened", "allowed", "maximum",
    "reaching", "remains", "detailed", "etc", "examples", "gst", "include", "registration", "rfc", "ssn", "vat", "lost", "redelivery",
    "reminder", "highway", "state", "logo", "end", "importation", "indicating", "reason", "statement", "use", "written", "centre", "nw",
    "form", "specialized",
]
STATUS_ALERTS = "delay|external|exception|payment|held|damaged|lost"
CARRIER_HAS_IT = ["In Transit", "Acceptance scan", "Arrival scan", "Arrived at destination country", "Departure Scan"]

# Hours of grace for the supplier's hand-over, days until an unreported delivery counts as done.
GRACE_HOURS, ASSUMED_DELIVERY_DAYS = 12, 7
# The technology whose sample deals have a promise date of their own, and since when.
OWN_PROMISE_TECHNOLOGY, OWN_PROMISE_DEAL, OWN_PROMISE_SINCE = "3", "tooling & samples", "2024-10-01"
SHIPPED_STATUSES = ["completed", "delivered", "disputed", "shipped"]


def on_time(promised: Column, happened: Column, status: Column, as_of: str, due: Column | None = None, hold: Column | None = None) -> Column:
    """Null / true / false in a fixed order: not due yet, no promise, shipped without a date, cancelled, held by the customer, late, in time, overdue.

    ``due`` is the promise with grace where it differs from the promise itself.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    due = promised if due is None else due
    late = happened > due
    return ladder([
        (add_part(promised, 1, "day") > now, F.lit(None).cast("boolean")),
        (due.isNull(), F.lit(None).cast("boolean")),
        (status.isin(SHIPPED_STATUSES) & happened.isNull(), F.lit(None).cast("boolean")),
        (status == "canceled", F.lit(None).cast("boolean")),
        (is_true(hold) & late if hold is not None else F.lit(False), F.lit(None).cast("boolean")),
        (late, False), (happened <= due, True), (happened.isNull() & (add_part(due, 1, "day") < now), False),
    ])


def on_time_label(promised: Column, happened: Column, status: Column, as_of: str) -> Column:
    now = F.lit(as_of).cast("timestamp_ntz")
    unjudged = (promised > now) | promised.isNull() | (status.isin(SHIPPED_STATUSES) & happened.isNull()) | (status == "canceled")
    overdue = happened.isNull() & (add_part(promised, 1, "day") < day(now))
    return ladder([(unjudged, F.lit(None).cast("boolean")), (happened > promised, False), (happened <= promised, True), (overdue, False)])


def delay_days(promised: Column | str, happened: Column | str) -> Column:
    return F.round(boundary_diff(promised, happened, "minute") / F.lit(1440), 1)


def on_time_by_own_promise(regular: Column, as_of: str, since: str) -> Column:
    """The supplier's flag where a technology has its own promise date: orders from before it was kept are not judged, sample deals are judged by it, without grace."""
    now, own = F.lit(as_of).cast("timestamp_ntz"), F.col("own_promise_at")
    special, shipped = F.col("technology_id") == OWN_PROMISE_TECHNOLOGY, F.col("shipped_at")
    sample = special & (F.lower("deal_type") == OWN_PROMISE_DEAL) & (F.col("status") != "canceled")
    by_own = F.when(shipped <= own, True).when(shipped > own, False).when(shipped.isNull() & (add_part(own, 1, "day") < now), False)
    return F.when(special & (F.col("created_at") < F.lit(since).cast("timestamp_ntz")), F.lit(None).cast("boolean")).when(sample, by_own).otherwise(regular)


def on_time_rate(orders: DataFrame, delays: DataFrame, as_of: str, own_promise_since: str = OWN_PROMISE_SINCE) -> DataFrame:
    """On-time flags to the customer and by the supplier (with grace), delays in days, and delay notices per order.

    The flag for the shipping label is judged as soon as the promise has passed, and overdue by whole days.
    """
    notices = delays.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_delays"), F.bool_or(F.col("liability") == "supplier").alias("has_supplier_liability"),
        F.min("notified_at").alias("first_delay_at"), F.max("new_shipping_at").alias("latest_new_shipping_at"),
    )
    promised, supplier = F.col("promised_customer_at"), F.col("promised_supplier_at")
    due, status = add_part("promised_supplier_at", GRACE_HOURS, "hour"), F.col("status")
    flagged = orders.select(
        "order_id",
        on_time(promised, F.col("shipped_to_customer_at"), status, as_of, hold=F.col("on_customer_hold")).alias("on_time_to_customer"),
        on_time(F.col("expected_at"), F.col("shipped_to_customer_at"), status, as_of, hold=F.col("on_customer_hold")).alias("on_time_expected"),
        on_time_by_own_promise(on_time(supplier, F.col("shipped_at"), status, as_of, due=due), as_of, own_promise_since).alias("on_time_by_supplier"),
        on_time_label(supplier, F.col("label_at"), status, as_of).alias("on_time_label"),
        delay_days(promised, "shipped_to_customer_at").alias("delay_to_customer_days"), delay_days(due, "shipped_at").alias("delay_by_supplier_days"),
    )
    return flagged.join(notices, "order_id", "left")


def batch_on_time_rate(batches: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """On-time flags per batch (first shipment of a batch number counts), and per order where there are no batches."""
    first = first_rows(batches, ["order_id", "batch_number"], ["shipped_at", "batch_id"])
    last = first.groupBy("order_id").agg(F.max("batch_number").alias("_last"))
    due = add_part("promised_supplier_at", GRACE_HOURS, "hour")

    def rated(df: DataFrame, source: str) -> DataFrame:
        return df.select(
            F.lit(source).alias("source"), "order_id", "batch_number",
            on_time(F.col("promised_supplier_at"), F.col("shipped_at"), F.col("status"), as_of, due=due).alias("on_time_by_supplier"),
            on_time(F.col("promised_customer_at"), F.col("shipped_to_customer_at"), F.col("status"), as_of, hold=F.col("on_customer_hold")).alias("on_time_to_customer"),
            delay_days("promised_customer_at", "shipped_to_customer_at").alias("delay_to_customer_days"), "quantity", "is_last_batch",
        )

    by_batch = first.join(last, "order_id").withColumn("is_last_batch", F.col("batch_number") == F.col("_last"))
    whole = only_matching(orders, batches.select("order_id"), ["order_id"], "left_anti")
    whole = whole.withColumns({"batch_number": F.lit(1).cast("long"), "is_last_batch": F.lit(True)})
    return rated(by_batch, "batches").unionByName(rated(whole, "orders"))


def lateness_components(timeline: DataFrame, auctions: DataFrame, bids: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """Time and lateness per order and component, in minutes.

    The steps that an order's own dates give come from one pass over the timeline.
    """
    def step(source: str, impact: str, process: str, start: Column, end: Column, late: Column | None) -> Column:
        minutes = boundary_diff(start, end, "minute")
        return F.struct(
            F.lit(source).alias("source"), F.lit(impact).alias("impact"), F.lit(process).alias("process"), start.alias("start_at"), end.alias("end_at"),
            minutes.alias("minutes"), (F.lit(0).cast("long") if late is None else late).alias("late_minutes"),
        )

    def spent(a: str, b: str) -> Column:
        return boundary_diff(a, b, "minute")

    c = F.col
    own = F.array(
        step("Production", "Production Delay", "Label creation", c("promised_supplier_at"), c("shipped_at"), spent("promised_supplier_at", "shipped_at")),
        step("Production", "Production Delay", "Supplier pick up discrepancy", c("label_at"), c("shipped_at"), spent("label_at", "shipped_at")),
        step("Production", "Production Time", "Original Production Time", c("sourced_at"), c("promised_supplier_at"), None),
        step("Logistics", "Logistics Time", "Transit time to cross dock", c("shipped_at"), c("to_cross_dock_at"),
             spent("shipped_at", "to_cross_dock_at") - c("first_leg_buffer_days") * 1440),
        step("Cross Docking", "Cross Docking Time", "Transit time at cross dock", c("to_cross_dock_at"), c("from_cross_dock_at"), spent("to_cross_dock_at", "from_cross_dock_at") - 1440),
    )
    from_orders = timeline.select("order_id", F.inline(own))
    won = auctions.filter("is_first_successful")
    sourcing = won.select("order_id", F.inline(F.array(step("Sourcing", "Sourcing Time", "Sourcing", c("started_at"), c("finished_at"), None))))
    counter = bids.join(won.select("auction_id"), "auction_id", "left_semi").filter("is_winning").select(
        "order_id", F.inline(F.array(step("Sourcing", "Production Time", "Counter bid on lead time", c("original_ship_by"), c("accepted_ship_by"), spent("original_ship_by", "accepted_ship_by")))),
    )
    changes = lag_delta(purchase_orders.filter("finalized_at is not null"), ["order_id"], ["finalized_at", "doc_id"], {"_before": "promised_at"}, F.trunc("finalized_at", "quarter"))
    changes = changes.withColumn("_previous", F.coalesce("_before", "promised_at"))
    adjusted = changes.select("order_id", F.inline(F.array(step(
        "Production", "Production Time", "PO promised shipping date adjustments", c("_previous"), c("promised_at"), spent("_previous", "promised_at"),
    ))))
    return from_orders.unionByName(sourcing).unionByName(counter).unionByName(adjusted)


def lateness_decomposition(timeline: DataFrame, components: DataFrame) -> DataFrame:
    """Hours late and lead time per order, split by component; what no component explains is left over."""
    sources = {"Sourcing": "sourcing", "Production": "production", "Logistics": "logistics", "Cross Docking": "cross_dock"}
    sums = [F.sum("late_minutes").alias("_late"), F.sum("minutes").alias("_time")]
    for label, name in sources.items():
        hit = F.col("source") == label
        sums += [F.sum(F.when(hit, F.col("late_minutes"))).alias(f"_late_{name}"), F.sum(F.when(hit, F.col("minutes"))).alias(f"_time_{name}")]
    out = timeline.join(components.groupBy("order_id").agg(*sums), "order_id", "left")
    late = is_true(~F.col("on_time_to_customer"))

    def hours(x: Column) -> Column:
        return F.coalesce(x, F.lit(0)) / F.lit(60)

    actual = boundary_diff("promised_customer_at", "shipped_to_customer_at", "minute")
    total = F.when(late, F.coalesce("_late", F.lit(0))).otherwise(0)
    return out.select(
        "order_id", "on_time_to_customer", (actual / F.lit(60)).alias("hours_late"), (total / F.lit(60)).alias("explained_hours_late"),
        *[hours(F.when(late, F.col(f"_late_{n}"))).alias(f"{n}_late_hours") for n in sources.values()],
        *[hours(F.col(f"_time_{n}")).alias(f"{n}_hours") for n in sources.values()],
        ((actual - total) / F.lit(60)).alias("unexplained_hours_late"),
    )


def tracking_messages(entities: dict[str, DataFrame], chunk: Column, alert_words: Sequence[str] = ALERT_WORDS) -> DataFrame:
    """Carrier messages of several entities: repeats of a day dropped, alerts flagged, numbered, with hours until the next one.

    Each: tracking_number, received_at, message_id, location, status, message. The alert words are looked up in
    the whole text before any shuffle; from there on its digest stands for it.
    """
    text = F.concat(F.lit(" "), F.lower("message"), F.lit(" "))
    out = None
    for entity, df in entities.items():
        judged = df.withColumns({
            "entity": F.lit(entity), "has_message_alert": text.rlike(f" ({'|'.join(alert_words)}) "),
            "has_status_alert": F.lower("status").rlike(STATUS_ALERTS), "_day": day("received_at"), "_digest": F.md5("message"), "_one": F.lit(1),
        }).drop("message")
        part = first_rows(judged, ["tracking_number", "_day", "location", "_digest"], ["received_at", "message_id"]).drop("_day", "_digest")
        out = part if out is None else out.unionByName(part)
    # reading the texts is the expensive part and the numbering looks at the rows four times
    out = cut_lineage(out, "tracking-messages")
    order = ["received_at", "message_id"]
    numbered = running_total(out, ["tracking_number"], order, "_one", "message_number", chunk)
    nxt = lead_values(numbered, ["tracking_number"], order, {"_next": "received_at"}, chunk)
    return nxt.withColumns({
        "is_last_message": F.col("_next").isNull(), "hours_in_status": boundary_diff("received_at", "_next", "hour"),
    }).drop("_one", "_next")


def message_rollup(messages: DataFrame) -> DataFrame:
    """Per tracking number: counts, first and third message, alerts, when the carrier got it, delivery, last status."""
    n = F.col("message_number")
    return messages.groupBy("tracking_number").agg(
        F.count(F.lit(1)).alias("n_messages"), F.max(F.when(n == 1, F.col("received_at"))).alias("first_message_at"),
        F.max(F.when(n == 3, F.col("received_at"))).alias("third_message_at"), count_when(F.col("has_message_alert")).alias("n_message_alerts"),
        count_when(F.col("has_status_alert")).alias("n_status_alerts"),
        F.min(F.when(F.col("status").isin(CARRIER_HAS_IT), F.col("received_at"))).alias("carrier_received_at"),
        F.max(F.when(F.col("status") == "Delivered", F.col("received_at"))).alias("tracked_delivered_at"),
        F.max(F.when(F.col("is_last_message"), F.col("status"))).alias("last_status"),
        F.bool_or(F.when(F.col("is_last_message"), F.col("has_message_alert"))).alias("last_has_alert"),
    )


def shipment_fact(shipments: DataFrame, messages: DataFrame, orders: DataFrame, carriers: list[tuple[str, str]], test_orders: DataFrame) -> DataFrame:
    """Shipments with their tracking, leg, first-of-leg flag, plus freight orders that never got a shipment row.

    shipments: shipment_id, order_id, batch_id, tracking_number, created_at, received_at, delivered_at, carrier, is_cross_docking, to_warehouse, leg_override;
    orders: order_id, tracking_note.
    """
    leg = F.when(~F.col("is_cross_docking"), "drop_shipping:customer").when(F.col("to_warehouse"), "cross_docking:warehouse").otherwise("cross_docking:customer")
    carrier = ladder([(F.lower("carrier").rlike(pattern), name) for pattern, name in carriers], F.lower("carrier"))
    received = F.coalesce("carrier_received_at", "received_at")
    delivered = F.coalesce("tracked_delivered_at", "delivered_at")
    # Shipments without an order belong to no leg. The others are dealt by order once: for the test orders and for the first of a leg.
    real = shipments.filter("order_id is not null").withColumn("leg", F.coalesce("leg_override", leg)).join(test_orders, "order_id", "left_anti")
    real = real.withColumn("_f", F.min(F.struct("created_at", "shipment_id")).over(Window.partitionBy("order_id", "leg")))
    out = real.join(message_rollup(messages), "tracking_number", "left").withColumns({"_received": received, "_delivered": delivered})
    valid = F.col("_delivered").isNotNull() | (F.coalesce("n_messages", F.lit(0)) >= 3) | F.col("_received").isNotNull()
    facts = out.select(
        "shipment_id", "order_id", "batch_id", "tracking_number", "created_at", F.col("_received").alias("received_at"), F.col("_delivered").alias("delivered_at"),
        carrier.alias("carrier"), "leg", "is_cross_docking", F.coalesce("last_status", F.lit("unknown")).alias("last_status"),
        F.coalesce("n_message_alerts", F.lit(0)).alias("n_alerts"), is_true("last_has_alert").alias("has_alert"), valid.alias("is_valid"),
        (F.col("_f.shipment_id") == F.col("shipment_id")).alias("is_first_of_leg"),
    )
    never = only_matching(orders, shipments.select("order_id"), ["order_id"], "left_anti").filter(F.lower("tracking_note").contains("freight"))
    return facts.unionByName(never.select("order_id", F.col("tracking_note").alias("tracking_number")), allowMissingColumns=True)


def batch_fact(shipments: DataFrame) -> DataFrame:
    """Milestones per batch: labels, hand-overs and deliveries to the cross dock and to the customer."""
    warehouse, customer = F.col("leg") == "cross_docking:warehouse", F.col("leg") == "cross_docking:customer"
    cross = F.col("is_cross_docking")
    to_customer = F.when(~cross | customer, F.least("created_at", F.when(cross, F.col("received_at"))))
    grouped = shipments.filter(F.col("batch_id").isNotNull()).groupBy("order_id", "batch_id").agg(
        F.bool_or(cross).alias("is_cross_docking"), count_when(F.col("is_valid")).alias("n_shipments"),
        F.min(F.when(warehouse, F.col("created_at"))).alias("label_to_cross_dock_at"), F.min(F.when(warehouse, F.col("received_at"))).alias("received_to_cross_dock_at"),
        F.min(F.when(warehouse, F.col("delivered_at"))).alias("delivered_to_cross_dock_at"), F.min(to_customer).alias("label_to_customer_at"),
        F.min(F.when(~cross | customer, F.col("received_at"))).alias("received_to_customer_at"),
        F.min(F.when(~cross | customer, F.col("delivered_at"))).alias("delivered_to_customer_at"), F.sum("n_alerts").alias("n_alerts"),
    )
    carriers = shipments.filter(F.col("batch_id").isNotNull() & (~cross | customer)).select("batch_id", "carrier").distinct()
    listed = carriers.groupBy("batch_id").agg(F.array_join(F.array_sort(F.collect_list("carrier")), " ").alias("carriers_to_customer"))
    return grouped.join(listed, "batch_id", "left").withColumns({
        "is_valid_batch": F.col("n_shipments") > 0, "has_had_alerts": F.col("n_alerts") > 0, "first_label_at": F.coalesce("label_to_cross_dock_at", "label_to_customer_at"),
    }).drop("n_alerts")


def logistics_timeline(batches: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """Shipping and delivery dates per order, with checks that they follow each other.

    orders: order_id, is_cross_docking, delivered_at, completed_at.
    """
    first = {n: F.min(n).alias(n) for n in (
        "label_to_cross_dock_at", "received_to_cross_dock_at", "delivered_to_cross_dock_at", "label_to_customer_at", "received_to_customer_at", "delivered_to_customer_at",
    )}
    per_order = batches.groupBy("order_id").agg(F.sum("n_shipments").alias("n_shipments"), count_when(F.col("is_valid_batch")).alias("n_batches"), *first.values())
    out = orders.join(per_order, "order_id", "left")
    cross = F.col("is_cross_docking")
    to_dock, at_dock = F.col("received_to_cross_dock_at"), F.col("delivered_to_cross_dock_at")
    to_customer, at_customer = F.col("received_to_customer_at"), F.col("delivered_to_customer_at")
    dock_ok = F.when(cross, ~is_true(to_dock > at_dock))
    customer_ok = ~is_true(F.when(cross, to_dock > at_customer).otherwise(to_customer > at_customer))
    in_order = [to_dock > at_customer, to_dock > at_dock, to_dock > to_customer, at_dock > to_customer, at_dock > at_customer, to_customer > at_customer]
    consistent = F.when(cross, all_of([~is_true(x) for x in in_order])).otherwise(~is_true(to_customer > at_customer))
    out = out.withColumns({
        "dock_dates_ok": dock_ok, "customer_dates_ok": customer_ok, "has_consistent_dates": consistent,
        "shipped_at": F.when(cross, to_dock).otherwise(to_customer), "shipped_to_customer_at": to_customer,
        "shipped_from_cross_dock_at": F.when(cross, to_customer),
    })
    delivered = F.when(F.col("customer_dates_ok"), F.coalesce(at_customer, F.col("delivered_at")))
    assumed = add_part("shipped_to_customer_at", ASSUMED_DELIVERY_DAYS, "day")
    derived = F.coalesce(delivered, F.when(assumed < F.lit(as_of).cast("timestamp_ntz"), assumed), F.col("completed_at"))
    return out.select(
        "order_id", "is_cross_docking", F.coalesce("n_shipments", F.lit(1)).alias("n_shipments"), "n_batches", "dock_dates_ok", "customer_dates_ok", "has_consistent_dates",
        F.when(cross, F.col("label_to_cross_dock_at")).otherwise(F.col("label_to_customer_at")).alias("label_at"), "shipped_at", "shipped_to_customer_at",
        "shipped_from_cross_dock_at", delivered.alias("delivered_at"), derived.alias("derived_delivered_at"), F.when(cross & dock_ok, at_dock).alias("delivered_to_cross_dock_at"),
    )


def geo_resolution(orders: DataFrame, suppliers: DataFrame, addresses: DataFrame, countries: DataFrame, states: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Origin and destination per order; listed orders use another address; US states by code first, then by name.

    orders: order_id, supplier_id, address_id, is_cross_docking, is_direct; addresses: address_id, country_id, area, city.
    """
    listed = coalesced_exception_override(orders, exceptions, "order_id", ["address_id"])
    by_code = states.select(F.lower("code").alias("_area"), F.col("state").alias("_by_code"))
    by_name = states.select(F.lower("state").alias("_area"), F.col("state").alias("_by_name"))
    area = F.lower(F.regexp_replace("area", "^US-", ""))
    places = addresses.withColumn("_area", area).join(by_code, "_area", "left").join(by_name, "_area", "left")
    places = places.join(countries.select("country_id", F.col("country").alias("destination_country"), F.col("region").alias("destination_region")), "country_id", "left")
    places = places.select("address_id", "destination_country", "destination_region", F.col("city").alias("destination_city"), F.coalesce("_by_code", "_by_name").alias("destination_state"))
    origin = suppliers.join(countries, "country_id", "left").select("supplier_id", F.col("country").alias("origin_country"), F.col("region").alias("origin_region"))
    out = listed.join(places, "address_id", "left").join(origin, "supplier_id", "left")
    return out.withColumn("is_cross_docking", is_true("is_cross_docking") & ~is_true("is_direct")).drop("is_direct", "address_id")


def logistics_operations(eu: DataFrame, us: DataFrame, rates: DataFrame) -> DataFrame:
    """Label operations of two warehouses in common units and currency. Fixed value: kilograms per pound.

    Both: operation_id, tracking_number, weight_text, cost_cents, currency, started_at, labelled_at, conforming_text.
    """
    per_pound = 0.45359237
    out = None
    for region, df in (("eu", eu), ("us", us)):
        weight = F.coalesce(F.when(F.col("weight_text").rlike(r"^[0-9]+(\.[0-9]+)?$"), F.col("weight_text")).try_cast("double"), F.lit(0.0))
        kilograms, pounds = (weight, weight / F.lit(per_pound)) if region == "eu" else (weight * F.lit(per_pound), weight)
        priced = fx_convert(df, rates, "cost_cents", "currency", F.col("labelled_at"), "_usd") if region == "eu" else df.withColumn("_usd", F.col("cost_cents").cast("double"))
        part = priced.select(
            F.lit(region).alias("region"), F.md5(F.concat(F.lit(f"{region}_"), F.col("operation_id").cast("string"))).alias("operation_key"), "operation_id", "tracking_number",
            kilograms.alias("weight_kg"), pounds.alias("weight_lb"), F.coalesce("_usd", F.lit(0.0)).alias("cost_usd_cents"),
            boundary_diff("started_at", "labelled_at", "second").alias("seconds_spent"), text_flag("conforming_text").alias("is_conforming"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def scans_local_time(scans: DataFrame, zones: dict[str, str], col: str, home: str) -> DataFrame:
    """Scan times (UTC) in the head office's zone and in the zone of the scan's location."""
    def at(zone: str) -> Column:
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(col))

    local = ladder([(F.col("location") == place, at(zone)) for place, zone in zones.items()], F.col(col))
    return scans.withColumns({f"{col}_home": at(home), f"{col}_local": local})


def hold_rack(statuses: DataFrame, k: str, ts: str) -> DataFrame:
    """Hold-rack entries with the first and the latest time their document was touched."""
    return attach(statuses, statuses.groupBy(k).agg(F.min(ts).alias("date_entered"), F.max(ts).alias("latest_contact")), [k])
