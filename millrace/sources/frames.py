"""Frames derived from the tables by fixed formulas: second versions, histories, milestones, rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import page_of
from millrace.functions.dates import add_part
from millrace.operators.ordered import lag_delta

CURRENCIES = ["USD", "EUR", "GBP"]

Frames = Mapping[str, DataFrame]


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def order_currency(custkey: str = "o_custkey") -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in CURRENCIES]), (F.col(custkey) % 3 + 1).cast("int"))


def rates(t: Frames) -> DataFrame:
    """One rate per currency and order day; a job that has written them gives them as a table."""
    if (written := t.get("rates")) is not None:
        return written
    days = t["orders"].select(F.to_date("o_orderdate").alias("date")).distinct()
    step = F.dayofmonth("date") % 10
    each = F.array(
        F.struct(F.lit("USD").alias("currency"), F.lit(100).alias("pct")),
        F.struct(F.lit("EUR").alias("currency"), (step + 80).alias("pct")),
        F.struct(F.lit("GBP").alias("currency"), (step + 70).alias("pct")),
    )
    return days.select("date", F.inline(each)).select("currency", "date", (F.col("pct") / F.lit(100)).alias("rate"))


def customer_v2(t: Frames) -> DataFrame:
    """A later state of customer: some balances changed, some rows gone, some new."""
    base = t["customer"]
    k = F.col("c_custkey")
    kept = base.filter(k % 50 != 0).withColumn("c_acctbal", F.when(k % 7 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")))
    return kept.unionByName(base.filter(k % 100 == 1).withColumn("c_custkey", k + 1_000_000))


def supplier_v1(t: Frames) -> DataFrame:
    return t["supplier"].withColumn("updated_at", _ts("2000-01-01"))


def supplier_v2(t: Frames) -> DataFrame:
    base = t["supplier"]
    k = F.col("s_suppkey")
    moved = k % 7 == 0
    kept = base.filter(k % 50 != 0).select(
        "s_suppkey", "s_name", "s_nationkey",
        F.when(moved, F.col("s_acctbal") + 100).otherwise(F.col("s_acctbal")).alias("s_acctbal"),
        F.when(moved, _ts("2001-01-01")).otherwise(_ts("2000-01-01")).alias("updated_at"),
    )
    added = base.filter(k % 100 == 1).withColumn("s_suppkey", k + 1_000_000).withColumn("updated_at", _ts("2001-01-01"))
    return kept.unionByName(added)


def orders_v2(t: Frames) -> DataFrame:
    k = F.col("o_orderkey")
    changed = F.when(k % 11 == 0, F.lit("F")).otherwise(F.col("o_orderstatus"))
    return t["orders"].filter(k % 97 != 0).withColumn("o_orderstatus", changed)


def supplier_history(t: Frames) -> DataFrame:
    """Three versions of a supplier rate."""
    spans = [("1995-01-01", "1997-07-01"), ("1997-07-01", "1999-07-01"), ("1999-07-01", None)]
    versions = F.array(*[
        F.struct(
            _ts(a).alias("valid_from"), (_ts(b) if b else F.lit(None).cast("timestamp_ntz")).alias("valid_to"),
            ((F.col("s_suppkey") % 5 + i + 1) / F.lit(100)).alias("rate"),
        )
        for i, (a, b) in enumerate(spans)
    ])
    return t["supplier"].select("s_suppkey", F.inline(versions))


def order_interval(t: Frames) -> DataFrame:
    days = F.col("o_orderkey") % 30 + 1
    return t["orders"].select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").alias("start_at"),
        add_part("o_orderdate", days, "day").alias("end_at"),
    )


def milestones(t: Frames) -> DataFrame:
    """Order milestones: created, promised, shipped, delivered (some unknown), cancelled (few)."""
    k = F.col("o_orderkey")
    shipped = t["orders"].select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").alias("created_at"),
        add_part("o_orderdate", 10, "day").alias("promised_at"),
        add_part("o_orderdate", k % 20 + 1, "day").alias("shipped_at"),
        F.when(k % 13 == 0, add_part("o_orderdate", 2, "day")).alias("cancelled_at"),
    )
    return shipped.withColumn("delivered_at", F.when(k % 19 != 0, add_part("shipped_at", k % 7 + 1, "day")))


def timed_interval(t: Frames) -> DataFrame:
    """Intervals with a time of day."""
    k = F.col("o_orderkey")
    started = t["orders"].select(
        "o_orderkey", "o_custkey", add_part("o_orderdate", k * 37 % 1440, "minute").alias("started_at")
    )
    return started.withColumn("finished_at", add_part("started_at", k * 91 % 20000, "minute"))


def messy_customer(t: Frames) -> DataFrame:
    """Customer as dirty text: empty segments, 'n/a' balances, flags as text."""
    k = F.col("c_custkey")
    balance = F.when(k % 17 == 0, F.lit("n/a")).otherwise(F.rint(F.col("c_acctbal") * 100).cast("long").cast("string"))
    return t["customer"].select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(k % 10 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        balance.alias("balance_cents"),
        F.when(k % 3 == 0, F.lit("true")).when(k % 3 == 1, F.lit("false")).otherwise(F.lit("")).alias("is_strategic"),
        F.when(k % 23 == 0, F.lit("unknown")).otherwise(F.col("c_nationkey").cast("string")).alias("nation_text"),
    )


def legacy_orders(t: Frames) -> DataFrame:
    """Orders of the first year in an older layout: no priority, a channel column instead."""
    old = t["orders"].filter(F.col("o_orderdate") < _ts("1996-01-01"))
    return old.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("phone")).otherwise(F.lit("mail")).alias("channel"),
    )


def parent_orders(t: Frames) -> DataFrame:
    """Re-orders: every fourth order names its customer's previous order as parent."""
    base = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    linked = lag_delta(base, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"_prev": "o_orderkey"}, F.trunc("o_orderdate", "quarter"))
    return linked.select(*base.columns, F.when(F.col("o_orderkey") % 4 == 0, F.col("_prev")).alias("parent_key"))


TECHNOLOGIES = ["CNC", "3DP", "IM", "SM"]


def mart_orders(t: Frames) -> DataFrame:
    """Orders under business names: contact, company (some contacts have none), life-cycle dates, amounts in cents."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    closed = F.col("o_orderstatus") != "O"
    sourced = F.col("o_orderstatus") == "F"
    base = t["orders"].select(
        k.alias("order_id"), cust.alias("contact_id"),
        F.when(cust % 4 != 0, F.floor(cust / F.lit(5))).alias("company_id"),
        F.element_at(F.array(*[F.lit(x) for x in TECHNOLOGIES]), (k % 4 + 1).cast("int")).alias("technology"),
        F.col("o_orderdate").alias("created_at"),
        F.when(k % 10 != 0, add_part("o_orderdate", k % 3, "day")).alias("submitted_at"),
        closed.alias("is_closed"), F.when(closed, add_part("o_orderdate", k % 9 + 1, "day")).alias("closed_at"),
        sourced.alias("is_sourced"), F.rint(F.col("o_totalprice") * 100).cast("long").alias("subtotal_cents"),
        (cust % 3 == 0).alias("is_strategic"), F.col("o_orderpriority").alias("priority"),
    )
    order = F.col("order_id")
    return base.withColumns({
        "sourced_at": F.when(F.col("is_sourced"), add_part("closed_at", order % 4, "day")),
        "cost_cents": F.floor(F.col("subtotal_cents") * (order % 35 + 60) / F.lit(100)),
    })


def contacts(t: Frames) -> DataFrame:
    """Customers as contacts with geography and a browser token that some share."""
    k = F.col("c_custkey")
    geo = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return (
        t["customer"].join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            k.alias("contact_id"), F.when(k % 4 != 0, F.floor(k / F.lit(5))).alias("company_id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("country"), F.col("r_name").alias("region"),
            F.when(k % 10 == 0, F.lit("outbound")).otherwise(F.lit("inbound")).alias("channel_type"),
            F.when(k % 5 != 0, F.concat(F.lit("tok"), F.floor(k / F.lit(3)).cast("string"))).otherwise(F.lit("")).alias("token"),
            add_part(F.lit("1994-06-01").cast("timestamp_ntz"), k * 7 % 900, "day").alias("created_at"),
            F.when(k % 6 != 0, add_part(F.lit("1994-06-01").cast("timestamp_ntz"), k * 7 % 900 + k % 5, "day")).alias("lead_at"),
            F.rint(F.col("c_acctbal") * 100).cast("long").alias("balance_cents"),
        )
    )


def doc_lines(t: Frames) -> DataFrame:
    """Line items as lines of order documents: up to two quotes and four purchase orders per order."""
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 2).otherwise(4)
    opened = F.col("l_linestatus") == "O"
    return t["lineitem"].select(
        F.col("l_orderkey").alias("order_id"), (F.col("l_orderkey") * 10 + flag + opened.cast("int")).alias("doc_id"),
        F.when(F.col("l_returnflag") == "A", "quote").otherwise("purchase_order").alias("doc_type"), opened.alias("is_active"),
        F.col("l_linenumber").cast("long").alias("line_number"), F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"),
        F.rint(F.col("l_extendedprice") * 100).cast("long").alias("cents"), F.rint(F.col("l_discount") * 100).cast("long").alias("discount_pct"),
        F.col("l_quantity").cast("long").alias("quantity"), F.col("l_shipdate").alias("dated_at"),
    )


def documents(t: Frames) -> DataFrame:
    """Document headers: totals and dates over their lines."""
    order = F.col("order_id")
    heads = doc_lines(t).groupBy("order_id", "doc_id", "doc_type", "is_active").agg(
        F.min("dated_at").alias("created_at"), F.max("dated_at").alias("_last"), F.sum("cents").alias("subtotal_cents"),
        F.min("supplier_id").alias("supplier_id"), F.count(F.lit(1)).alias("n_lines"), F.max("line_number").alias("revision"),
        F.bool_or(F.col("discount_pct") > 8).alias("is_admin"),
    )
    return heads.withColumns({
        "finalized_at": F.when(F.col("doc_id") % 7 != 0, F.col("_last")),
        "currency": F.element_at(F.array(*[F.lit(x) for x in CURRENCIES]), (order % 3 + 1).cast("int")),
        "technology_id": order % 4 + 1,
    }).drop("_last")


SOURCE_NAMES = ["ORGANIC_SEARCH", "DIRECT_TRAFFIC", "PAID_SEARCH", "OFFLINE", "SOCIAL_MEDIA"]
OFFLINE_DETAILS = ["IMPORT", "API", "INTEGRATION", "SALES"]


def web_contacts(t: Frames) -> DataFrame:
    """Contacts with the source and page of their first visit."""
    k = F.col("contact_id")
    base = contacts(t).select("contact_id", "company_id", "country", "token", "created_at")
    pages = t["pages"].select("page_id", "url")
    joined = base.join(pages, F.floor(k / F.lit(6)) == F.col("page_id"), "left")
    extra = F.when(k % 11 == 0, "&utm_source=youtube").when(k % 11 == 1, "&utm_medium=display").otherwise("")
    mark = F.when(F.col("url").contains("?"), "&").otherwise("?")
    return joined.select(
        *base.columns, add_part("created_at", k % 37 - 18, "hour").alias("first_visit_at"),
        F.get(F.array(*[F.lit(x) for x in SOURCE_NAMES]), (k % 6).cast("int")).alias("source"),
        F.when(k % 6 == 3, F.get(F.array(*[F.lit(x) for x in OFFLINE_DETAILS]), (F.floor(k / F.lit(6)) % 4).cast("int")))
        .otherwise(F.concat(F.lit("kw"), (k % 9).cast("string"))).alias("source_data_1"),
        F.when(k % 8 == 3, F.lit("list-1")).alias("source_data_2"),
        F.concat("url", mark, F.lit("utm_campaign=c"), (k % 20).cast("string"), extra).alias("first_url"),
    )


def page_groups(t: Frames) -> DataFrame:
    """Page to page group, for the pages that are grouped."""
    page = F.lower(page_of(F.col("url")))
    size = F.length("page") % 3
    known = t["pages"].select(page.alias("page")).distinct().filter(F.length("page") % 3 != 2)
    return known.select("page", F.when(size == 0, "Homepage").otherwise("Service").alias("page_group"))


def bids(t: Frames) -> DataFrame:
    """Line items as supplier bids in auctions: two auctions per order, some of them requests for quotation."""
    line, status = F.col("l_linenumber"), F.col("l_returnflag")
    price = F.rint(F.col("l_extendedprice") * 100).cast("long")
    placed = line % 7 != 0
    response = F.when(status == "A", "accepted").when(status == "N", "countered").otherwise("rejected")
    key = F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], price.cast("string"))
    return t["lineitem"].select(
        key.alias("bid_id"), (F.col("l_orderkey") * 10 + (F.col("l_linestatus") == "O").cast("int")).alias("auction_id"),
        F.col("l_orderkey").alias("order_id"), (F.col("l_orderkey") % 5 == 0).alias("is_rfq"), F.col("l_suppkey").alias("supplier_id"),
        add_part("l_shipdate", -3, "day").alias("assigned_at"), F.when(line % 3 != 0, add_part("l_shipdate", -2, "day")).alias("seen_at"),
        F.when(placed, F.col("l_shipdate")).alias("placed_at"), F.when(placed, response).alias("response_type"),
        F.when(response != "rejected", price).alias("bid_cents"), F.col("l_quantity").cast("long").alias("lead_time"),
        F.rint(F.col("l_discount") * 100).cast("long").alias("margin_pct"), (line % 2 == 0).alias("is_active"),
    )


def auctions(t: Frames) -> DataFrame:
    """Auction headers; the cheapest answered bid wins, except where nobody did."""
    answered = F.col("response_type").isin("accepted", "countered")
    heads = bids(t).groupBy("auction_id", "order_id", "is_rfq").agg(
        F.min("assigned_at").alias("started_at"), F.max("placed_at").alias("finished_at"),
        F.min(F.when(answered, F.struct("bid_cents", "bid_id"))).alias("_w"), F.sum("bid_cents").alias("amount_cents"),
    )
    return heads.select(
        "auction_id", "order_id", "is_rfq", F.when(F.col("is_rfq"), "RFQ").otherwise("RDA").alias("auction_type"), "started_at", "finished_at",
        F.when(F.col("auction_id") % 4 != 0, F.col("_w.bid_id")).alias("winning_bid_id"), "amount_cents",
    )


def order_timeline(t: Frames) -> DataFrame:
    """Sourcing, promise, shipping and cross-dock dates per order; odd orders go through a cross dock."""
    k = F.col("order_id")
    base = milestones(t).select(
        F.col("o_orderkey").alias("order_id"), "created_at", add_part("created_at", 2, "day").alias("sourced_at"),
        F.when(F.col("o_orderkey") % 23 != 0, add_part("created_at", 8, "day")).alias("promised_supplier_at"),
        F.when(F.col("o_orderkey") % 29 != 0, F.col("promised_at")).alias("promised_customer_at"), add_part("promised_at", F.col("o_orderkey") % 4, "day").alias("expected_at"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("shipped_at")).alias("shipped_at"), add_part("shipped_at", -(F.col("o_orderkey") % 3), "day").alias("label_at"),
        F.when(F.col("cancelled_at").isNotNull(), "canceled").when(F.col("delivered_at").isNotNull(), "delivered").otherwise("in_production").alias("status"),
        F.when(F.col("o_orderkey") % 11 == 0, "3").otherwise((F.col("o_orderkey") % 3).cast("string")).alias("technology_id"),
        F.when(F.col("o_orderkey") % 22 == 0, "Tooling & Samples").otherwise("standard").alias("deal_type"), F.when(F.col("o_orderkey") % 4 != 0, add_part("created_at", 6, "day")).alias("own_promise_at"),
        (F.col("o_orderkey") % 31 == 0).alias("on_customer_hold"), "delivered_at", (F.col("o_orderkey") % 2 == 1).alias("is_cross_docking"),
    )
    docked = base.withColumn("to_cross_dock_at", F.when(F.col("is_cross_docking"), add_part("shipped_at", k % 4, "day")))
    return docked.withColumns({
        "from_cross_dock_at": add_part("to_cross_dock_at", k % 5, "day"), "first_leg_buffer_days": k % 3,
    }).withColumn("shipped_to_customer_at", F.coalesce("from_cross_dock_at", "shipped_at"))
