"""Suppliers, auctions and bids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import count_when, is_true
from millrace.functions.dates import day, epoch_s
from millrace.operators.joins import interval_overlap_load
from millrace.operators.ordered import running_total
from millrace.operators.windows import first_rows
from millrace.sources.session import cut_lineage

QUARTER_SECONDS = 90 * 24 * 3600


def supplier_capabilities(technologies: DataFrame, finishes: DataFrame, materials: DataFrame, processes: DataFrame, tied: int) -> DataFrame:
    """Supplier x technology x finish x material x process.

    Processes go with the technology, except for the ``tied`` technology, where they go with the material.
    All inputs are distinct catalogue rows, so the expansion is bounded by the catalogue.
    """
    k = ["supplier_id", "technology_id"]
    base = technologies.join(finishes, k, "left").join(materials, k, "left")
    by_tech = processes.select(*k, F.col("process_id").alias("process"))
    by_material = processes.select("supplier_id", F.col("process_id").alias("material_process"), F.col("process_id").alias("process")).distinct()
    free = base.filter(F.col("technology_id") != tied).join(by_tech, k, "left")
    bound = base.filter(F.col("technology_id") == tied).join(by_material, ["supplier_id", "material_process"], "left")
    cols = [*k, "finish", "material", "process"]
    return free.select(*cols).unionByName(bound.select(*cols))


def supplier_capacity(work: DataFrame, behaviour: DataFrame, on_time: DataFrame, since: str) -> DataFrame:
    """Per supplier and day: orders in production with their value, bid response volumes, on-time flags."""
    start = F.lit(since).cast("timestamp_ntz")
    null = {n: F.lit(None).cast("long") for n in ("in_progress", "load_cents", "seen", "positive", "assigned", "on_time", "late")}

    def row(df: DataFrame, **given: Column) -> DataFrame:
        return df.select("supplier_id", "date", *[given.get(n, null[n]).alias(n) for n in null])

    running = work.withColumn("_from", F.greatest("start_at", start)).filter(F.col("end_at") > start)
    load = interval_overlap_load(running, "_from", "end_at", ["supplier_id"], F.col("cents"))
    rates = behaviour.filter(F.col("assigned_at") >= start).groupBy("supplier_id", day("assigned_at").alias("date")).agg(
        count_when(F.col("seen_at").isNotNull()).alias("seen"), count_when(F.col("response_type").isin("accepted", "countered")).alias("positive"),
        F.count(F.lit(1)).alias("assigned"),
    )
    punctual = on_time.filter(F.col("promised_at") >= start).groupBy("supplier_id", day("promised_at").alias("date")).agg(
        count_when(is_true("is_on_time")).alias("on_time"), count_when(~F.col("is_on_time")).alias("late")
    )
    return (
        row(load, in_progress=F.col("in_progress"), load_cents=F.col("load"))
        .unionByName(row(rates, seen=F.col("seen"), positive=F.col("positive"), assigned=F.col("assigned")))
        .unionByName(row(punctual, on_time=F.col("on_time"), late=F.col("late")))
    )


def auction_history(auctions: DataFrame) -> DataFrame:
    """Auctions with their recency inside the order (and type), and the order's first and last successful one."""
    auctions = cut_lineage(auctions, "auctions")
    newest_first = auctions.withColumns({"_back": -epoch_s("started_at"), "_one": F.lit(1)})
    chunk = F.floor(F.col("_back") / F.lit(QUARTER_SECONDS))
    order = ["_back", "auction_id"]
    out = running_total(newest_first, ["order_id"], order, "_one", "recency_idx", chunk)
    out = running_total(out, ["order_id", "auction_type"], order, "_one", "recency_idx_type", chunk)
    won = F.col("winning_bid_id").isNotNull()
    ends = auctions.filter(won).groupBy("order_id").agg(
        F.min(F.struct("started_at", "auction_id")).alias("_first"), F.max(F.struct("finished_at", "auction_id")).alias("_last")
    )
    out = out.join(ends, "order_id", "left").withColumns({
        "is_first_successful": is_true(F.col("_first.auction_id") == F.col("auction_id")),
        "is_last_successful": is_true(F.col("_last.auction_id") == F.col("auction_id")),
        "is_latest_of_type": F.col("recency_idx_type") == 1,
    })
    rda = F.col("auction_type") == "RDA"
    return out.withColumn("is_sourced_by_auction", rda & F.col("is_latest_of_type") & F.col("is_last_successful")).drop("_back", "_one", "_first", "_last")


def auctions_per_order(auctions: DataFrame) -> DataFrame:
    won = F.col("winning_bid_id").isNotNull()
    return auctions.groupBy("order_id").agg(
        F.max(F.when(won, F.struct("started_at", "auction_id", "auction_type"))).alias("_last"), F.bool_or(won).alias("has_winning_bid"),
        F.count_distinct("auction_id").alias("n_auctions"),
    ).select("order_id", F.col("_last.auction_type").alias("last_winning_type"), "has_winning_bid", "n_auctions")


def bid_behaviour(bids: DataFrame, auctions: DataFrame) -> DataFrame:
    """Current bid of each supplier in each auction against the winning bid, with the supplier's win-rate mark.

    Per order and supplier the best bid counts: 1 when it won, 0 when it was a losing counter-bid.
    The bids are dealt by auction once, where they are reduced to one bid a supplier and compared, and by order and supplier once. Nothing is joined back to them, so no other
    copy of the bids moves; an auction, with at most one current bid a supplier, stays in one task.
    """
    dealt = bids.withColumn("_inactive", ~F.col("is_active")).repartition("auction_id")
    current = first_rows(dealt, ["auction_id", "supplier_id"], ["_inactive", "-placed_at", "bid_id"]).drop("_inactive")
    heads = auctions.select("auction_id", "winning_bid_id", "auction_type", "amount_cents")
    out = current.join(heads, "auction_id").withColumn("is_winning", is_true(F.col("bid_id") == F.col("winning_bid_id"))).drop("winning_bid_id")
    auction = Window.partitionBy("auction_id").orderBy("assigned_at", "bid_id")
    whole = auction.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = out.withColumns({
        "assigned_rank": F.row_number().over(auction),
        "_top": F.max(F.when(F.col("is_winning"), F.struct("bid_cents", "lead_time"))).over(whole),
        "n_counter": count_when(F.col("response_type") == "countered").over(whole),
    })
    won = F.col("_top").isNotNull()
    rated = out.select(
        "bid_id", "auction_id", "order_id", "supplier_id", "auction_type", "is_rfq", "assigned_at", "seen_at", "placed_at", "response_type", "assigned_rank", "is_winning",
        F.when(won, F.col("bid_cents") / F.nullif("_top.bid_cents", F.lit(0))).alias("share_of_winning_bid"),
        F.when(won, F.col("lead_time") / F.nullif("_top.lead_time", F.lit(0))).alias("share_of_winning_lead_time"),
        F.when(won, F.col("n_counter")).alias("n_counter_bids"), (F.col("amount_cents") * F.col("margin_pct") / F.lit(100)).alias("margin_cents"), "bid_cents",
    )
    place = [~F.col("is_winning"), F.coalesce("response_type", F.lit("~")), F.coalesce("placed_at", F.lit("1970-01-01").cast("timestamp_ntz")).desc()]
    known = F.col("order_id").isNotNull() & F.col("supplier_id").isNotNull()
    is_best = known & (F.rank().over(Window.partitionBy("order_id", "supplier_id").orderBy(*place)) == 1)
    win_rate = F.when(is_best & F.col("is_winning"), 1).when(is_best & (F.col("response_type") == "countered"), 0)
    at = rated.columns.index("is_winning") + 1
    return rated.select(*rated.columns[:at], win_rate.alias("win_rate"), *rated.columns[at:])


FLAGS = ("n_seen", "n_responses", "n_positive", "n_countered", "n_rejected", "_accepted")


def flag(name: str) -> Column:
    """One of ``FLAGS``. Columns need a session, and this module is read before there is one."""
    response = F.col("response_type")
    return {
        "n_seen": F.col("seen_at").isNotNull(), "n_responses": F.col("placed_at").isNotNull(), "n_positive": response.isin("accepted", "countered"),
        "n_countered": response == "countered", "n_rejected": response == "rejected", "_accepted": F.col("is_winning") & (response == "accepted"),
    }[name]


def marked_bids(behaviour: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """What the funnels of an order need of its bids, dealt by order: flags in place of dates and texts, and of winning bids who won when and with which margin. Marked bids stay as they are.

    A job that writes them names the flags whose counts it takes: the funnels then have no other counts.
    """
    if "_won" in behaviour.columns:
        return behaviour
    won = F.when(F.col("is_winning"), F.struct("assigned_at", "supplier_id", "margin_cents"))
    return behaviour.select(
        "order_id", "auction_id", "bid_id", "supplier_id", "is_rfq", "is_winning", *[is_true(flag(name)).alias(name) for name in flags], won.alias("_won"),
    ).repartition("order_id")


def auction_funnel(behaviour: DataFrame) -> DataFrame:
    """Per order: bids assigned, seen, answered, countered and won in auctions.

    The bids are dealt by order once; distinct auctions and bids are then counted by their first row and by one row a bid, without a copy of the rows for each count.
    """
    new_auction = (F.row_number().over(Window.partitionBy("order_id", "auction_id").orderBy("bid_id")) == 1) & F.col("auction_id").isNotNull()
    rows = marked_bids(behaviour).filter(~F.col("is_rfq")).withColumn("_new_auction", new_auction)
    flags, accepted = [n for n in FLAGS if n in rows.columns and n != "_accepted"], [F.col("_accepted")] if "_accepted" in rows.columns else []
    per_bid = rows.groupBy("order_id", "bid_id").agg(
        count_when(F.col("_new_auction")).alias("n_auctions"), F.count(F.lit(1)).alias("n_assigned"), *[F.bool_or(name).alias(name) for name in flags],
        F.bool_or("is_winning").alias("has_winning_bid"), *[F.bool_or(x).alias("has_accepted_winning_bid") for x in accepted], F.max("_won").alias("_last"), F.min("_won").alias("_first"),
    )
    known = F.col("bid_id").isNotNull()
    return per_bid.groupBy("order_id").agg(
        F.sum("n_auctions").alias("n_auctions"), F.sum("n_assigned").alias("n_assigned"), *[count_when(known & F.col(name)).alias(name) for name in flags],
        F.bool_or("has_winning_bid").alias("has_winning_bid"), *[F.bool_or("has_accepted_winning_bid").alias("has_accepted_winning_bid") for _ in accepted],
        F.max("_last").alias("_last"), F.min("_first").alias("_first"),
    ).withColumns({"supplier_id": F.col("_last.supplier_id"), "winning_margin_cents": F.col("_last.margin_cents"), "first_winning_margin_cents": F.col("_first.margin_cents")}).drop("_last", "_first")


def rfq_funnel(behaviour: DataFrame) -> DataFrame:
    """Per order: suppliers asked and answered in requests for quotation."""
    answered = F.col("n_responses") if "_won" in behaviour.columns else F.col("placed_at").isNotNull()
    return behaviour.filter("is_rfq").groupBy("order_id").agg(
        F.bool_or("is_winning").alias("is_sourced_by_rfq"), F.count_distinct("supplier_id").alias("n_suppliers_asked"),
        F.count_distinct(F.when(answered, F.col("supplier_id"))).alias("n_suppliers_answered"), F.count_distinct("auction_id").alias("n_rfqs"),
        F.count(F.lit(1)).alias("n_requests"), count_when(answered).alias("n_answers"),
    )
