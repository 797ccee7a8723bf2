"""Which lines need a quality check: dispute rates of supplier, attributes and country, and a rule string."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import any_of, count_when, is_true
from millrace.functions.dates import add_part
from millrace.operators.keyed import attach
from millrace.operators.windows import first_rows
from millrace.sources.session import cut_lineage

# Dispute window in days, rows of the moving window, thresholds (percent, counts, price in cents).
DISPUTE_DAYS = 14
ROWS = 6
RECENT_PERCENT, RUNNING_PERCENT, MIN_HISTORY, MANY_INTERACTIONS, HIGH_PRICE_CENTS = 9, 3, 10, 36, 60_000


def week_index(ts: str) -> Column:
    """Weeks since a fixed Monday."""
    return F.floor(F.datediff(F.trunc(F.col(ts), "week"), F.lit("1970-01-05").cast("date")) / F.lit(7)).cast("int")


def percent(part: str, whole: str) -> Column:
    """Rounded percentage in integers, null without disputes or without lines."""
    p, w = F.nullif(part, F.lit(0)), F.nullif(whole, F.lit(0))
    return F.floor((p * 200 + w) / (w * 2))


def weekly(lines: DataFrame, k: list[str]) -> DataFrame:
    counted = lines.filter("delivered_at is not null").withColumn("week", week_index("delivered_at"))
    inside = is_true(F.col("disputed_at") <= add_part("delivered_at", DISPUTE_DAYS, "day"))
    return counted.groupBy(*k, "week").agg(F.count(F.lit(1)).alias("n_lines"), count_when(inside).alias("n_disputes"))


def history_at(rows: DataFrame, k: list[str]) -> DataFrame:
    """Counts of CNC lines over the last weeks and since the start, for the weeks in which lines are shipped, and whether the key has a CNC line at all.

    Instead of a dense key x week grid, only the weeks asked for are added (with zero counts) to the weeks that have
    lines; a range over the week number then covers the same calendar weeks. Each line gives both its entries at once, so there is one shuffle of partial sums and one of sums.
    """
    made, zero, one = is_true(F.col("technology") == "CNC"), F.lit(0).cast("long"), F.lit(1).cast("long")
    inside = is_true(F.col("disputed_at") <= add_part("delivered_at", DISPUTE_DAYS, "day"))
    asked = F.struct(F.col("week"), zero.alias("n_lines"), zero.alias("n_disputes"), made.alias("_made"))
    delivered = F.struct(week_index("delivered_at").alias("week"), one.alias("n_lines"), F.when(inside, one).otherwise(zero).alias("n_disputes"), made.alias("_made"))
    entries = F.when(made & F.col("delivered_at").isNotNull(), F.array(asked, delivered)).otherwise(F.array(asked))
    both = rows.select(*k, F.inline(entries)).groupBy(*k, "week").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_disputes").alias("n_disputes"), F.max("_made").alias("_made"))
    w = Window.partitionBy(*k).orderBy("week")
    recent, running = w.rangeBetween(1 - ROWS, 0), w.rangeBetween(Window.unboundedPreceding, 0)
    sums = both.select(
        *k, "week", F.sum("n_lines").over(recent).alias("_lr"), F.sum("n_disputes").over(recent).alias("_dr"),
        F.sum("n_lines").over(running).alias("lines_so_far"), F.sum("n_disputes").over(running).alias("_da"), F.max("_made").over(Window.partitionBy(*k)).alias("_known"),
    )
    return sums.select(*k, "week", percent("_dr", "_lr").alias("recent_percent"), percent("_da", "lines_so_far").alias("running_percent"), "lines_so_far", "_known")


def with_histories(rows: DataFrame, k: list[str], parts: list[str]) -> DataFrame:
    """The rows with what ``history_at`` tells of their week, for the keys ``k`` (recent_percent, running_percent, lines_so_far, _known) and for the part of them in ``parts`` (part_percent, of recent weeks).

    Nothing is joined back: a row is an entry of its week, a delivered CNC line one more that comes in its week and one that goes ROWS weeks later, and running totals over the weeks see both histories. So rows are dealt
    once, by ``parts``; those of one ``parts`` are sorted in one task, which holds no more than a few of them at a time. Rows that lack a part of a key have no history by it.
    """
    made, zero, one = is_true(F.col("technology") == "CNC"), F.lit(0).cast("long"), F.lit(1).cast("long")
    bad = F.when(is_true(F.col("disputed_at") <= add_part("delivered_at", DISPUTE_DAYS, "day")), one).otherwise(zero)
    row, none, week = F.struct(*rows.columns), F.when(F.lit(False), F.struct(*rows.columns)), week_index("delivered_at")

    def entry(week: Column, row: Column, *counts: Column) -> Column:
        return F.struct(week.cast("int").alias("_week"), row.alias("_row"), *[n.alias(name) for n, name in zip(counts, ("_l", "_d", "_lr", "_dr"), strict=True)])

    asked = entry(F.col("week"), row, zero, zero, zero, zero)
    delivered = [entry(week, none, one, bad, one, bad), entry(week + ROWS, none, zero, zero, -one, -bad)]
    entries = F.when(made & F.col("delivered_at").isNotNull(), F.array(asked, *delivered)).otherwise(F.array(asked))
    rows = rows.select(*k, made.alias("_made"), F.inline(entries))
    for keys, names in ((parts, ("_lr", "_dr")), (k, ("_l", "_d", "_lr", "_dr"))):  # the fewer keys first, so that its dealing serves both
        upto = Window.partitionBy(*keys).orderBy("_week").rangeBetween(Window.unboundedPreceding, 0)
        rows = rows.select("*", *[F.sum(n).over(upto).alias(f"{n}_{len(keys)}") for n in names])
    rows = rows.withColumn("_known", F.max("_made").over(Window.partitionBy(*k))).filter("_row is not null")
    n, m = len(k), len(parts)
    found = {
        "recent_percent": (percent(f"_dr_{n}", f"_lr_{n}"), k), "running_percent": (percent(f"_d_{n}", f"_l_{n}"), k), "lines_so_far": (F.col(f"_l_{n}"), k), "_known": (F.col("_known"), k),
        "part_percent": (percent(f"_dr_{m}", f"_lr_{m}"), parts),
    }
    known = lambda keys: reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in keys])
    return rows.select("_row.*", *[F.when(known(keys), c).alias(name) for name, (c, keys) in found.items()])


def qc_risk_score(lines: DataFrame, interactions: DataFrame, suppliers: DataFrame, checked_places: Column, as_of: str) -> DataFrame:
    """Should a line be checked, its ten rule bits in order of importance, and the dispute share of its bit string.

    lines: line_id, order_id, supplier_id, country, material, finish, tolerance, technology, price_cents, shipped_at,
    delivered_at, disputed_at, is_cosmetic, has_note, is_cross_docking; interactions: order_id, n; suppliers: supplier_id, supplier_place.
    """
    attributes = ["supplier_id", "material", "finish", "tolerance_key"]
    rows = lines.withColumns({"tolerance_key": F.coalesce("tolerance", F.lit("null")), "week": week_index("shipped_at")}).filter("shipped_at is not null")
    rows = rows.join(interactions, "order_id", "left")  # lines come dealt by order, as the interactions are
    c = F.col
    early = [*attributes, "week", "line_id", "order_id", "country", "technology", "shipped_at", "delivered_at", "disputed_at", "is_cross_docking"]
    facts = [c("price_cents") > HIGH_PRICE_CENTS, c("tolerance").isNotNull(), c("n") >= MANY_INTERACTIONS, is_true("is_cosmetic"), is_true("has_note")]
    facts = {f"_rule_{i}": is_true(rule) for i, rule in enumerate(facts)}
    # dealt by supplier before they meet the suppliers, whichever way that is done, and before each becomes several entries: both histories need them so
    rows = rows.select(*early, *[rule.alias(name) for name, rule in facts.items()]).repartition("supplier_id").join(suppliers, "supplier_id")
    rows = with_histories(rows.select(*early, is_true(checked_places).alias("_checked"), *facts), attributes, ["supplier_id"])
    price, tolerance, interacted, cosmetic, note = facts
    history = c("_known")  # attributes of suppliers without any CNC line have no history at all
    rules = [
        c(price), c(tolerance), history & (c("lines_so_far") < MIN_HISTORY), history & (c("running_percent") >= RUNNING_PERCENT),
        c(interacted), history & (c("recent_percent") >= RECENT_PERCENT), c(cosmetic), c(note), c("part_percent") >= RECENT_PERCENT,
    ]
    bits = F.concat(*[F.when(is_true(rule), "1").otherwise("0") for rule in rules])
    # countries and rates are counted from all lines, which are written once, with what is left to know of them
    rows = cut_lineage(rows.select(*early[len(attributes):], "_checked", bits.alias("_bits")), "qc-lines")
    w = Window.partitionBy("country").orderBy("week").rowsBetween(1 - ROWS, 0)
    per_country = weekly(rows.drop("week").filter("technology = 'CNC'"), ["country"]).select("country", "week", F.sum("n_lines").over(w).alias("_l"), F.sum("n_disputes").over(w).alias("_d"))
    per_country = cut_lineage(per_country.select("country", "week", percent("_d", "_l").alias("country_percent")), "qc-countries")
    out = rows.join(per_country, ["country", "week"], "left")
    bits = F.concat("_bits", F.when(is_true(c("country_percent") >= RECENT_PERCENT), "1").otherwise("0"))
    should = (bits.contains("1") | is_true(c("technology") != "CNC")) & c("_checked")
    scored = out.select("line_id", "order_id", "shipped_at", "is_cross_docking", c("disputed_at").isNotNull().alias("is_disputed"), should.alias("should_check"), bits.alias("rule_bits"))
    since = F.add_months(F.trunc(F.lit(as_of).cast("date"), "quarter"), -12).cast("timestamp_ntz")
    judged = scored.filter(c("is_cross_docking") & c("should_check") & (c("shipped_at") >= since))
    rates = judged.groupBy("rule_bits").agg(count_when(c("is_disputed")).alias("_d"), F.count(F.lit(1)).alias("_n")).filter("_d > 0")
    rates = cut_lineage(rates.select("rule_bits", (c("_d") * 100 / c("_n")).alias("dispute_rate")), "qc-rates")
    return attach(scored.drop("shipped_at", "is_cross_docking", "is_disputed"), rates, ["rule_bits"], null_keys=False)


def latest_labels(geometry: DataFrame) -> DataFrame:
    """Labels of the newest geometry run per model, one row per label set."""
    newest = first_rows(geometry, ["model_id"], ["-updated", "run_id"])
    return newest.select("model_id", F.inline("labels"))


def qc_feature_table(lines: DataFrame, geometry: DataFrame, as_of: str, months: int = 36) -> DataFrame:
    """Features and outcome per CNC part line that went through a cross dock, and whether it may train a model."""
    now = F.lit(as_of).cast("timestamp_ntz")
    wanted = lines.filter("is_cross_docking and is_sourced and technology = 'CNC' and line_type = 'part'")
    wanted = wanted.filter((F.col("delivered_at") >= add_part(now, -months, "month")) | F.col("delivered_at").isNull())
    out = wanted.join(latest_labels(geometry), "model_id", "left")
    trainable = F.col("delivered_at").between(add_part(now, -months, "month"), add_part(now, -1, "month")) & F.col("order_status").isin("completed", "disputed")
    return out.select(
        "line_id", "delivered_at", is_true("has_issue").alias("has_issue"), is_true("is_cosmetic").alias("is_cosmetic"),
        is_true(F.col("origin_region") == F.col("destination_region")).alias("is_local"), F.coalesce("lead_time", F.lit(0)).alias("lead_time"), "finish", "tolerance", "quantity",
        (F.col("price_cents") / F.col("quantity")).alias("price_per_part"), "complexity", "rigidity", is_true(trainable).alias("is_training_data"),
    ).distinct()
