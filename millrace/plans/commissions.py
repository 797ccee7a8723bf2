"""Sales commissions: target intervals, monthly and quarterly components, onboarding bonuses.

Money is in whole cents; a fee is in basis points, and every commission is rounded half up to the cent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import is_true, ladder, zero
from millrace.functions.dates import month
from millrace.operators.joins import asof_scd2_join, interval_expand_join
from millrace.operators.keyed import attach

# Attainment (in 5 % steps of the target, so 15 is 75 %) and the share of the bonus that it earns.
BONUS_SCALE = [
    (15, 0.30), (16, 0.50), (17, 0.70), (18, 0.90), (19, 0.95), (20, 1.00), (21, 1.05), (22, 1.10),
    (23, 1.188), (24, 1.275), (25, 1.363), (26, 1.45), (27, 1.538), (28, 1.625), (29, 1.713), (30, 1.80),
]
TOP_STEP = 30


def commission_rules(targets: DataFrame) -> DataFrame:
    """Target intervals to one row per representative and month whose first day lies in the interval."""
    months = interval_expand_join(targets, "start_date", "end_date", "month", "month")
    return months.filter(F.col("month") >= F.to_date("start_date")).drop("start_date", "end_date")


def fee(amount: Column, basis_points: Column) -> Column:
    return F.floor((amount * basis_points + 5000) / F.lit(10000))


def quarter(ts: str) -> Column:
    return F.trunc(F.col(ts), "quarter")


def commission_monthly(orders: DataFrame, rules: DataFrame, companies: DataFrame, big_deal_cents: int, double_fee_since: str, handover_change: str) -> DataFrame:
    """All monthly components per deal and representative, and their total.

    orders: order_id, rep_id, bdr_id, closed_at, sourced_at, cancelled_at, delivered_at, subtotal_cents, shipping_cents, crm_cents, has_gap.
    One join on the closing month yields every component that depends on it, one on the cancellation month the deductions.
    """
    closed, cancelled = month("closed_at"), month("cancelled_at")
    amount = F.col("subtotal_cents") - zero("shipping_cents")
    live = F.col("cancelled_at").isNull()
    as_bdr = is_true(F.col("bdr_id") == F.col("rep_id")) & (F.col("role") == "outside")
    big = is_true(F.col("subtotal_cents") - F.col("shipping_cents") > big_deal_cents)
    base = live | (cancelled != closed)
    unsourced = F.col("sourced_at").isNull() | (month("sourced_at") > closed)
    earned = fee(amount, F.col("monthly_fee_bp"))
    doubled = F.when(F.col("closed_at") > F.lit(double_fee_since).cast("timestamp_ntz"), 2).otherwise(1)
    late = is_true(F.col("closed_at") < month("sourced_at").cast("timestamp_ntz"))

    def part(plan: str, at: Column, cents: Column, cond: Column, who: str) -> Column:
        met = cond if who == "owner" else cond & as_bdr
        return F.when(met, F.struct(F.lit(plan).alias("plan"), F.lit(who).alias("who"), at.alias("month"), cents.alias("cents")))

    parts = []
    for who in ("owner", "bdr"):
        own_fee = earned if who == "owner" else fee(amount, F.col("monthly_fee_bp") * doubled)
        parts += [
            part("Deal Monthly Base" if who == "owner" else "BDR Monthly Base", closed, own_fee, base, who),
            part("Big Deals Excluded", closed, -earned, live & big & unsourced, who),
            part("Significant Amount Gap Deals Excluded", closed, -earned, live & F.col("has_gap"), who),
            part("Big Deals Commission", month("sourced_at"), earned, big & late, who),
            part("Significant Amount Gap Deals Commission", month("delivered_at"), fee(F.col("crm_cents"), F.col("monthly_fee_bp")), live & F.col("has_gap"), who),
        ]
    ruled = rules.select(F.col("rep_id").alias("_rep"), F.col("month").alias("_month"), "role", "monthly_fee_bp")
    signed = orders.filter("closed_at is not null").withColumn("_closed", closed)
    on_close = signed.join(ruled, (F.col("rep_id") == F.col("_rep")) & (F.col("_closed") == F.col("_month")))
    details = on_close.select("order_id", "rep_id", F.inline(F.array_compact(F.array(*parts))))
    gone = signed.filter("cancelled_at is not null").withColumn("_gone", cancelled)
    gone = gone.filter(F.col("_closed").between(F.add_months("_gone", -3), F.add_months("_gone", -1)))
    on_cancel = gone.join(ruled, (F.col("rep_id") == F.col("_rep")) & (F.col("_gone") == F.col("_month")))
    back = F.array_compact(F.array(*[part("Cancellations Deduction", F.col("_gone"), -earned, F.lit(True), who) for who in ("owner", "bdr")]))
    deductions = on_cancel.select("order_id", "rep_id", F.inline(back))
    no_order = F.lit(None).cast("long").alias("order_id")
    ramping = rules.select(no_order, "rep_id", F.lit("Ramping Compensation").alias("plan"), F.lit("owner").alias("who"), "month", F.col("compensation_cents").alias("cents"))
    handover = companies.filter("owner_id is not null").withColumn("_at", month("handover_at")).join(
        ruled.filter("role = 'outside'"), (F.col("handover_rep_id") == F.col("_rep")) & (F.col("_at") == F.col("_month"))
    )
    # Handover fees in cents.
    handover_fee = ladder([(F.col("handover_at") < F.lit(handover_change).cast("timestamp_ntz"), 35000), (F.col("true_outbound"), 40000)], 20000)
    handover = handover.groupBy(F.col("_rep").alias("rep_id"), F.col("_at").alias("month")).agg(F.sum(handover_fee).alias("cents"))
    handover = handover.select(no_order, "rep_id", F.lit("BDR Handover fee").alias("plan"), F.lit("bdr").alias("who"), "month", "cents")
    every = details.unionByName(deductions).unionByName(ramping).unionByName(handover).filter("month is not null and cents is not null")
    # each component counts once for itself and once for the deal's total
    lines = F.array(F.struct(F.col("plan").alias("p"), F.col("who").alias("w")), F.struct(F.lit("Deal Monthly Total").alias("p"), F.lit("total").alias("w")))
    spread = every.select("order_id", "rep_id", "month", "cents", F.inline(lines))
    return spread.groupBy("order_id", "rep_id", "month", F.col("p").alias("plan"), F.col("w").alias("who")).agg(F.sum("cents").alias("cents"))


def attainment(closed: Column, target: Column) -> Column:
    """Share of the target in 5 % steps, rounded half up, at most 150 %."""
    return F.least(F.floor(closed * 20 / F.nullif(target, F.lit(0)) + 0.5), F.lit(TOP_STEP))


def quarterly_bonus(amounts: DataFrame, targets: DataFrame, on: list[str], plan: str) -> DataFrame:
    """Bonus of a role from the closed amount of its area against its target.

    amounts: on..., quarter, closed_cents; targets: on..., quarter, rep_id, target_cents, base_bonus_cents.
    """
    spark = amounts.sparkSession
    scale = F.broadcast(spark.createDataFrame(BONUS_SCALE, "step int, bonus double"))
    both = targets.join(amounts, [*on, "quarter"])
    both = both.withColumn("step", attainment(F.col("closed_cents"), F.col("target_cents")).cast("int")).join(scale, "step", "left")
    paid = F.col("closed_cents") * 4 > F.col("target_cents") * 3
    cents = F.when(paid, F.floor(F.col("base_bonus_cents") * F.col("bonus") + 0.5))
    return both.select(
        F.add_months("quarter", 2).alias("month"), "rep_id", F.lit(plan).alias("plan"), "closed_cents", "target_cents", (F.col("step") * 5).alias("percent_of_target"), cents.alias("cents"),
    )


def commission_quarterly(orders: DataFrame, rules: DataFrame, owners: DataFrame, bonuses: list[tuple[str, str, int]]) -> DataFrame:
    """Area bonuses, lead bonuses and strategic commissions per quarter.

    orders: order_id, rep_id, company_id, region, closed_at, cancelled_at, subtotal_cents, shipping_cents, is_strategic;
    owners: company ownership versions (company_id, owner_id, valid_from, valid_to); bonuses: (role, plan, base bonus in cents).
    """
    amount = F.col("subtotal_cents") - zero("shipping_cents")
    live = orders.filter("cancelled_at is null and closed_at is not null").withColumns({"_q": quarter("closed_at"), "_m": month("closed_at"), "_amount": amount})
    per_region = live.groupBy("region", F.col("_q").alias("quarter")).agg(F.sum("_amount").alias("closed_cents"))
    in_quarter = rules.withColumn("quarter", F.trunc("month", "quarter"))
    out = None
    for role, plan, base in bonuses:
        targets = in_quarter.filter(F.col("role") == role).groupBy("quarter", "region", "rep_id").agg(F.sum("monthly_target_cents").alias("target_cents"))
        part = quarterly_bonus(per_region, targets.withColumn("base_bonus_cents", F.lit(base)), ["region"], plan)
        out = part if out is None else out.unionByName(part)
    ruled = rules.select(F.col("rep_id").alias("_rep"), F.col("month").alias("_month"), F.col("role").alias("_role"), "lead_id")
    managed = live.join(ruled, (F.col("rep_id") == F.col("_rep")) & (F.col("_m") == F.col("_month")))
    per_lead = managed.groupBy("lead_id", F.col("_q").alias("quarter")).agg(F.sum("_amount").alias("closed_cents"))
    lead_targets = in_quarter.filter(F.col("role").isin("strategic lead", "inside lead")).groupBy("quarter", F.col("rep_id").alias("lead_id"), "rep_id", "role").agg(
        F.sum("lead_target_cents").alias("target_cents")
    )
    lead_bonus = ladder([(F.col("role") == "inside lead", 400000)], 750000)
    out = out.unionByName(quarterly_bonus(per_lead, lead_targets.withColumn("base_bonus_cents", lead_bonus), ["lead_id"], "Quarterly Leads"))
    owned = asof_scd2_join(managed, owners, [("company_id", "company_id")], "closed_at", ["owner_id"], lambda ts: F.trunc(ts, "quarter"))
    seller = F.when(F.col("_role") == "inside", F.col("owner_id")).otherwise(F.col("rep_id"))
    sold = owned.withColumn("_seller", seller).groupBy(F.col("_seller").alias("rep_id"), F.col("_q").alias("quarter")).agg(
        F.sum(F.when(F.col("is_strategic"), F.col("_amount")).otherwise(0)).alias("strategic_cents"), F.sum("_amount").alias("closed_cents")
    )
    strategic = in_quarter.filter(F.col("role").isin("strategic", "strategic lead")).groupBy("quarter", "rep_id", "quarterly_fee_bp", "above_fee_bp").agg(
        F.sum("monthly_target_cents").alias("target_cents")
    )
    both = strategic.join(sold, ["rep_id", "quarter"])
    paid = F.col("closed_cents") * 4 > F.col("target_cents") * 3
    over = F.col("strategic_cents") - F.col("target_cents")
    lines = F.array(
        F.struct(F.lit("Quarterly Strategic").alias("plan"), F.when(paid, fee(F.col("strategic_cents"), F.col("quarterly_fee_bp"))).alias("cents")),
        F.struct(F.lit("Quarterly Overperformance").alias("plan"), F.when(paid & (over > 0), fee(over, F.col("above_fee_bp"))).alias("cents")),
    )
    rows = both.select(F.add_months("quarter", 2).alias("month"), "rep_id", "closed_cents", "target_cents", F.lit(None).cast("int").alias("percent_of_target"), F.inline(lines))
    return out.unionByName(rows).filter("cents is not null")


def commission_total(monthly: DataFrame, quarterly: DataFrame) -> DataFrame:
    """All non-zero commissions per month and representative."""
    cols = ["month", "rep_id", "plan", "cents"]
    both = monthly.filter("who <> 'total'").select(*cols).unionByName(quarterly.select(*cols))
    return both.filter("cents <> 0").groupBy("month", "rep_id", "plan").agg(F.sum("cents").alias("cents"))


def onboarding_bonus(agents: DataFrame, suppliers: DataFrame, orders: DataFrame, new_scale_from: str) -> DataFrame:
    """Bonus per onboarded supplier and quarter in its first four quarters.

    agents: agent_id, start_at, end_at, suppliers (comma list); suppliers: supplier_id, created_at; orders: supplier_id, sourced_at, cents.
    """
    listed = agents.withColumn("supplier_id", F.explode(F.split("suppliers", ","))).withColumn("supplier_id", F.col("supplier_id").try_cast("bigint"))
    known = listed.join(suppliers, "supplier_id", "left").withColumn("bonus_from", F.trunc("created_at", "quarter"))
    known = known.withColumn("bonus_until", F.date_sub(F.add_months("bonus_from", 12), 1)).drop("suppliers", "created_at")
    windows = known.select("supplier_id", "bonus_from", "bonus_until").distinct()
    daily = orders.filter("sourced_at is not null").groupBy("supplier_id", F.to_date("sourced_at").alias("_day")).agg(F.sum("cents").alias("cents"))
    inside = daily.join(windows, "supplier_id").filter(F.col("_day").between(F.col("bonus_from"), F.col("bonus_until")))
    revenue = inside.select("supplier_id", F.trunc("_day", "quarter").alias("quarter"), "cents")
    revenue = revenue.unionByName(windows.select("supplier_id", F.col("bonus_from").alias("quarter"), F.lit(0).cast("long").alias("cents")))
    revenue = revenue.groupBy("supplier_id", "quarter").agg(F.sum("cents").alias("revenue_cents"))
    out = attach(known, revenue, ["supplier_id"])
    eligible = is_true(F.col("quarter") < F.col("bonus_until"))
    earned, new = F.col("revenue_cents"), F.col("quarter") >= F.lit(new_scale_from).cast("date")
    # Quarterly revenue limits and bonuses, in cents.
    old_scale = ladder([(earned >= 6_000_000, 20000), (earned >= 3_000_000, 10000)], 0)
    new_scale = ladder([(earned > 3_000_000, 60000), (earned > 2_000_000, 30000), (earned > 1_000_000, 20000), (earned > 500_000, 10000)], 0)
    out = out.withColumns({
        "is_eligible": eligible, "onboarding_cents": F.when(F.col("bonus_from") == F.col("quarter"), 5000).otherwise(0),
        "engagement_cents": F.when(eligible, F.when(new, new_scale).otherwise(old_scale)).otherwise(0),
    })
    stays = F.col("end_at").isNull() | (F.trunc("end_at", "quarter") > F.col("quarter"))
    total = F.col("onboarding_cents") + F.col("engagement_cents")
    return out.select(
        "agent_id", "supplier_id", "quarter", "revenue_cents", "bonus_from", "bonus_until", "is_eligible", "onboarding_cents", "engagement_cents",
        F.when(eligible & is_true(stays), total).otherwise(0).alias("payable_cents"), F.when(eligible, F.col("onboarding_cents") + 60000).otherwise(0).alias("potential_cents"),
    )
