"""Advertising, e-mail, search and page reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import count_when, ladder, page_of, split_part, url_host, url_parameter, url_path
from millrace.functions.dates import day
from millrace.operators.keyed import attach

# Market codes of a campaign name and their group; words of a campaign name and their group.
MARKET_GROUPS = [
    (["US", "CA", "US-CA", "USCA"], "US/CA"),
    (["GB", "IE", "UKI"], "UKI"),
    (["DACH", "DE", "AT", "CH", "PL", "HU", "CZ", "SK"], "DACH"),
    (["FR"], "FR"),
    (["IT"], "IT"),
    (["NEUR", "BE", "NL", "BN", "DK", "FI", "NO", "SE", "EU"], "NEUR"),
]
CAMPAIGN_WORDS = [
    ("cnc-machining", "CNC"), ("injection-molding", "IM"), ("3d-printing", "3DP"), ("competitors", "Competitors"),
    ("manufacturing", "Manufacturing"), ("branded", "Brand"), ("sheet-metal", "SM"),
]


def url_traffic_report(pages: DataFrame) -> DataFrame:
    """Pages by host, path depth and campaign parameter."""
    path = url_path("url")
    depth = F.when(path == "", 0).otherwise(F.size(F.split(F.regexp_replace(path, "/$", ""), "/")))
    return pages.groupBy(
        url_host("url").alias("host"), depth.alias("path_depth"), url_parameter("url", "utm_source").alias("utm_source")
    ).agg(F.count(F.lit(1)).alias("n_pages"))


def json_property_rollup(events: DataFrame, paths: dict[str, str], k: list[str]) -> DataFrame:
    """Numeric properties out of JSON text (unreadable ones are null), summed per key."""
    values = {name: F.get_json_object("props", path).try_cast("double") for name, path in paths.items()}
    typed = events.select(*k, *[v.alias(n) for n, v in values.items()])
    aggs = [a for n in paths for a in (F.sum(n).alias(f"sum_{n}"), F.max(n).alias(f"max_{n}"), F.count(n).alias(f"n_{n}"))]
    return typed.groupBy(*k).agg(*aggs)


def email_funnel(events: DataFrame, campaigns: DataFrame, contacts: DataFrame) -> DataFrame:
    """Sent, delivered, opened and clicked per campaign and recipient; mechanical opens and clicks do not count.

    events: campaign_id, group_id, recipient, type, filtered, device.
    """
    real = ~F.col("filtered")

    def n(kind: str, cond: Column | None = None) -> Column:
        hit = F.col("type") == kind
        return count_when(hit if cond is None else hit & cond)

    per_recipient = events.groupBy(F.coalesce("group_id", "campaign_id").alias("campaign_id"), "recipient").agg(
        F.min(F.when((F.col("type") == "OPEN") & real, F.col("device"))).alias("device"), n("SENT").alias("p_sent"), n("DROPPED").alias("dropped"),
        n("DELIVERED").alias("delivered"), n("BOUNCE").alias("bounced"), n("OPEN", real).alias("opened"), n("CLICK", real).alias("clicked"),
    ).filter("p_sent > 0")
    out = per_recipient.join(campaigns, "campaign_id", "left").join(contacts, "recipient", "left")
    sent = F.col("p_sent") - F.col("dropped")
    return out.select(
        "campaign_id", "campaign_name", "contact_id", F.md5(F.col("recipient").cast("string")).alias("recipient"), F.coalesce("device", F.lit("UNKNOWN")).alias("device"),
        sent.alias("sent"), (sent > 0).alias("is_sent"), "delivered", (F.col("delivered") > 0).alias("is_delivered"), "bounced",
        "opened", (F.col("opened") > 0).alias("is_opened"), "clicked", (F.col("clicked") > 0).alias("is_clicked"),
    )


def keyword_performance(reports: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Daily keyword figures of several ad networks; a campaign deleted from the network's list keeps its
    last reported name. reports: (source, report, campaign list)."""
    out = None
    for source, report, campaigns in reports:
        last = report.groupBy("campaign_id").agg(F.max_by("reported_name", F.struct("at", "reported_name")).alias("_last"))
        named = attach(attach(report, last, ["campaign_id"]), campaigns.select("campaign_id", "campaign_name"), ["campaign_id"])
        daily = named.groupBy(
            day("at").alias("date"), F.lit(source).alias("source"), "campaign_id", F.coalesce("campaign_name", "_last").alias("campaign_name"), "keyword_id"
        ).agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.sum("cost_cents").alias("cost_cents"))
        out = daily if out is None else out.unionByName(daily)
    return out


def ad_spend_daily(keywords: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Keyword spend plus what the campaign report has beyond its keywords, with the campaign name taken apart.

    Both: date, source, campaign_id, campaign_name, impressions, clicks, cost_cents (keywords also keyword_id).
    """
    k = ["date", "source", "campaign_id"]
    measures = ["impressions", "clicks", "cost_cents"]
    whole = campaigns.groupBy(*k, "campaign_name").agg(*[F.sum(m).alias(m) for m in measures])
    explained = keywords.groupBy(*k).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    rest = attach(whole, explained, k).select(
        *k, "campaign_name", F.lit(None).cast("long").alias("keyword_id"), *[(F.col(m) - F.coalesce(f"_{m}", F.lit(0))).alias(m) for m in measures]
    ).filter(~F.col("cost_cents").between(-3, 3))
    return campaign_parts(keywords.select(rest.columns).unionByName(rest))


def spend_by_grain(daily: DataFrame, grains: list[str]) -> DataFrame:
    """Daily spend rolled up to several calendar grains in one pass."""
    starts = F.array(*[F.struct(F.lit(g).alias("grain"), F.trunc("date", g).alias("start")) for g in grains])
    rows = daily.select("source", "campaign_group", "clicks", "cost_cents", F.inline(starts))
    return rows.groupBy("grain", "source", "campaign_group", "start").agg(F.sum("clicks").alias("clicks"), F.sum("cost_cents").alias("cost_cents"))


def campaign_parts(df: DataFrame) -> DataFrame:
    """Network, language, market and group from a name like 'SN_EN_US_branded'."""
    name, network, market = F.col("campaign_name"), F.col("campaign_network"), F.col("campaign_market")
    parts = df.withColumns({
        "campaign_network": split_part(name, "_", 1), "campaign_language": split_part(name, "_", 2),
        "campaign_market": split_part(name, "_", 3), "campaign_detail": split_part(name, "_", 4),
    })
    return parts.withColumns({
        "market_group": ladder([(market.isin(codes), label) for codes, label in MARKET_GROUPS], "Other"),
        "campaign_group": ladder(
            [(network.isin("DN", "VN"), "Display"), *[(name.contains(word), label) for word, label in CAMPAIGN_WORDS]], "Other"
        ),
    })


def search_console(rows: DataFrame, page_groups: DataFrame, targets: DataFrame) -> DataFrame:
    """Search results per page and keyword with language, page group and target flag. rows: url, keywords, position, impressions, clicks."""
    page = page_of(F.col("url"))
    first = split_part(page, "/", 2)
    out = rows.withColumns({
        "page": page, "language": F.when(F.length(first) == 2, first).otherwise("en"), "target_id": F.concat("url", "keywords"),
    })
    out = out.join(page_groups.withColumnRenamed("page", "_page"), F.lower("page") == F.col("_page"), "left").drop("_page")
    out = out.join(targets.select("target_id").distinct().withColumn("_t", F.lit(True)), "target_id", "left")
    return out.select(
        "url", "page", "language", "keywords", F.coalesce("page_group", F.lit("Ungrouped")).alias("page_group"), "position", "impressions", "clicks",
        F.col("_t").isNotNull().alias("is_target"),
    )


def page_metrics(visits: DataFrame, page_groups: DataFrame, hosts: list[str]) -> DataFrame:
    """Page figures per day with traffic-weighted time. visits: date, url, entrances, pageviews, time_ms."""
    seen = visits.filter((F.col("url") != "") & ((F.col("entrances") > 0) | (F.col("pageviews") > 0) | (F.col("time_ms") > 0)))
    page = page_of(F.col("url"))
    first = split_part(page, "/", 2)
    out = seen.withColumns({"host": url_host("url"), "page": page})
    out = out.filter(F.col("host").rlike("|".join(hosts)))
    out = out.join(page_groups.withColumnRenamed("page", "_page"), F.lower("page") == F.col("_page"), "left").drop("_page")
    grouped = out.groupBy(
        "date", "host", "url", "page", F.coalesce("page_group", F.lit("Ungrouped")).alias("page_group"),
        F.when(F.length(first) == 2, F.regexp_replace(first, "js", "en")).otherwise("en").alias("language"),
    ).agg(
        F.sum("entrances").alias("entrances"), F.sum("pageviews").alias("pageviews"), (F.sum("time_ms") / F.count(F.lit(1))).alias("time_per_pageview"),
    )
    return grouped.withColumns({
        "time_weighted": F.col("time_per_pageview") * F.col("pageviews"), "test_name": url_parameter("url", "ref"), "test_variant": url_parameter("url", "page"),
    })


def marketing_sheets(sheet: DataFrame) -> DataFrame:
    """A hand-kept sheet with text cells brought to types; unreadable cells are null."""
    return sheet.select(
        F.col("month").try_cast("date").alias("month"), F.nullif(F.trim("country"), F.lit("")).alias("country"), F.nullif(F.trim("category"), F.lit("")).alias("category"),
        F.col("search_volume").try_cast("bigint").alias("search_volume"), (F.col("cost").try_cast("bigint") / F.lit(100)).alias("cost"), F.col("notes"),
    )
