"""Projection, cleaning and predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, register
from millrace.functions.columns import cents
from millrace.functions.dates import epoch_us
from millrace.operators import projections as P
from millrace.sources import frames

# Pattern rules of the part classification, first match wins.
PART_RULES = [("ring|washer", "fastening"), ("bolt|nut|screw", "threaded"), ("gear|gizmo", "drive"), ("^(red|blue|green)", "coloured")]


@register("base_projection", """
    select c_custkey as customer_id, trim(c_name) as customer_name, upper(c_mktsegment) as segment,
           round(c_acctbal * 100)::bigint as balance_cents, c_acctbal < 0 as is_overdrawn
    from customer""")
def base_projection(t):
    return P.base_projection(t["customer"], {
        "customer_id": "c_custkey", "customer_name": F.trim("c_name"), "segment": F.upper("c_mktsegment"),
        "balance_cents": cents("c_acctbal"), "is_overdrawn": F.col("c_acctbal") < 0,
    })


@register("star_except", """
    select p_partkey as part_p_partkey_src, p_name as part_p_name_src, p_size::bigint as part_p_size_src from part""")
def star_except(t):
    return P.star_except(t["part"], ["p_brand", "p_type", "p_retailprice"], "part_", "_src")


@register("empty_to_null", S.ctes(S.MESSY_CUSTOMER) + """
    select c_custkey, nullif(c_name, '') as c_name, c_nationkey::bigint as c_nationkey, nullif(c_mktsegment, '') as c_mktsegment,
           nullif(balance_cents, '') as balance_cents, nullif(is_strategic, '') as is_strategic, nullif(nation_text, '') as nation_text
    from messy_customer""")
def empty_to_null(t):
    return P.empty_to_null(frames.messy_customer(t))


@register("clean_boolean_columns", S.ctes(S.MESSY_CUSTOMER) + """
    select c_custkey, case is_strategic when 'true' then true when 'false' then false end as is_strategic from messy_customer""")
def clean_boolean_columns(t):
    return P.clean_boolean_columns(frames.messy_customer(t).select("c_custkey", "is_strategic"), ["is_strategic"])


@register("clean_typed_columns", S.ctes(S.MESSY_CUSTOMER) + """
    select 'clean' as part, c_custkey::varchar as item, try_cast(balance_cents as bigint) as balance_cents, try_cast(nation_text as bigint) as nation_id
    from messy_customer
    union all select 'rejected', 'balance_cents', count(*) filter (where try_cast(balance_cents as bigint) is null), null from messy_customer
    union all select 'rejected', 'nation_text', count(*) filter (where try_cast(nation_text as bigint) is null), null from messy_customer""")
def clean_typed_columns(t):
    clean, rejects = P.clean_typed_columns(frames.messy_customer(t), {"balance_cents": "bigint", "nation_text": "bigint"})
    rows = clean.select(F.lit("clean").alias("part"), F.col("c_custkey").cast("string").alias("item"), "balance_cents", F.col("nation_text").alias("nation_id"))
    bad = rejects.select(F.lit("rejected"), "column_name", "rejected", F.lit(None).cast("long"))
    return rows.unionAll(bad)


@register("normalise_event_times", """
    select event_id, epoch_us(ts) // 1000 as raw_millis, date_trunc('millisecond', ts)::timestamp as at,
           date_trunc('second', ts)::timestamp as at_second from events""")
def normalise_event_times(t):
    raw = t["events"].select("event_id", F.floor(epoch_us("ts") / F.lit(1000)).alias("raw_millis"))
    raw = raw.withColumn("raw_seconds", F.floor(F.col("raw_millis") / F.lit(1000)))
    out = P.normalise_event_times(raw, "raw_millis", "millis", "at")
    return P.normalise_event_times(out, "raw_seconds", "seconds", "at_second").drop("raw_seconds")


@register("derived_column_chain", """
    select o_orderkey, net_cents, fee_cents, net_cents - fee_cents as payout_cents, net_cents - fee_cents > 20000000 as is_large
    from (select *, net_cents // 20 as fee_cents from (select o_orderkey, round(o_totalprice * 100)::bigint * 80 // 100 as net_cents from orders))""")
def derived_column_chain(t):
    orders = t["orders"].select("o_orderkey", cents("o_totalprice").alias("gross"))
    return P.derived_column_chain(orders, [
        ("net_cents", F.expr("gross * 80 div 100")),
        ("fee_cents", F.expr("net_cents div 20")),
        ("payout_cents", F.col("net_cents") - F.col("fee_cents")),
        ("is_large", F.col("payout_cents") > 20_000_000),
    ]).drop("gross")


@register("classify_first_match", """
    select p_partkey, p_name, case when regexp_matches(lower(p_name), 'ring|washer') then 'fastening'
      when regexp_matches(lower(p_name), 'bolt|nut|screw') then 'threaded' when regexp_matches(lower(p_name), 'gear|gizmo') then 'drive'
      when regexp_matches(lower(p_name), '^(red|blue|green)') then 'coloured' else 'unknown' end as part_group
    from part""")
def classify_first_match(t):
    return P.classify_first_match(t["part"].select("p_partkey", "p_name"), "p_name", PART_RULES, "unknown", "part_group")


@register("map_codes_and_count", """
    select case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else 'other' end as label, count(*) as num_rows from orders group by 1""")
def map_codes_and_count(t):
    return P.map_codes_and_count(t["orders"], "o_orderstatus", {"F": "finished", "O": "open"}, "other")


@register("banded_score", """
    select c_custkey, case when c_acctbal >= 7500 then 4 when c_acctbal >= 5000 then 3 when c_acctbal >= 0 then 2 else 1 end::bigint as score
    from customer""")
def banded_score(t):
    return P.banded_score(t["customer"].select("c_custkey", "c_acctbal"), F.col("c_acctbal"), [(7500, 4), (5000, 3), (0, 2)], 1, "score").drop("c_acctbal")


@register("histogram_width_bucket", """
    select (case when p_retailprice < 950 then 0 when p_retailprice >= 1050 then 5 else floor((p_retailprice - 950) / 25) + 1 end)::bigint as bucket,
           count(*) as num_rows from part group by 1""")
def histogram_width_bucket(t):
    return P.histogram_width_bucket(t["part"], "p_retailprice", 950, 1050, 4)


@register("filter_test_traffic", """
    select event_id, user_id, event_type from events
    where not (coalesce(user_id % 10 = 3, false) or coalesce(value < 1, false) or coalesce(nullif(event_type, 'view') = 'error', false))
       or user_id = 13""")
def filter_test_traffic(t):
    rules = [F.col("user_id") % 10 == 3, F.col("value") < 1, F.nullif("event_type", F.lit("view")) == "error"]
    return P.filter_test_traffic(t["events"], rules, F.col("user_id") == 13).select("event_id", "user_id", "event_type")


@register("spam_recipients", """
    with sends as (select user_id * 1000 + day(ts) as recipient, event_type from events)
    select recipient from sends group by 1 having bool_or(event_type = 'error') and not bool_or(event_type = 'purchase')""")
def spam_recipients(t):
    sends = t["events"].select((F.col("user_id") * 1000 + F.dayofmonth("ts")).alias("recipient"), "event_type")
    return P.spam_recipients(sends, "recipient", "event_type", ["error"], ["purchase"])


@register("period_filter", "select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '1999-01-01'")
def period_filter(t):
    return P.period_filter(t["orders"].select("o_orderkey", "o_orderdate"), "o_orderdate", 2, "year", AS_OF)


@register("unit_conversion", """
    select l_orderkey, l_partkey, l_suppkey, l_shipdate, l_quantity as weight_kg, l_extendedprice as length_cm from lineitem where l_returnflag <> 'A'
    union all
    select l_orderkey, l_partkey, l_suppkey, l_shipdate, l_quantity * 0.45359237::double, l_extendedprice * 2.54::double from lineitem where l_returnflag = 'A'""")
def unit_conversion(t):
    measures = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", F.col("l_quantity").alias("weight_kg"), F.col("l_extendedprice").alias("length_cm"), "l_returnflag"
    )
    metric, imperial = measures.filter("l_returnflag <> 'A'"), measures.filter("l_returnflag = 'A'")
    # Kilograms per pound, centimetres per inch.
    return P.unit_conversion([(metric, {}), (imperial, {"weight_kg": 0.45359237, "length_cm": 2.54})]).drop("l_returnflag")
