"""Set operation, spine and key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import register
from millrace.functions.columns import cents
from millrace.operators import places as P
from millrace.operators import sets as U
from millrace.operators import spines as N
from millrace.sources import frames


@register("union_all", """
    select o_orderkey, 'open' as kind from orders where o_orderstatus <> 'F'
    union all select o_orderkey, 'urgent' from orders where o_orderpriority = '1-URGENT'""")
def union_all(t):
    opened = t["orders"].filter("o_orderstatus <> 'F'").select("o_orderkey", F.lit("open").alias("kind"))
    urgent = t["orders"].filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("urgent").alias("kind"))
    return U.union_all(opened, urgent)


@register("union_distinct", """
    select c_nationkey::bigint as nation_id, c_mktsegment as grp from customer
    union select s_nationkey::bigint, 'SUPPLIER' from supplier""")
def union_distinct(t):
    customers = t["customer"].select(F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("grp"))
    return U.union_distinct(customers, t["supplier"].select(F.col("s_nationkey").alias("nation_id"), F.lit("SUPPLIER").alias("grp")))


@register("union_relations", S.ctes(S.LEGACY_ORDERS) + """
    select 'current' as _source, o_orderkey::varchar as o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, null as channel
    from orders where o_orderdate >= timestamp '1996-01-01'
    union all select 'legacy', o_orderkey::varchar, o_custkey, o_orderstatus, o_totalprice, o_orderdate, null, channel from legacy_orders""")
def union_relations(t):
    current = t["orders"].filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    return U.union_relations({"current": current, "legacy": frames.legacy_orders(t)}, {"o_orderkey": "string"})


@register("except_rows", S.ctes(S.CUSTOMER_V2) + """
    select c_custkey, c_acctbal from customer except select c_custkey, c_acctbal from customer_v2""")
def except_rows(t):
    cols = ["c_custkey", "c_acctbal"]
    return U.except_rows(t["customer"].select(*cols), frames.customer_v2(t).select(*cols))


@register("intersect_rows", S.ctes(S.CUSTOMER_V2) + """
    select c_custkey, c_acctbal from customer intersect select c_custkey, c_acctbal from customer_v2""")
def intersect_rows(t):
    cols = ["c_custkey", "c_acctbal"]
    return U.intersect_rows(t["customer"].select(*cols), frames.customer_v2(t).select(*cols))


@register("source_succession", S.ctes(S.ORDERS_V2) + """
    select 'v2' as layout, o_orderkey, o_orderstatus from orders_v2
    union all select 'v1', o_orderkey, o_orderstatus from orders where o_orderkey not in (select o_orderkey from orders_v2)
    union all select 'before 1998', o_orderkey, o_orderstatus from orders where o_orderdate < timestamp '1998-01-01'
    union all select 'since 1998', o_orderkey, o_orderstatus from orders_v2 where o_orderdate >= timestamp '1998-01-01'""")
def source_succession(t):
    old, new = t["orders"], frames.orders_v2(t)
    by_key = U.source_succession(
        old.select(F.lit("v1").alias("layout"), "o_orderkey", "o_orderstatus"),
        new.select(F.lit("v2").alias("layout"), "o_orderkey", "o_orderstatus"), k=["o_orderkey"],
    )
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    by_date = U.source_succession(
        old.withColumn("layout", F.lit("before 1998")), new.withColumn("layout", F.lit("since 1998")),
        old_until=F.col("o_orderdate") < cut, new_from=F.col("o_orderdate") >= cut,
    )
    return by_key.unionByName(by_date.select("layout", "o_orderkey", "o_orderstatus"))


@register("date_spine", """
    with span as (select s_suppkey, min(l_shipdate) as a, max(l_shipdate) as b from supplier join lineitem on l_suppkey = s_suppkey group by 1)
    select s_suppkey, unnest(generate_series(a, b - interval 1 day, interval 1 day)) as day from span""")
def date_spine(t):
    span = t["lineitem"].groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    return N.spine_per_row(span.join(t["supplier"].select("s_suppkey"), "s_suppkey"), "a", "b", "day", "day").drop("a", "b")


@register("generate_series", """
    select l_orderkey, unnest(generate_series(1, count(*))) as generated_number from lineitem group by 1""")
def generate_series(t):
    sizes = t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return N.series_per_row(sizes, F.col("n")).drop("n")


@register("add_surrogate_key", """
    select l_orderkey, l_partkey, l_shipdate, md5(coalesce(l_orderkey::varchar, '') || '-' || coalesce(l_partkey::varchar, '') || '-' ||
           coalesce(nullif(l_returnflag, 'N'), '') || '-' || coalesce(l_suppkey::varchar, '')) as surrogate_key
    from lineitem""")
def add_surrogate_key(t):
    lines = t["lineitem"].withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return N.add_surrogate_key(lines, ["l_orderkey", "l_partkey", "flag", "l_suppkey"]).select("l_orderkey", "l_partkey", "l_shipdate", "surrogate_key")


@register("assign_unified_ids", """
    select c_custkey, case when c_custkey % 4 <> 0 then md5('company' || c_nationkey) else md5('contact' || c_custkey) end as client_id from customer""")
def assign_unified_ids(t):
    people = t["customer"].withColumn("company", F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")))
    return N.assign_unified_ids(people, [("company", "company"), ("contact", "c_custkey")], "client_id").select("c_custkey", "client_id")


@register("dense_ids_for_labels", "select p_partkey, p_name, dense_rank() over (order by p_name) as name_id from part")
def dense_ids_for_labels(t):
    return N.dense_ids_for_labels(t["part"].select("p_partkey", "p_name"), "p_name", "name_id")


@register("nearest_by_distance", """
    with people as (select c_custkey, (c_nationkey * 7 + c_custkey % 5) % 120 - 60.0::double as lat1, (c_nationkey * 13 + c_custkey % 11) % 340 - 170.0::double as lon1 from customer),
    places as (select s_suppkey, (s_nationkey * 7 + s_suppkey % 5) % 120 - 60.0::double as lat2, (s_nationkey * 13 + s_suppkey % 11) % 340 - 170.0::double as lon2 from supplier),
    measured as (select c_custkey, s_suppkey, round(2 * 3961 * asin(sqrt(power(sin(radians(lat2 - lat1) / 2), 2) +
             cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2))) * 1.60934::double, 6) as distance from people cross join places)
    select c_custkey, distance, s_suppkey from (select *, row_number() over (partition by c_custkey order by distance, s_suppkey) as rn from measured) where rn = 1""")
def nearest_by_distance(t):
    def place(nation, key, lat, lon):
        return {lat: (F.col(nation) * 7 + F.col(key) % 5) % 120 - F.lit(60.0), lon: (F.col(nation) * 13 + F.col(key) % 11) % 340 - F.lit(170.0)}

    people = t["customer"].select("c_custkey", "c_nationkey").withColumns(place("c_nationkey", "c_custkey", "lat1", "lon1"))
    sites = t["supplier"].select("s_suppkey", "s_nationkey").withColumns(place("s_nationkey", "s_suppkey", "lat2", "lon2"))
    return P.nearest_by_distance(people, ["c_custkey"], ("lat1", "lon1"), sites, "s_suppkey", ("lat2", "lon2"), "km")


@register("null_safe_totals", """
    select l_suppkey, sum(coalesce(price, 0) + coalesce(tax, 0) + coalesce(fee, 0))::bigint as total from (
      select l_suppkey, case when l_returnflag <> 'R' then round(l_extendedprice * 100)::bigint end as price,
             nullif(round(l_tax * 100)::bigint, 4) as tax, case when l_linenumber > 3 then l_linenumber end as fee from lineitem)
    group by 1""")
def null_safe_totals(t):
    parts = t["lineitem"].select(
        "l_suppkey", F.when(F.col("l_returnflag") != "R", cents("l_extendedprice")).alias("price"),
        F.nullif(cents("l_tax"), F.lit(4)).alias("tax"), F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")).alias("fee"),
    )
    return N.null_safe_totals(parts, ["l_suppkey"], ["price", "tax", "fee"])
