"""Source, write-mode and snapshot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.registry import AS_OF, register
from millrace.operators import write as M
from millrace.operators.windows import first_rows
from millrace.sources import frames, sinks
from millrace.sources.manifest import ManifestTable, merge
from millrace.sources.session import scratch_path
from millrace.sources.tables import SOURCES, read_seed, read_source, read_tables_by_pattern
from millrace.sources.versions import create_history, read_history, update_history


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@register("read_source", "\nunion all ".join(
    f"select '{name}' as table_name, count(*) as num_rows, {len_}::bigint as key_columns from {name}"
    for name, len_ in ((n, len(s.key)) for n, s in SOURCES.items())
))
def read_source_(t):
    counts = [
        read_source(t.spark, t.root, name).agg(F.count(F.lit(1)).alias("num_rows"))
        .select(F.lit(name).alias("table_name"), "num_rows", F.lit(len(s.key)).alias("key_columns"))
        for name, s in SOURCES.items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionAll(part)
    return out


@register("read_seed", """
    select o_orderkey, s.mapped as mapped_status from orders left join (values ('F', 'closed'), ('O', 'active'), ('P', 'active')) s(status, mapped) on s.status = o_orderstatus""")
def read_seed_(t):
    seed = read_seed(t.spark, [("F", "closed"), ("O", "active"), ("P", "active")], "status string, mapped string")
    orders = t["orders"].select("o_orderkey", "o_orderstatus")
    return orders.join(F.broadcast(seed), F.col("o_orderstatus") == F.col("status"), "left").select("o_orderkey", F.col("mapped").alias("mapped_status"))


@register("read_tables_by_pattern", """
    select 'orders_' || year(o_orderdate) as _source, o_orderkey, o_custkey, o_orderpriority, case when year(o_orderdate) = 1999 then o_totalprice end as o_totalprice
    from orders where year(o_orderdate) <> 1998""")
def read_tables_by_pattern_(t):
    def year(y):
        part = t["orders"].filter((F.col("o_orderdate") >= ts(f"{y}-01-01")) & (F.col("o_orderdate") < ts(f"{y + 1}-01-01")))
        return part.select("o_orderkey", "o_custkey", "o_orderpriority", *(["o_totalprice"] if y == 1999 else []))

    span = t["orders"].agg(F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")).first()
    yearly = {f"orders_{y}": year(y) for y in range(span["first"] or 1, (span["last"] or 0) + 1)} | {"returns_1999": t["lineitem"]}
    return read_tables_by_pattern(yearly, r"^orders_", r"1998$")


@register("write_full_refresh", "select o_orderkey, o_totalprice, o_orderdate, o_orderstatus from orders")
def write_full_refresh(t):
    orders = t["orders"].select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    return sinks.write_full_refresh(orders, scratch_path(t.spark, "orders"), ("o_orderstatus",))


@register("export_parquet", "select p_partkey, p_name, p_retailprice from part")
def export_parquet(t):
    parts = t["part"].select("p_partkey", "p_name", "p_retailprice")
    path = sinks.export_parquet(parts, scratch_path(t.spark, "export"), "part", AS_OF, max_bytes=2**20)
    return t.spark.read.schema(parts.schema).parquet(path)


@register("backup_table", "select timestamp '2001-09-01' as backup_date, o_orderkey, o_orderstatus, o_totalprice from orders")
def backup_table(t):
    return sinks.backup_table(t["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice"), AS_OF)


EVENT_COLS = ["event_id", "ts", "user_id", "event_type"]


@register("incremental_append_watermark", "select event_id, ts, user_id, event_type from events")
def incremental_append_watermark(t):
    events = t["events"].select(*EVENT_COLS)
    return M.incremental_append_watermark(events.filter(F.col("ts") < ts("2024-01-15")), events, "ts")


@register("incremental_append_per_source", """
    with target as (select event_id, ts, user_id, event_type from events where ts < timestamp '2024-01-10' + to_days(length(event_type)::int) and event_type <> 'signup'),
         high as (select event_type, max(ts) as h from target group by 1)
    select * from target union all
    select e.event_id, e.ts, e.user_id, e.event_type from events e left join high using (event_type) where (h is null or e.ts > h) and e.event_id % 5 <> 0""")
def incremental_append_per_source(t):
    events = t["events"].select(*EVENT_COLS)
    loaded = F.col("ts") < ts("2024-01-10") + F.make_dt_interval(F.length("event_type"))
    target = events.filter(loaded & (F.col("event_type") != "signup"))
    return M.incremental_append_per_source(target, events.filter("event_id % 5 <> 0"), "event_type", "ts")


@register("incremental_append_antijoin", S.ctes(S.ORDERS_V2) + """
    select 'v2' as loaded_from, o_orderkey, o_orderstatus from orders_v2
    union all select 'v1', o_orderkey, o_orderstatus from orders where not exists (select 1 from orders_v2 v where v.o_orderkey = orders.o_orderkey)""")
def incremental_append_antijoin(t):
    cols = ["loaded_from", "o_orderkey", "o_orderstatus"]
    target = frames.orders_v2(t).withColumn("loaded_from", F.lit("v2")).select(*cols)
    return M.incremental_append_antijoin(target, t["orders"].withColumn("loaded_from", F.lit("v1")).select(*cols), ["o_orderkey"])


def by_year(df, at):
    """With the partition column of an order table."""
    return df.withColumn("year", F.year(at))


@register("incremental_merge", S.ctes(S.ORDERS_V2) + """
    , target as (select o_orderkey, o_orderstatus, o_orderdate from orders where o_orderdate < timestamp '1999-06-01'),
      cand as (select o_orderkey, o_orderstatus, o_orderdate from orders_v2, (select max(o_orderdate) as h, max(o_orderkey) as kh from target)
               where o_orderdate >= h or o_orderkey >= kh)
    select * from cand union all select * from target where o_orderkey not in (select o_orderkey from cand)""")
def incremental_merge(t):
    cols = ["o_orderkey", "o_orderstatus", "o_orderdate"]
    target = t["orders"].select(*cols).filter(F.col("o_orderdate") < ts("1999-06-01"))
    table = ManifestTable(t.spark, scratch_path(t.spark, "orders"), by_year(target, "o_orderdate").schema, ["year"], ["o_orderkey"], ["o_orderdate", "o_orderkey"])
    table.commit(by_year(target, "o_orderdate"))
    merge(table, by_year(frames.orders_v2(t).select(*cols), "o_orderdate"), ["o_orderdate", "o_orderkey"])
    return table.read().select(*cols)


@register("trailing_window_reload", """
    with keyed as (select md5(user_id || '-' || event_type || '-' || strftime(ts, '%Y-%m-%d')) as k, event_id, ts, value from events),
         target as (select k, event_id, ts, value from (select *, row_number() over (partition by k order by ts, event_id) as rn from keyed) where rn = 1),
         again as (select k, event_id, ts, value from (select *, row_number() over (partition by k order by ts desc, event_id desc) as rn from keyed
                   where ts >= timestamp '2024-01-30' - interval 10 day) where rn = 1)
    select * from again union all select * from target where k not in (select k from again)""")
def trailing_window_reload(t):
    day_text = F.date_format("ts", "yyyy-MM-dd")
    keyed = t["events"].select(
        F.md5(F.concat_ws("-", F.col("user_id").cast("string"), "event_type", day_text)).alias("k"), "event_id", "ts", "value"
    )
    keyed = keyed.withColumn("day", F.to_date("ts"))
    table = ManifestTable(t.spark, scratch_path(t.spark, "keyed"), keyed.schema, ["day"], ["k"])
    table.commit(first_rows(keyed, ["k"], ["ts", "event_id"]))
    merge(table, M.trailing_window(keyed, "ts", 10, "2024-01-30"), latest=["-ts", "-event_id"])
    return table.read().drop("day")


@register("sync_schema_append", S.ctes(S.LEGACY_ORDERS) + """
    select o_orderkey, o_orderdate, o_orderpriority, null as channel from orders where o_orderdate >= timestamp '1996-01-01'
    union all select o_orderkey, o_orderdate, null, channel from legacy_orders""")
def sync_schema_append(t):
    target = t["orders"].filter(F.col("o_orderdate") >= ts("1996-01-01")).select("o_orderkey", "o_orderdate", "o_orderpriority")
    return M.sync_schema_append(target, frames.legacy_orders(t).select("o_orderkey", "o_orderdate", "channel"))


@register("sync_hard_deletes", "select c_custkey, c_name from customer where c_custkey % 50 <> 0")
def sync_hard_deletes(t):
    return M.sync_hard_deletes(t["customer"].select("c_custkey", "c_name"), frames.customer_v2(t), ["c_custkey"])


@register("archive_missing_rows", "select event_id, ts, user_id, event_type from events")
def archive_missing_rows(t):
    events = t["events"].select(*EVENT_COLS)
    return M.archive_missing_rows(events.filter("event_id % 3 <> 0"), events.filter("event_id % 2 = 0 or event_id % 3 = 0"), ["event_id"])


@register("delete_duplicates", """
    select * exclude (rn) from (select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
      row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem) where rn = 1""")
def delete_duplicates(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return M.delete_duplicates(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


@register("update_from_join", S.ctes(S.CUSTOMER_V2) + """
    select c.c_custkey, c.c_name, coalesce(v.bal, c.c_acctbal) as c_acctbal from customer c
    left join (select c_custkey, case when c_custkey % 3 <> 0 then c_acctbal end as bal from customer_v2) v on v.c_custkey = c.c_custkey""")
def update_from_join(t):
    later = frames.customer_v2(t).withColumn("c_acctbal", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")))
    return M.update_from_join(t["customer"].select("c_custkey", "c_name", "c_acctbal"), later, ["c_custkey"], ["c_acctbal"])


@register("backfill_by_period", """
    with target as (select event_id, ts, user_id from events where ts < timestamp '2024-01-08')
    select *, date_trunc('day', ts)::timestamp as period from (
      select * from target union all
      select event_id, ts, user_id from events where ts > (select max(ts) from target) and ts < timestamp '2024-01-20')""")
def backfill_by_period(t):
    events = t["events"].select("event_id", "ts", "user_id")
    return M.backfill_by_period(events.filter(F.col("ts") < ts("2024-01-08")), events, "ts", "2024-01-01", "2024-01-20", "day")


def updated(t, history, current, k, rule, buckets=16):
    """The history as stored after one run over the current rows."""
    table = create_history(history, scratch_path(t.spark, "history"), k, buckets)
    update_history(table, current, k, rule, buckets)
    return read_history(table)


@register("snapshot_timestamp", S.ctes(S.SUPPLIER_V1, S.SUPPLIER_V2) + """
    , v1 as (select s_suppkey, s_acctbal, updated_at from supplier_v1), v2 as (select s_suppkey, s_acctbal, updated_at from supplier_v2)
    select a.s_suppkey, a.s_acctbal, a.updated_at, a.updated_at as valid_from, case when b.updated_at > a.updated_at then b.updated_at end as valid_to
    from v1 a left join v2 b using (s_suppkey)
    union all
    select b.s_suppkey, b.s_acctbal, b.updated_at, b.updated_at, null from v2 b left join v1 a using (s_suppkey) where a.s_suppkey is null or b.updated_at > a.updated_at""")
def snapshot_timestamp(t):
    cols = ["s_suppkey", "s_acctbal", "updated_at"]
    history = M.first_snapshot(frames.supplier_v1(t).select(*cols), F.col("updated_at"))
    return updated(t, history, frames.supplier_v2(t).select(*cols), ["s_suppkey"], M.timestamp_rule("updated_at", AS_OF))


@register("snapshot_check", S.ctes(S.CUSTOMER_V2) + """
    , v2 as (select c_custkey, c_name, nullif(c_acctbal, 0) as c_acctbal from customer_v2)
    select a.c_custkey, a.c_name, a.c_acctbal, timestamp '2000-01-01' as valid_from,
           case when b.c_custkey is null or a.c_acctbal is distinct from b.c_acctbal then timestamp '2001-09-01' end as valid_to
    from customer a left join v2 b using (c_custkey)
    union all
    select b.c_custkey, b.c_name, b.c_acctbal, timestamp '2001-09-01', null from v2 b left join customer a using (c_custkey)
    where a.c_custkey is null or a.c_acctbal is distinct from b.c_acctbal""")
def snapshot_check(t):
    cols = ["c_custkey", "c_name", "c_acctbal"]
    history = M.first_snapshot(t["customer"].select(*cols), ts("2000-01-01"))
    return updated(t, history, frames.customer_v2(t).select(*cols), ["c_custkey"], M.check_rule(["c_acctbal"], AS_OF, hard_deletes=True))


@register("snapshot_hard_deletes", S.ctes(S.SUPPLIER_V1) + """
    select s_suppkey, s_name, updated_at as valid_from, case when s_suppkey % 50 = 0 then timestamp '2001-09-01' end as valid_to from supplier_v1""")
def snapshot_hard_deletes(t):
    history = M.first_snapshot(frames.supplier_v1(t).select("s_suppkey", "s_name"), ts("2000-01-01"))
    return updated(t, history, frames.supplier_v2(t).select("s_suppkey"), ["s_suppkey"], M.delete_rule(AS_OF))
