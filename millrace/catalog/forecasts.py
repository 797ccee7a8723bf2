"""Forecast and quality-risk queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import frame_sql as S
from millrace.catalog.events import HOLIDAYS_SQL, holidays
from millrace.catalog.registry import AS_OF, register
from millrace.functions.columns import cents
from millrace.functions.dates import add_part
from millrace.plans import forecast as P
from millrace.plans import quality_risk as Q
from millrace.sources import frames

FORECAST_AS_OF = "1999-06-15 00:00:00"
LARGE = 45_000_000

FORECAST_ORDERS = """fo as (
  select *, case when r <= timestamp '1999-06-15' then r end as recognized_at, subtotal_cents * 97 // 100 as recognized_cents from (
    select *, sourced_at + to_days((o_orderkey % 40 + 5)::int) as r from (
      select o_orderkey, (['CNC', '3DP', 'IM', 'SM'])[(o_orderkey % 4 + 1)::int] as technology, o_orderkey // 4 % 3 * 5 + 5 as lead_time, case o_custkey % 3 when 0 then 'na' when 1 then 'emea' else 'row' end as region,
             o_orderdate + interval 10 day as promised_at, case when o_orderstatus <> 'O' then o_orderdate end as closed_at, case when o_orderstatus = 'F' then o_orderdate + to_days((o_orderkey % 4)::int) end as sourced_at,
             round(o_totalprice * 100)::bigint as subtotal_cents from orders where o_orderdate < timestamp '1999-06-10')))"""


def forecast_orders(t):
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    base = t["orders"].filter(F.col("o_orderdate") < F.lit("1999-06-10").cast("timestamp_ntz")).select(
        F.get(F.array(*[F.lit(x) for x in frames.TECHNOLOGIES]), (k % 4).cast("int")).alias("technology"), (F.floor(k / F.lit(4)) % 3 * 5 + 5).alias("lead_time"),
        F.when(F.col("o_custkey") % 3 == 0, "na").when(F.col("o_custkey") % 3 == 1, "emea").otherwise("row").alias("region"), add_part("o_orderdate", 10, "day").alias("promised_at"),
        F.when(status != "O", F.col("o_orderdate")).alias("closed_at"), F.when(status == "F", add_part("o_orderdate", k % 4, "day")).alias("sourced_at"),
        cents("o_totalprice").alias("subtotal_cents"), k.alias("k"),
    )
    done = add_part("sourced_at", F.col("k") % 40 + 5, "day")
    return base.withColumns({
        "recognized_at": F.when(done <= F.lit(FORECAST_AS_OF).cast("timestamp_ntz"), done), "recognized_cents": F.floor(F.col("subtotal_cents") * 97 / F.lit(100)),
    }).drop("k")


FORECAST = f"""forecast as (
  with sm as (select *, sourced_at::date as d from fo where sourced_at is not null and subtotal_cents < {LARGE}),
       rate as (select lead_time, technology, region, sum(subtotal_cents)::bigint / 30 as amount from sm where d >= date '1999-06-15' - 42 and d < date '1999-06-15' and isodow(d) < 6 group by 1, 2, 3),
       days as (select unnest(generate_series(date '1999-06-15', date '2000-05-31', interval 1 day))::date as d),
       ex as (select lead_time, technology, region, d, amount from rate, days where isodow(d) < 6 and d not in (select date from holidays)),
       dl as (select lead_time, technology, region, date_diff('day', sourced_at, recognized_at) as lag_days, sum(subtotal_cents)::bigint as s, sum(recognized_cents)::bigint as r
              from sm where sourced_at >= timestamp '1998-03-15' and sourced_at < timestamp '1999-03-15' group by 1, 2, 3, 4),
       sh as (select lead_time, technology, lag_days, s / sum(s) over (partition by technology, lead_time)::bigint * (r / nullif(s, 0)) as share from dl),
       bk as (select lead_time, technology, region, d, sum(subtotal_cents)::bigint as amount from sm group by 1, 2, 3, 4),
       u as (select 'sourced' as kind, b.lead_time, b.technology, region, d + coalesce(lag_days, b.lead_time + 7)::int as at_, floor(amount * coalesce(share, 1) * 0.98::double + 0.5)::bigint as v, share, lag_days, d from bk b left join sh on sh.lead_time = b.lead_time and sh.technology = b.technology
             union all select 'expected', e.lead_time, e.technology, region, d + coalesce(lag_days, e.lead_time + 7)::int, floor(amount * coalesce(share, 1) * 0.98::double + 0.5)::bigint, share, lag_days, d from ex e left join sh on sh.lead_time = e.lead_time and sh.technology = e.technology)
  select at_::timestamp as recognized_on, lead_time, technology, region, sum(v)::bigint as cents, kind from u where date_trunc('month', d + lag_days::int) >= date '1999-06-01' and (kind = 'expected' or share > 0) group by at_, lead_time, technology, region, kind
  union all select date_trunc('day', recognized_at)::timestamp, lead_time, technology, region, sum(recognized_cents)::bigint, 'large deals' from fo where subtotal_cents >= {LARGE} and date_trunc('month', recognized_at) >= date '1999-06-01' group by 1, 2, 3, 4)"""


def revenue(t):
    return P.revenue_forecast(forecast_orders(t), holidays(t), FORECAST_AS_OF, LARGE)


@register("revenue_forecast", f"{S.ctes(FORECAST_ORDERS, HOLIDAYS_SQL, FORECAST)} select * from forecast")
def revenue_forecast(t):
    return revenue(t)


@register("large_deal_forecast", f"""{S.ctes(FORECAST_ORDERS, HOLIDAYS_SQL, FORECAST)}
    , dd as (select technology, date_trunc('month', promised_at) as m, abs(date_diff('day', promised_at, coalesce(recognized_at, timestamp '1999-06-15'))) as late
             from fo where subtotal_cents >= {LARGE} and closed_at is not null and promised_at <= timestamp '1999-06-08'),
      dr as (select *, dense_rank() over (partition by technology order by m desc) as rn from dd),
      st as (select technology, floor(sum(late) / count(*))::int as mean_d, (floor(quantile_cont(late, 0.5) + 0.5) + coalesce(floor(round(stddev_samp(late), 4) + 0.5), 0))::int as high_d from dr where rn <= 9 group by 1),
      od as (select technology, promised_at::date as s, promised_at::date + 7 as p, sum(subtotal_cents)::bigint as c, 'sold' as kind from fo where subtotal_cents >= {LARGE} and sourced_at >= timestamp '1997-06-15' and recognized_at is null group by 1, 2, 3
             union all
             select technology, s, s, c, 'forecast' from (select technology, (m + (lead_time + 21)::int) as s, c from
               (select technology, lead_time, floor(sum(subtotal_cents)::bigint / 6 + 0.5)::bigint as c from fo where subtotal_cents >= {LARGE} and promised_at >= timestamp '1998-12-01' and promised_at < timestamp '1999-06-01' group by 1, 2),
               (values (date '1999-06-01'), (date '1999-07-01'), (date '1999-08-01')) v(m))),
      sc as (select kind, c, s + mean_d as a, s + high_d as h, p, date '1999-06-15' as today from od left join st using (technology)),
      ex as (select kind, c, 'h' as e, case when p >= today then p when a >= today then a when h >= today then h end as d from sc
             union all select kind, c, 'm', case when a >= today then a when h >= today then h end from sc union all select kind, c, 'l', case when h >= today then h end from sc),
      pv as (select kind, date_trunc('month', d)::timestamp as month, coalesce(sum(c) filter (where e = 'h'), 0)::bigint as h, coalesce(sum(c) filter (where e = 'm'), 0)::bigint as m, coalesce(sum(c) filter (where e = 'l'), 0)::bigint as l from ex group by 1, 2)
    select month, kind, 0::bigint as base, case when h > m + l then h - m - l else 0 end as high, case when m > l then m - l else 0 end as medium, l as low from pv
    union all select date_trunc('month', recognized_on)::timestamp, 'base', sum(cents)::bigint, 0, 0, 0 from forecast group by 1""")
def large_deal_forecast(t):
    return P.large_deal_forecast(forecast_orders(t), revenue(t), FORECAST_AS_OF, LARGE)


QC_LINES = """qc_lines as (
  select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || round(l_extendedprice * 100)::bigint as line_id, l_orderkey as order_id, l_suppkey as supplier_id, c_nationkey as country, p_type as material,
         'F' || p_size % 3 as finish, case when p_partkey % 3 <> 0 then 'T' || p_partkey % 3 end as tolerance, case when l_orderkey % 2 = 0 then 'CNC' else '3DP' end as technology, round(l_extendedprice * 100)::bigint // 50 as price_cents,
         l_shipdate as shipped_at, case when l_partkey % 19 <> 0 then l_shipdate + to_days((l_suppkey % 6)::int) end as delivered_at,
         case when l_returnflag = 'R' then l_shipdate + to_days((l_suppkey % 6 + l_linenumber * 4)::int) end as disputed_at, l_tax > 0.07 as is_cosmetic, case when l_linestatus = 'F' then l_discount > 0.09 end as has_note,
         l_orderkey % 3 <> 0 as is_cross_docking, s_nationkey between 1 and 8 as checked, n_c.n_regionkey as destination_region, n_s.n_regionkey as origin_region, l_quantity::bigint as quantity, l_partkey, o_orderstatus, l_linenumber
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey
  join nation n_c on n_c.n_nationkey = c_nationkey join nation n_s on n_s.n_nationkey = s_nationkey)"""


def qc_order_lines(t):
    """Lines with what their part, order and customer tell."""
    line = F.col("l_linenumber")
    key = F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], cents("l_extendedprice").cast("string"))
    nation = t["nation"].select("n_nationkey", "n_regionkey")
    # Orders meet their customers before the many lines meet them, and last, so that the lines stay dealt by order.
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        key.alias("line_id"), F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id"), F.col("c_nationkey").alias("country"), F.col("p_type").alias("material"),
        F.concat(F.lit("F"), (F.col("p_size") % 3).cast("string")).alias("finish"), F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("T"), (F.col("p_partkey") % 3).cast("string"))).alias("tolerance"),
        F.when(F.col("l_orderkey") % 2 == 0, "CNC").otherwise("3DP").alias("technology"), F.floor(cents("l_extendedprice") / F.lit(50)).alias("price_cents"), F.col("l_shipdate").alias("shipped_at"),
        F.when(F.col("l_partkey") % 19 != 0, add_part("l_shipdate", F.col("l_suppkey") % 6, "day")).alias("delivered_at"),
        F.when(F.col("l_returnflag") == "R", add_part("l_shipdate", F.col("l_suppkey") % 6 + line * 4, "day")).alias("disputed_at"), (F.col("l_tax") > 0.07).alias("is_cosmetic"),
        F.when(F.col("l_linestatus") == "F", F.col("l_discount") > 0.09).alias("has_note"), (F.col("l_orderkey") % 3 != 0).alias("is_cross_docking"),
        F.col("n_regionkey").alias("destination_region"), F.col("l_quantity").cast("long").alias("quantity"), F.col("l_partkey"), "o_orderstatus", line,
    )


def qc_suppliers(t):
    origin = t["nation"].select(F.col("n_nationkey").alias("o_nation"), F.col("n_regionkey").alias("origin_region"))
    suppliers = t["supplier"].join(origin, F.col("s_nationkey") == F.col("o_nation"))
    return suppliers.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_nationkey").between(1, 8).alias("checked"), "origin_region")


def qc_lines(t):
    return qc_order_lines(t).join(qc_suppliers(t), "supplier_id")


def history_sql(name, k):
    on = " and ".join(f"h.{c} = a.{c}" for c in k)
    cols = ", ".join(f"a.{c}" for c in k)
    return f"""{name} as (
      select {cols}, a.week, coalesce(sum(n_lines) filter (where h.week > a.week - 6), 0)::bigint as lr, coalesce(sum(n_disputes) filter (where h.week > a.week - 6), 0)::bigint as dr, coalesce(sum(n_lines), 0)::bigint as la, coalesce(sum(n_disputes), 0)::bigint as da
      from (select distinct {', '.join(k)}, week from s) a left join (select {', '.join(k)}, week, count(*) as n_lines, count(*) filter (where disputed_at <= delivered_at + interval 14 day) as n_disputes from m group by all) h
        on {on} and h.week <= a.week group by all)"""


def percent_sql(p, w):
    return f"(nullif({p}, 0) * 200 + nullif({w}, 0)) // (nullif({w}, 0) * 2)"


ATTRIBUTES = ["supplier_id", "material", "finish", "tolerance_key"]


@register("qc_risk_score", f"""{S.ctes(QC_LINES)}
    , s as (select *, coalesce(tolerance, 'null') as tolerance_key, date_diff('day', date '1970-01-05', date_trunc('week', shipped_at)) // 7 as week from qc_lines),
      m as (select * exclude (week), date_diff('day', date '1970-01-05', date_trunc('week', delivered_at)) // 7 as week from s where technology = 'CNC' and delivered_at is not null),
      {history_sql('ha', ATTRIBUTES)}, {history_sql('hs', ['supplier_id'])},
      hc0 as (select country, week, count(*) as n, count(*) filter (where disputed_at <= delivered_at + interval 14 day) as d from m group by 1, 2),
      hc as (select country, week, sum(n) over w::bigint as n, sum(d) over w::bigint as d from hc0 window w as (partition by country order by week rows between 5 preceding and current row)),
      kn as (select distinct supplier_id, material, finish, tolerance_key from s where technology = 'CNC'),
      i as (select user_id as order_id, count(*) as n_i from events group by 1),
      j as (select s.*, kn.supplier_id is not null as known, ha.la as lines_so_far, {percent_sql('ha.da', 'ha.la')} as running, {percent_sql('ha.dr', 'ha.lr')} as recent, {percent_sql('hs.dr', 'hs.lr')} as sup, {percent_sql('hc.d', 'hc.n')} as cty, n_i
            from s join ha using (supplier_id, material, finish, tolerance_key, week) join hs using (supplier_id, week) left join kn using (supplier_id, material, finish, tolerance_key)
            left join hc on hc.country = s.country and hc.week = s.week left join i on i.order_id = s.order_id),
      b as (select *, [price_cents > 60000, tolerance is not null, known and lines_so_far < 10, known and coalesce(running >= 3, false), coalesce(n_i >= 36, false), known and coalesce(recent >= 9, false), is_cosmetic, coalesce(has_note, false),
                       coalesce(sup >= 9, false), coalesce(cty >= 9, false)] as rules from j),
      x as (select *, list_aggregate([case when r then '1' else '0' end for r in rules], 'string_agg', '') as rule_bits, (list_contains(rules, true) or technology <> 'CNC') and checked as should_check from b),
      q as (select rule_bits, count(*) filter (where disputed_at is not null) as d, count(*) as n from x where is_cross_docking and should_check and shipped_at >= timestamp '2000-07-01' group by 1)
    select line_id, x.order_id, should_check, x.rule_bits, case when d > 0 then d * 100 / n end as dispute_rate from x left join q on q.rule_bits = x.rule_bits""")
def qc_risk_score(t):
    counts = t["events"].groupBy(F.col("user_id").alias("order_id")).agg(F.count(F.lit(1)).alias("n"))
    return Q.qc_risk_score(qc_order_lines(t), counts, qc_suppliers(t), F.col("checked"), AS_OF)


@register("qc_feature_table", f"""{S.ctes(QC_LINES)}
    , g as (select model_id, unnest(case when vec_id % 4 = 0 then [vec_id % 3, vec_id % 3 + 1] else [vec_id % 3] end) as rigidity, label::bigint as complexity
            from (select *, vec_id % 200 as model_id, row_number() over (partition by vec_id % 200 order by vec_id desc) as rn from embeddings) where rn = 1)
    select distinct line_id, delivered_at, coalesce(disputed_at is not null, false) as has_issue, is_cosmetic, coalesce(origin_region = destination_region, false) as is_local, coalesce(case when order_id % 4 <> 0 then order_id % 20 end, 0) as lead_time, finish, tolerance, quantity,
           price_cents / quantity as price_per_part, complexity, rigidity, coalesce(delivered_at between timestamp '1998-09-01' and timestamp '2001-08-01' and o_orderstatus in ('F'), false) as is_training_data
    from qc_lines left join g on g.model_id = l_partkey % 300
    where is_cross_docking and o_orderstatus <> 'O' and technology = 'CNC' and l_linenumber <> 7 and (delivered_at >= timestamp '1998-09-01' or delivered_at is null)""")
def qc_feature_table(t):
    order, status = F.col("order_id"), F.col("o_orderstatus")
    lines = qc_lines(t).withColumns({
        "is_sourced": status != "O", "line_type": F.when(F.col("l_linenumber") != 7, "part").otherwise("shipping"), "has_issue": F.col("disputed_at").isNotNull(),
        "lead_time": F.when(order % 4 != 0, order % 20), "model_id": F.col("l_partkey") % 300, "order_status": F.when(status == "F", "completed").otherwise("open"),
    })
    v = F.col("vec_id")
    label = F.col("label").cast("long").alias("complexity")
    one, two = F.struct((v % 3).alias("rigidity"), label), F.struct((v % 3 + 1).alias("rigidity"), label)
    geometry = t["embeddings"].select((v % 200).alias("model_id"), v.alias("updated"), v.alias("run_id"), F.when(v % 4 == 0, F.array(one, two)).otherwise(F.array(one)).alias("labels"))
    return Q.qc_feature_table(lines, geometry, AS_OF)
