"""A copy of the smallest data set in which one customer, order, supplier and user hold a third of their table."""

from __future__ import annotations

import os

import duckdb

from tests.oracle import TABLES

HOT = {
    "orders": "select o_orderkey, case when o_orderkey % 3 = 0 then 1 else o_custkey end as o_custkey, * exclude (o_orderkey, o_custkey) from {t}",
    "lineitem": """select case when (l_partkey + l_linenumber) % 3 = 0 then 5 else l_orderkey end as l_orderkey, l_partkey,
                          case when (l_partkey + l_linenumber) % 3 = 1 then 3 else l_suppkey end as l_suppkey, * exclude (l_orderkey, l_partkey, l_suppkey) from {t}""",
    "events": "select event_id, ts, case when event_id % 3 = 0 then 2 else user_id end as user_id, * exclude (event_id, ts, user_id) from {t}",
}


def write_skewed(source: str, target: str) -> str:
    os.makedirs(target, exist_ok=True)
    con = duckdb.connect()
    for name in TABLES:
        table = f"read_parquet('{source}/{name}.parquet')"
        query = HOT.get(name, "select * from {t}").format(t=table)
        con.execute(f"copy ({query}) to '{target}/{name}.parquet' (format parquet)")
    return target
