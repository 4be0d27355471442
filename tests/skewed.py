"""A copy of a data folder in which one user places a third of all orders and causes a
third of all events."""

from __future__ import annotations

from pathlib import Path

import duckdb

SAME = ["region", "nation", "customer", "supplier", "part", "lineitem"]


def write_skewed(source: str, target: str) -> str:
    Path(target).mkdir(parents=True, exist_ok=True)
    con = duckdb.connect()

    def copy(name: str, columns: str) -> None:
        con.execute(f"COPY (SELECT {columns} FROM '{source}/{name}.parquet') "
                    f"TO '{target}/{name}.parquet' (FORMAT PARQUET)")

    for name in SAME:
        copy(name, "*")
    copy("orders", "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END "
                   "AS o_custkey)")
    copy("events", "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 2 ELSE user_id END AS user_id)")
    return target
