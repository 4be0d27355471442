"""Run a registered query and its DuckDB SQL on one folder and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "benchmark"]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in filter(lambda t: _exists(folder, t), TABLES):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/**')"
                    if _is_dir(folder, name) else
                    f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _exists(folder: str, name: str) -> bool:
    from pathlib import Path

    return Path(f"{folder}/{name}.parquet").exists()


def _is_dir(folder: str, name: str) -> bool:
    from pathlib import Path

    return Path(f"{folder}/{name}.parquet").is_dir()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value)
    return f"{type(value).__name__}:{value}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return normal(columns, result.fetchall())


def difference(df, con, sql) -> str | None:
    ours, theirs = spark_rows(df), duck_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    a, b = set(ours[1]), set(theirs[1])
    return (f"{len(ours[1])} rows vs {len(theirs[1])}; only ours {sorted(a - b)[:3]}; "
            f"only theirs {sorted(b - a)[:3]}")
