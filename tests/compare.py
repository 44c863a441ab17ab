"""Side-by-side run of a registered query and its SQL text."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return ("b", value)
    if value is None:
        return ("", "")
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        value = float(value)
        return ("n", "nan" if math.isnan(value) else repr(value))
    return ("s", str(value))


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(_cell(r[k]) for k in order) for r in data)


def differences(spark, fn, sql: str, sf_dir: str, con) -> list[str]:
    """What differs; empty when columns, row counts and all values agree bit for bit."""
    df = fn(spark, sf_dir)
    table = con.execute(sql).to_arrow_table()
    left_names, right_names = sorted(df.columns), sorted(table.column_names)
    if left_names != right_names:
        return [f"columns {sorted(set(left_names) ^ set(right_names))}"]
    left = rows(df.columns, [tuple(r) for r in df.collect()])
    columns = [c.to_pylist() for c in table.columns]
    right = rows(table.column_names, list(zip(*columns)) if columns else [])
    if len(left) != len(right):
        return [f"rows {len(left)} != {len(right)}"]
    found = []
    for a, b in zip(left, right):
        for name, x, y in zip(left_names, a, b):
            if x != y:
                found.append(f"{name}: {x} != {y}")
    return found
