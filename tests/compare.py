"""Run a query and its SQL twin and compare them as bags of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def run_sql(con: duckdb.DuckDBPyConnection, sql: str) -> pa.Table:
    return con.sql(sql).to_arrow_table()


def rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(zip(*columns)) if columns else Counter()


def types(table: pa.Table) -> dict[str, str]:
    """Types by name, with the differences that carry no meaning taken out."""
    alike = {"large_string": "string", "timestamp[ns]": "timestamp[us]"}
    return {
        f.name: alike.get(str(f.type), str(f.type)) for f in table.schema
    }


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    problems = []
    if types(spark_table) != types(sql_table):
        a, b = types(spark_table), types(sql_table)
        diff = {n: (a.get(n), b.get(n)) for n in {*a, *b} if a.get(n) != b.get(n)}
        problems.append(f"types {diff}")
        if set(a) != set(b):
            return problems
    left, right = rows(spark_table), rows(sql_table)
    if left != right:
        only_left, only_right = left - right, right - left
        problems.append(
            f"rows {left.total()} vs {right.total()}, "
            f"only spark {only_left.total()} {list(only_left)[:2]}, "
            f"only sql {only_right.total()} {list(only_right)[:2]}"
        )
    return problems
