"""Compare a Spark result with its SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.9g}")
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(connection, statement: str):
    cursor = connection.execute(statement)
    names = [d[0] for d in cursor.description]
    return sorted(names), _rows(names, cursor.fetchall())
