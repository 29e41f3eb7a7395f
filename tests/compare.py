"""Compare a Spark result with its DuckDB twin: columns, types, rows and values in any order."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def duck_type(spark_type: str) -> str:
    if spark_type.startswith("array<"):
        return duck_type(spark_type[6:-1]) + "[]"
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", spark_type)
    return f"DECIMAL({found[1]},{found[2]})" if found else _SPARK_TO_DUCK.get(spark_type, spark_type)


def connect(path: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return str(value)


def differences(df: DataFrame, sql: str, con) -> tuple[list[str], int]:
    """(problems, rows); no problems when both sides agree."""
    columns = sorted(df.columns)
    spark_types = {c: duck_type(t) for c, t in df.dtypes}
    left = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {row[0]: row[1] for row in described}
    problems = []
    if sorted(duck_types) != columns:
        return [f"columns {columns} vs {sorted(duck_types)}"], len(left)
    for c in columns:
        if spark_types[c] != duck_types[c]:
            problems.append(f"type of {c}: {spark_types[c]} vs {duck_types[c]}")
    names = ", ".join(f'"{c}"' for c in columns)
    right = [tuple(_plain(v) for v in row) for row in con.execute(f"SELECT {names} FROM ({sql})").fetchall()]
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    only_left, only_right = Counter(left) - Counter(right), Counter(right) - Counter(left)
    if only_left or only_right:
        problems.append(
            f"{sum(only_left.values())} rows only in Spark, {sum(only_right.values())} only in DuckDB; "
            f"{columns}: {sorted(only_left)[:2]} / {sorted(only_right)[:2]}"
        )
    return problems, len(left)
