"""Put one-row tables side by side without a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Each argument has exactly one row (a global aggregate); the others become scalar subqueries."""
    row = first
    for i, other in enumerate(others):
        name = f"_row{i}"
        packed = other.select(F.struct(*other.columns).alias(name)).scalar().alias(name)
        row = row.select("*", packed).select(*row.columns, *[F.col(name)[c].alias(c) for c in other.columns])
    return row
