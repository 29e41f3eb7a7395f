"""Vectors as whole numbers, and how tasks read them from Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(
    vectors: DataFrame, scale: int, id_column: str = "vec_id", vector_column: str = "embedding", more: Sequence = ()
) -> DataFrame:
    """id and ints, floor(scale * x) of every component x as a double, and further columns.

    Vectors that are null, or hold a null, NaN or infinite component, are left out. Whole numbers beyond 64 bits become the
    nearest of 64 bits.
    """
    vector = F.col(f"`{vector_column}`")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), ints.alias("ints"), *more
    )


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """One row per list; all lists have `width` numbers."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)
