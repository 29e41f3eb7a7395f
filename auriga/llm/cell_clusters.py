"""Centroid clustering over a vector-approximation file: cells give distance intervals, full vectors decide where they overlap."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.llm.common import keep
from auriga.llm.vectors import matrix, whole_vectors

SCALE = 64
CLUSTERS = 16
ROUNDS = 3
# 16 cells for each dimension, two dimensions in a byte.
CELLS = 16
FIT_ROWS = 4096
ROWS_AT_ONCE = 4096


def clusters(
    vectors: DataFrame,
    width: int = 64,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly `width` components, none null, NaN or infinite, as floor(scale * x). Centroids start as the
    vectors with the smallest SHA-256 of "1:<id>" (a null id as no digits; ties by the vector, then as read); fewer
    vectors make fewer clusters. A vector goes to the nearest centroid, ties to the smaller number; a round
    replaces a centroid by the floor of its vectors' mean, in whole numbers, and leaves one without vectors. Rows
    that repeat are vectors of their own. Other columns are ignored. An empty table, or none kept, gives no rows.
    Sums and distances are exact for components below 2 ** 24 in size.

    The file has a few bits per dimension: the cell the component lies in. For each centroid a table tells the
    least and the largest squared difference in each cell, so sums of looked-up values bound a distance. A vector whose
    intervals leave one centroid is settled; the others are compared in full with the centroids left. Cells are
    fitted on at most fit_rows vectors and reach to the extremes of all. Every round is one scan and a
    sum per cluster and dimension; the driver holds the centroids.
    """
    rows = whole_vectors(vectors, scale, id_column, vector_column).filter(F.size("ints") == width)
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = keep(rows.withColumn("name", name), "cells-vectors")
    sample = rows.orderBy("name", "ints").limit(max(fit_rows, clusters)).select("ints").collect()
    centroids = np.array([r["ints"] for r in sample[:clusters]], dtype=np.int64).reshape(-1, width)
    edges = cell_edges(np.array([r["ints"] for r in sample], dtype=np.int64).reshape(-1, width), extremes(rows, width))
    file = keep(approximated(rows, edges), "cells-file")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids, cluster_sums(file, edges, centroids))
    found = keep(assigned(file, edges, centroids), "cells-assigned")
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    names = rows.sparkSession.createDataFrame(list(enumerate(shas)), "cluster int, centroid_sha256 string")
    told = inertia.join(F.broadcast(names), "cluster")
    whole = inertia.agg(F.sum("cluster_inertia")).first()[0]
    # At most one row per cluster, a number given above.
    return found.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("bigint").alias("inertia"), "centroid_sha256"
    )


def extremes(rows: DataFrame, width: int) -> np.ndarray:
    """Least and largest component of each dimension, as two rows; folded per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                ints = matrix(batch["ints"], width)
                low = ints.min(axis=0) if low is None else np.minimum(low, ints.min(axis=0))
                high = ints.max(axis=0) if high is None else np.maximum(high, ints.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(width, dtype=np.int32), "low": low, "high": high})

    found = rows.select("ints").mapInArrow(run, "dim int, low bigint, high bigint")
    ends = found.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    return np.array([[r["low"] for r in ends], [r["high"] for r in ends]], dtype=np.int64)


def cell_edges(sample: np.ndarray, ends: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """cells + 1 borders per dimension: cell c has the numbers from border c up to the one below border c + 1."""
    if not len(sample):
        return np.zeros((cells + 1, sample.shape[1]), dtype=np.int64)
    inner = np.quantile(sample, np.arange(1, cells) / cells, axis=0, method="inverted_cdf").astype(np.int64)
    return np.vstack([ends[:1], np.clip(inner, ends[0], ends[1]), ends[1:] + 1])


def approximated(rows: DataFrame, edges: np.ndarray) -> DataFrame:
    """vec_id, cells (half a byte per dimension) and ints, the full vector."""
    width = edges.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = matrix(batch["ints"], width)
            cell = np.empty(ints.shape, dtype=np.uint8)
            for dim in range(width):
                cell[:, dim] = np.searchsorted(edges[1:-1, dim], ints[:, dim], side="right")
            even = np.pad(cell, ((0, 0), (0, width % 2)))
            code = even[:, 0::2] << 4 | even[:, 1::2]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([c.tobytes() for c in code], pa.binary()), batch["ints"]], ["vec_id", "cells", "ints"]
            )

    return rows.select("id", "ints").mapInArrow(run, "vec_id bigint, cells binary, ints array<bigint>")


def interval_tables(edges: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Bounds by byte of the code and its value: first the lower ones of all centroids, then the upper ones."""
    cells, width = len(edges) - 1, edges.shape[1]
    low, high = edges[:-1, None, :], np.maximum(edges[1:, None, :] - 1, edges[:-1, None, :])
    below, above = low - centroids, centroids - high
    least = np.maximum(np.maximum(below, above), 0) ** 2
    most = np.maximum(np.abs(below), np.abs(above)) ** 2
    one = np.concatenate([least, most], axis=1).transpose(2, 0, 1)
    if width % 2:
        one = np.concatenate([one, np.zeros_like(one[:1])])
    pair = one[0::2, :, None, :] + one[1::2, None, :, :]
    return pair.reshape(len(one) // 2, cells * cells, -1)


def nearest(code: np.ndarray, ints: np.ndarray, tables: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, and which vectors the intervals left open."""
    count = len(centroids)
    bounds = tables[0][code[:, 0]]
    for at in range(1, code.shape[1]):
        bounds = bounds + tables[at][code[:, at]]
    low, high = bounds[:, :count], bounds[:, count:]
    possible = low <= high.min(axis=1, keepdims=True)
    best = possible.argmax(axis=1)
    open_ = np.flatnonzero(possible.sum(axis=1) > 1)
    if len(open_):
        exact = _squared(ints[open_], centroids)
        exact[~possible[open_]] = np.iinfo(np.int64).max
        best[open_] = exact.argmin(axis=1)
    return best, open_


def _squared(ints: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of vectors to all centroids, in whole numbers."""
    return np.stack([((ints - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _assigning(edges: np.ndarray, centroids: np.ndarray):
    """From batches of the file: their ids, full vectors and clusters, some rows at a time."""
    width = edges.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        tables = interval_tables(edges, centroids)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                code = np.frombuffer(b"".join(batch["cells"].to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
                ints = matrix(batch["ints"], width)
                yield batch["vec_id"], ints, nearest(code, ints, tables, centroids)[0]

    return run


def cluster_sums(file: DataFrame, edges: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """cluster, dim, total: sums of the vectors of each cluster, and their number as dimension -1."""
    assign, count, width = _assigning(edges, centroids), len(centroids), edges.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, width + 1), dtype=np.int64)
        for _, ints, best in assign(batches):
            for cluster in np.unique(best):
                members = ints[best == cluster]
                total[cluster, 0] += len(members)
                total[cluster, 1:] += members.sum(axis=0)
        yield pa.RecordBatch.from_pydict({
            "cluster": np.repeat(np.arange(count, dtype=np.int32), width + 1),
            "dim": np.tile(np.arange(-1, width, dtype=np.int32), count), "total": total.ravel(),
        })

    found = file.mapInArrow(run, "cluster int, dim int, total bigint")
    return found.groupBy("cluster", "dim").agg(F.sum("total").alias("total"))


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The floor of the mean of each cluster's vectors; a cluster without vectors stays."""
    total = np.zeros((len(centroids), centroids.shape[1] + 1), dtype=np.int64)
    for row in sums.collect():
        total[row["cluster"], row["dim"] + 1] = row["total"]
    members = total[:, :1]
    return np.where(members > 0, total[:, 1:] // np.maximum(members, 1), centroids)


def assigned(file: DataFrame, edges: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    assign = _assigning(edges, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ints, best in assign(batches):
            distance = ((ints - centroids[best]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(best, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"]
            )

    return file.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")
