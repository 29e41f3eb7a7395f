"""Exact top-k by inner product: vectors by descending length, rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.llm.common import keep
from auriga.llm.vectors import matrix, whole_vectors

SCALE = 1024
QUERY_BLOCK = 4096
BAND = 16384
CHUNK = 512
FIT_ROWS = 4096
# Shares of the dimensions after which partial sums are held against the bound.
STAGES = (0.125, 0.5)
# A stretch of bands ends at so many times the bands before it.
GROWTH = 4
# Partial sums and the lengths left are rounded; bounds are widened by this share of the product of the lengths.
SLACK = 1e-6
# Whole numbers up to here are exact in a double.
EXACT = 2.0**53
FOUND = "q_row bigint, query_id bigint, score bigint, vec_id bigint, c_row bigint"


def top_products(
    vectors: DataFrame,
    asked: Column,
    k: int = 10,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_block: int = QUERY_BLOCK,
    band: int = BAND,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of the largest inner product for every row that `asked` holds for.

    Vectors are floor(scale * x); null, NaN and infinite ones take no part. A row is never its own neighbour; another row
    with the same id may be. Equal scores go by the smaller id, a null id last. Shorter vectors count as filled up
    with zeros. A query with fewer than k other rows has them all. Rows that repeat are asked and found each. Other
    columns are ignored. An empty table gives no rows. Scores are exact; beyond 64 bits they become the nearest of 64 bits.

    Vectors lie in bands by descending length. Stretches of bands are searched one after another, the first of one band, each
    further one longer. A stretch starts with the k-th score each query has so far, so it returns few rows; bands
    that are too short for every query of a block don't meet it. A task holds a block of queries, a band,
    and the products of the block with one chunk of the band.
    """
    rows = keep(
        whole_vectors(vectors, scale, id_column, vector_column, [F.coalesce(asked, F.lit(False)).alias("asked")])
        .withColumn("square", F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        .withColumn("row", F.monotonically_increasing_id()),
        "products-rows",
    )
    count, queries, width, longest = rows.agg(
        F.count("*"), F.count_if("asked"), F.coalesce(F.max(F.size("ints")), F.lit(0)),
        F.coalesce(F.max("square"), F.lit(0.0)),
    ).first()
    if not queries:
        return rows.limit(0).select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")
        )
    turn = rotation(rows, width, fit_rows)
    rows = rows.withColumn(
        "ints", F.concat("ints", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("ints")))
    )
    bands = -(-count // band)
    order = [F.desc("square"), F.asc("row")]
    table = rows.repartitionByRange(bands, *order).withColumn("band", F.spark_partition_id())
    table = keep(packed(table, "band", width), "products-bands")
    asking = rows.filter("asked").repartitionByRange(-(-queries // query_block), *order)
    asking = keep(asking.withColumn("block", F.spark_partition_id()).drop("asked"), "products-queries")
    place = Window.partitionBy("q_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "c_row")
    best, first, end = None, 0, 1
    while first < bands:
        stretch = table.filter(F.col("band").between(first, end - 1))
        found = search(asking, best, stretch, range(first, min(end, bands)), turn, k, longest >= EXACT)
        both = found if best is None else best.drop("rank").unionByName(found)
        best = keep(both.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k), "products-best")
        first, end = end, end * GROWTH
    return best.select("query_id", "rank", "vec_id", "score")


def rotation(rows: DataFrame, width: int, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Right singular vectors, the strongest first, of at most fit_rows vectors chosen by a hash.

    Every rotation keeps inner products: the sample decides how early bounds are tight, never what is found.
    """
    sample = rows.orderBy(F.xxhash64("ints"), "row").limit(fit_rows).select("ints").collect()
    given = np.zeros((len(sample), width))
    for at, row in enumerate(sample):
        given[at, : len(row["ints"])] = row["ints"]
    return np.linalg.svd(given, full_matrices=True)[2].T


def packed(rows: DataFrame, by: str, width: int) -> DataFrame:
    """One row per value of `by`: its vectors by descending length, their ids and rows, and the largest square."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("square", "descending"), ("row", "ascending")]).combine_chunks()
        given = matrix(group["ints"].combine_chunks(), width).astype("<i8")
        kept = {"lowest": pa.array([_lowest(group["floor"])], pa.int64())} if "floor" in group.column_names else {}
        floors = {"floors": pa.array([group["floor"].to_pylist()], pa.list_(pa.int64()))} if kept else {}
        return pa.table({
            by: group[by][:1], "ids": pa.array([group["id"].to_pylist()], pa.list_(pa.int64())),
            "rows": pa.array([group["row"].to_pylist()], pa.list_(pa.int64())),
            "ints": pa.array([given.tobytes()], pa.binary()), "square": group["square"][:1], **kept, **floors,
        })

    schema = f"{by} int, ids array<bigint>, rows array<bigint>, ints binary, square double"
    if "floor" in rows.columns:
        schema += ", lowest bigint, floors array<bigint>"
    return rows.groupBy(by).applyInArrow(run, schema)


def _lowest(floors: pa.ChunkedArray) -> int | None:
    """The smallest score that matters to any query of a block; None if some query takes all."""
    return None if floors.null_count else min(floors.to_pylist())


def search(
    asking: DataFrame, best: DataFrame | None, stretch: DataFrame, bands: range, turn: np.ndarray, k: int, wide: bool
) -> DataFrame:
    """q_row, query_id, score, vec_id, c_row: what may be among the k best of each query in a stretch of bands."""
    width = len(turn)
    if best is None:
        asking = asking.withColumn("floor", F.lit(None).cast("bigint"))
    else:
        floors = best.filter(F.col("rank") == k).select(F.col("q_row").alias("row"), F.col("score").alias("floor"))
        asking = asking.join(floors, "row", "left")
    blocks = keep(packed(asking, "block", width), "products-blocks")
    # Which block meets which band is settled on numbers alone; the vectors join afterwards.
    numbers = stretch.select("band", F.col("square").alias("c_square"))
    within = F.sequence(F.lit(bands[0]), F.lit(bands[-1]))
    reach = F.col("lowest").isNull() | (
        F.sqrt(F.col("square") * F.col("c_square")) * (1 + SLACK) >= F.col("lowest").cast("double")
    )
    pairs = (
        blocks.select("block", "square", "lowest", F.explode(within).alias("band"))
        .join(numbers, "band").filter(reach).select("block", "band")
    )
    met = pairs.join(blocks.select("block", "floors", *[F.col(c).alias(f"q_{c}") for c in ("ids", "rows", "ints")]), "block")
    met = met.join(stretch.select("band", "ids", "rows", "ints"), "band")

    def run(group: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        return Tile(row, turn, k, wide).table()

    return met.groupBy("block", "band").applyInArrow(run, FOUND)


class Tile:
    """A block of queries against a band, chunk by chunk; keeps the k best of each query that reach its floor."""

    def __init__(self, row: dict, turn: np.ndarray, k: int, wide: bool):
        width = len(turn)
        self.k, self.wide = k, wide
        self.ids, self.rows = row["q_ids"], np.array(row["q_rows"], dtype=np.int64)
        self.queries = np.frombuffer(row["q_ints"], dtype="<i8").reshape(-1, width)
        self.vectors = np.frombuffer(row["ints"], dtype="<i8").reshape(-1, width)
        self.c_ids, self.c_rows = row["ids"], np.array(row["rows"], dtype=np.int64)
        # Ties go by id, a null id last, then by row: one number tells the order.
        order = sorted(range(len(self.c_ids)), key=lambda i: (self.c_ids[i] is None, self.c_ids[i] or 0, row["rows"][i]))
        self.tie = np.empty(len(order), dtype=np.int64)
        self.tie[order] = np.arange(len(order))
        self.floor = np.array([-np.inf if f is None else self._below(f) for f in row["floors"]])
        self.stages = sorted({max(1, round(width * s)) for s in STAGES if width} - {width})
        self.turned, self.left = _partial(self.queries, turn, self.stages)
        self.turn = turn
        self.length = _lengths(self.queries)
        self.found = [np.empty(0, dtype=np.int64), np.empty(0, dtype=object if wide else np.int64), np.empty(0, dtype=np.int64)]
        for at in range(0, len(self.vectors), CHUNK):
            if not self._chunk(at, min(at + CHUNK, len(self.vectors))):
                break

    def _chunk(self, first: int, end: int) -> bool:
        """False if this chunk and so all further ones are too short for every query."""
        given = self.vectors[first:end]
        lengths = _lengths(given)
        slack = SLACK * np.outer(self.length, lengths) + 1
        # One more on each bound covers floors that were rounded to doubles.
        asking = np.flatnonzero(self.length * lengths[0] * (1 + SLACK) + 1 >= self.floor)
        if not len(asking):
            return False
        columns = np.arange(len(given))
        turned, left = _partial(given, self.turn, self.stages)
        sums, done = np.zeros((len(asking), len(columns))), 0
        for stage, rest_q, rest_c in zip(self.stages, self.left, left, strict=True):
            sums = sums + self.turned[asking, done:stage] @ turned[columns, done:stage].T
            bound = sums + np.outer(rest_q[asking], rest_c[columns]) + slack[np.ix_(asking, columns)]
            alive = bound >= self.floor[asking, None]
            keep_q, keep_c = alive.any(axis=1), alive.any(axis=0)
            asking, columns, sums, done = asking[keep_q], columns[keep_c], sums[np.ix_(keep_q, keep_c)], stage
            if not len(asking):
                return True
        scores = self._exact(self.queries[asking], given[columns])
        alive = (scores >= self.floor[asking, None]) & (self.rows[asking, None] != self.c_rows[first + columns][None, :])
        q, c = np.nonzero(alive)
        self._merge(asking[q], scores[q, c], first + columns[c])
        return True

    def _below(self, score: int) -> float:
        """The score as a double, one step lower where it may have been rounded up."""
        return float(np.nextafter(float(score), -np.inf)) if self.wide else float(score)

    def _exact(self, queries: np.ndarray, given: np.ndarray) -> np.ndarray:
        """Products of whole numbers: doubles hold all sums below 2 ** 53, Python's numbers any."""
        if not self.wide:
            return np.rint(queries.astype(float) @ given.T.astype(float)).astype(np.int64)
        whole = queries.astype(object) @ given.T.astype(object)
        return np.clip(whole, -(2**63), 2**63 - 1)

    def _merge(self, q: np.ndarray, scores: np.ndarray, at: np.ndarray) -> None:
        q, scores, at = (np.concatenate(pair) for pair in zip(self.found, (q, scores, at), strict=True))
        if self.wide:
            order = np.array(sorted(range(len(q)), key=lambda i: (q[i], -scores[i], self.tie[at[i]])), dtype=np.int64)
        else:
            order = np.lexsort((self.tie[at], -scores, q))
        q, scores, at = q[order], scores[order], at[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        kept = nth < self.k
        self.found = [q[kept], scores[kept], at[kept]]
        last = nth == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], [self._below(s) for s in scores[last]])

    def table(self) -> pa.Table:
        q, scores, at = self.found
        return pa.table({
            "q_row": pa.array(self.rows[q], pa.int64()), "query_id": pa.array([self.ids[i] for i in q], pa.int64()),
            "score": pa.array([int(s) for s in scores], pa.int64()),
            "vec_id": pa.array([self.c_ids[i] for i in at], pa.int64()), "c_row": pa.array(self.c_rows[at], pa.int64()),
        })


def _lengths(given: np.ndarray) -> np.ndarray:
    return np.sqrt((given.astype(float) ** 2).sum(axis=1))


def _partial(given: np.ndarray, turn: np.ndarray, stages: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotated vectors up to the last stage, and what length is left after each stage."""
    turned = given.astype(float) @ turn[:, : stages[-1] if stages else 0]
    whole = (given.astype(float) ** 2).sum(axis=1)
    left = [np.sqrt(np.maximum(whole - (turned[:, :s] ** 2).sum(axis=1), 0)) for s in stages]
    return turned, left
