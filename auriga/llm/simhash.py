"""SimHash near-duplicates: pivot distance tables find the candidates, exact distances decide."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auriga.llm.common import cut, keep, map_frames, sliced, text_of

SEED = 42
# The pivots: one reference fingerprint, and one more for each run of WIDTH bits, with that run flipped.
REFERENCE = 0x5A3C96E1F00D7B24
WIDTH = 2
# Fingerprints of unlike texts that one may meet under one key.
MEETINGS = 4
# Stands for a null id where ids are compared; it sorts before every id in use.
NO_ID = -(2**63)


def fingerprint_of(text: bytes | None, shingle: int = 3, seed: int = SEED) -> int:
    """64 bits; a bit is 1 if more than half of the shingles' XXH64 values have it. No word gives 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        hashes = [xxhash.xxh64_intdigest(b" ".join(gram), seed) for gram in _shingles(words, shingle)]
    # One block of shingles at a time bounds the unpacked bits of a very long text.
    values = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = sum(
        np.unpackbits(values[i : i + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        for i in range(0, len(values), 65536)
    )
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame, shingle: int = 3, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and fingerprint (64 bits as a signed bigint) of every row, over the whole text.

    Words are runs without ASCII blanks, A-Z lower-cased; fewer words than a shingle make one shingle.
    """

    rows = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text_of(f"`{text_column}`").cast("binary").alias("text")
    )
    return _printed(rows, shingle, seed)


def _printed(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """Rows with fingerprint in place of text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sliced(batches):
            found = [fingerprint_of(text, shingle, seed) for text in batch["text"]]
            yield batch.drop(columns="text").assign(fingerprint=np.array(found, dtype=np.uint64).view(np.int64))

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes if name != "text")
    return map_frames(rows, run, f"{schema}, fingerprint bigint")


def pivot_table(prints: DataFrame) -> DataFrame:
    """Distances of each fingerprint to all pivots, the unflipped reference first."""
    value = F.col("fingerprint")
    return prints.withColumn(
        "distances", F.array(*[F.bit_count(value.bitwiseXOR(F.lit(p))).cast("tinyint") for p in _pivots()])
    )


def links(prints: DataFrame, radius: int = 2, groups: int | None = None) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints at most radius bits apart; every such pair, each once."""
    table = prints.select("fingerprint").distinct()
    if groups is None:
        table = keep(table, "prints")
        groups = groups_for(table.count(), radius)
    pairs = pivot_join(table, radius, groups, lambda a, b: a["fingerprint"] < b["fingerprint"])
    return pairs.select(F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b")).distinct()


def groups_for(rows: int, radius: int) -> int:
    """The fewest groups whose keys let a row meet at most MEETINGS chance candidates; pairs are the same with any number."""
    bits = 1.5 * 64 / WIDTH
    for groups in range(radius + 2, 64 // WIDTH):
        if rows <= MEETINGS * 2 ** (bits * (groups - radius) / groups):
            return groups
    return 64 // WIDTH


def pivot_join(
    table: DataFrame,
    radius: int,
    groups: int | None,
    ordered: Callable[[Column, Column], Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Pairs of rows, as structs a and b, at most radius bits apart and equal in the columns `by`.

    Two distances to pivots that differ in one run of bits give the number of bits set in that run, so a
    pair within the radius has unequal coordinates in at most radius of the runs. With the runs dealt into
    groups, all but radius groups agree in full: each choice of so many groups is an equality join. Pairs
    whose largest difference of a coordinate exceeds the radius go; Hamming distance decides on the rest.
    A pair is found once for each choice it agrees in. `ordered` says which of a pair is a, and may rule
    pairs out.

    More groups make longer keys and fewer candidates for more copies of the table: a key has
    (groups - radius) / groups of 48 bits of information.
    """
    groups = groups or radius + 2
    keys = pivot_table(table).withColumn("_key", F.explode(_keys(groups, groups - radius))).drop("distances")
    keys = keys.select(*by, "_key.*", F.struct(*table.columns).alias("_row"))
    left, right = keys.withColumnRenamed("_row", "a"), keys.withColumnRenamed("_row", "b")
    one, two = F.col("a.fingerprint"), F.col("b.fingerprint")
    apart = [F.abs(F.bit_count(one.bitwiseXOR(F.lit(p))) - F.bit_count(two.bitwiseXOR(F.lit(p)))) for p in _pivots()]
    return (
        left.join(right, [*by, "choice", "code"])
        .filter(ordered(F.col("a"), F.col("b")))
        .filter(F.greatest(*apart) <= radius)
        .filter(F.bit_count(one.bitwiseXOR(two)) <= radius)
        .select("a", "b")
    )


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root for every node of a table of pairs (a, b); the root is the smallest node of the component.

    Alternates the large-star and the small-star step: each hangs a node's neighbours on the smallest one,
    which is folded per task before it is shuffled. Ends when a round changes nothing.
    """
    edges = cut(_downward(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    before = _state(edges)
    for _ in range(rounds):
        edges = cut(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = after
    raise RuntimeError(f"components not settled after {rounds} rounds")


def near_groups(
    documents: DataFrame, radius: int = 2, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document row: doc_id, fingerprint (bigint), component_id.

    The component holds every document reached over links of at most radius bits, equal fingerprints
    included; its id is the smallest doc_id in it, null only if all of its ids are null. Empty texts share
    the fingerprint 0, which links like any other. Repeated rows repeat in the result. Other columns are
    ignored. An empty table gives no rows.
    """
    rows = keep(fingerprints(documents, shingle, SEED, id_column, text_column), "fingerprints")
    distinct = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct, radius))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    per_print = rooted.join(named, "root").select("fingerprint", "component_id")
    return rows.join(per_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def near_distinct(
    documents: DataFrame, radius: int = 2, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component of near_groups, with all its columns; documents without a near copy stay as they are.

    The row with the smallest id stays, a null id before all others; of equal ids the one with the smallest MD5 of its text;
    of rows equal in both, any one. An empty table stays empty.

    Documents fold per fingerprint before they are shuffled, so a hot group leaves a task as one row. Texts
    travel once, folded by id and MD5, to meet the rows that stay.
    """
    texts = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text_of(f"`{text_column}`").cast("binary").alias("text")
    )
    prints = keep(_printed(texts.withColumn("key", F.unhex(F.md5("text"))), shingle, SEED), "fingerprints")
    name = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "key")
    least = keep(prints.groupBy("fingerprint").agg(F.min(name).alias("least")), "least")
    rooted = _rooted(least.withColumnRenamed("fingerprint", "node"), components(links(prints, radius)))
    staying = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.*")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")).select(
        "_row", F.coalesce(F.col("_row")[id_column].cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.unhex(F.md5(F.coalesce(F.col("_row")[text_column].cast("string"), F.lit("")))).alias("key"),
    )
    one = rows.groupBy("id", "key").agg(F.first("_row").alias("_row"))
    return one.join(staying, ["id", "key"]).select("_row.*")


def _shingles(words: list[bytes], width: int) -> list[tuple]:
    if len(words) <= width:
        return [tuple(words)] if words else []
    return list(zip(*(words[i:] for i in range(width)), strict=False))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    joined = rows.join(roots, "node", "left")
    return joined.select(*rows.columns, F.coalesce("root", "node").alias("root"))


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _pivots() -> list[int]:
    runs = [((1 << WIDTH) - 1) << i for i in range(0, 64, WIDTH)]
    return [_signed(REFERENCE)] + [_signed(REFERENCE ^ run) for run in runs]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keys(groups: int, equal: int) -> Column:
    """One key for each choice of `equal` groups: their coordinates, written in base WIDTH + 1."""
    runs = 64 // WIDTH
    first = F.get("distances", F.lit(0))

    def code(numbers: list[int]) -> Column:
        bits = [(first - F.get("distances", F.lit(i + 1)) + WIDTH).cast("bigint") for i in numbers]
        return reduce(lambda total, b: total * (WIDTH + 1) + F.shiftright(b, 1), bits, F.lit(0).cast("bigint"))

    parts = [list(range(g, runs, groups)) for g in range(groups)]
    choices = combinations(range(groups), equal)
    return F.array(*[
        F.struct(F.lit(n).alias("choice"), code([i for g in chosen for i in parts[g]]).alias("code"))
        for n, chosen in enumerate(choices)
    ])


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node u to the smaller node v."""
    return (
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return _downward(larger)


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u")
    return _downward(
        moved.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v"))
        )
    )


def _state(edges: DataFrame) -> tuple:
    """A few numbers that change when the set of edges does."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(mixed), F.bit_xor(F.xxhash64(mixed))).first()
    return tuple(row)
