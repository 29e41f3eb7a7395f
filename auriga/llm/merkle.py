"""Merkle manifest of a table: hash trees per source in blocks laid out by van Emde Boas, with proofs and their checks."""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.llm.common import keep

ARITY = 16
# Levels of a stored block: 16 ** 3 leaves, whose nodes are about 140 KB.
HEIGHT = 3
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon and itself; a null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The 32 bytes of a leaf."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


# --- the layout ----------------------------------------------------------------


def nodes_of(height: int, leaves: int, arity: int = ARITY) -> int:
    """Nodes of a tree of so many levels above its leaves; the last run of each level may be short."""
    return sum(-(-leaves // arity**level) for level in range(height + 1))


def layout(height: int, leaves: int, arity: int = ARITY) -> list[np.ndarray]:
    """Address of every node, level by level from the leaves to the root.

    The tree is split at half its height: the top tree comes first, then the bottom trees from left to right, each laid
    out the same way. All bottom trees but the last are full, so addresses follow from sizes alone, and a
    walk from a leaf to the root stays inside few stretches of memory, whatever the size of a cache line.
    """
    if height == 0:
        return [np.zeros(1, dtype=np.int64)]
    top_height = (height + 1) // 2 - 1
    low = height - top_height - 1
    span = arity**low
    roots = -(-leaves // span)
    top_leaves = -(-roots // arity)
    first = nodes_of(top_height, top_leaves, arity)
    top = layout(top_height, top_leaves, arity)
    step, last = nodes_of(low, span, arity), leaves - (roots - 1) * span
    ends = layout(low, last, arity)
    if roots == 1:
        return [first + a for a in ends] + top
    full = layout(low, span, arity)
    starts = first + step * np.arange(roots - 1)[:, None]
    bottom = [
        np.concatenate([(starts + inner).ravel(), first + step * (roots - 1) + end])
        for inner, end in zip(full, ends, strict=True)
    ]
    return bottom + top


def digest_of(members: list[str]) -> bytes:
    return sha256("".join(members).encode()).digest()


def build(leaves: list[bytes], height: int, arity: int = ARITY, places: list[np.ndarray] | None = None) -> bytes:
    """Digests of all nodes over the leaves, each written at its address."""
    places = places or layout(height, len(leaves), arity)
    out = np.empty((nodes_of(height, len(leaves), arity), DIGEST), dtype=np.uint8)
    level = leaves
    for number, at in enumerate(places):
        out[at] = np.frombuffer(b"".join(level), dtype=np.uint8).reshape(-1, DIGEST)
        if number < height:
            text = [d.hex() for d in level]
            level = [digest_of(text[i : i + arity]) for i in range(0, len(text), arity)]
    return out.tobytes()


def runs(nodes: bytes, places: list[np.ndarray]) -> list[list[str]]:
    """The nodes in hexadecimal, level by level from the leaves to the root, read at their addresses."""
    stored = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, DIGEST)
    return [[d.tobytes().hex() for d in stored[at]] for at in places]


def siblings(levels: list[list[str]], index: int, arity: int = ARITY) -> list[tuple[str, str]]:
    """For each level below the root what stands left and right of the node above leaf `index` in its run."""
    out = []
    for nodes in levels[:-1]:
        run = index // arity * arity
        out.append(("".join(nodes[run:index]), "".join(nodes[index + 1 : run + arity])))
        index //= arity
    return out


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


# --- over tables ---------------------------------------------------------------


def placed(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Rows with place (from 0, along the order) and size (rows) of their tree, and without a window over a tree.

    Ranges of tree and order are numbered as they are written; a table of one row per range and tree tells
    where each goes on. Rows that tie are told apart by where they were read, so many equal ones spread.
    """
    keys = [tree, *order, "_read"]
    ranged = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*keys)
    numbered = ranged.sortWithinPartitions(*keys).withColumns({
        "_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id(),
    })
    numbered = keep(numbered.drop("_read"), "merkle-order")
    along = Window.partitionBy(tree).orderBy("_range")
    stretches = numbered.groupBy(tree, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")).select(
        F.col(tree).alias("_tree"), F.col("_range").alias("_r"),
        (F.sum("_rows").over(along) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(tree)).alias("size"),
    )
    return numbered.join(stretches, (F.col(tree) == F.col("_tree")) & (F.col("_range") == F.col("_r"))).select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias("place"), "size"
    )


BLOCK = (
    "tree string, size bigint, height int, block bigint, leaves int, levels int, nodes binary, top binary, "
    "ids array<bigint>, seen binary"
)
PATH = "tree string, place bigint, lefts array<string>, rights array<string>, subroot string, root string"
PROOF = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def tree_height(size: int) -> int:
    height, span = 0, 1
    while span < size:
        height, span = height + 1, span * ARITY
    return height


def blocks(nodes: DataFrame, tier: int, height: int = HEIGHT) -> DataFrame:
    """Nodes (tree, size, place, digest, id, seen) -> their aligned blocks, one row each.

    A block holds the digests of its subtree in the order of the layout; in the first tier also ids and the digests to
    be checked, in the order of the leaves. A block is a group of at most ARITY ** height rows.
    """
    known: dict = {}

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        leaves, size = group["digest"].to_pylist(), group["size"][0].as_py()
        whole = tree_height(size)
        levels = min(height, max(0, whole - tier * height))
        places = _layout_of(known, levels, len(leaves))
        packed = build(leaves, levels, places=places)
        top = int(places[-1][0]) * DIGEST
        seen = [s or d for s, d in zip(group["seen"].to_pylist(), leaves, strict=True)]
        return pa.table({
            "tree": group["tree"][:1], "size": group["size"][:1],
            "height": pa.array([whole], pa.int32()), "block": group["block"][:1], "leaves": pa.array([len(leaves)], pa.int32()), "levels": pa.array([levels], pa.int32()),
            "nodes": pa.array([packed], pa.binary()), "top": pa.array([packed[top : top + DIGEST]], pa.binary()),
            "ids": pa.array([None if tier else group["id"].to_pylist()], pa.list_(pa.int64())),
            "seen": pa.array([None if tier else b"".join(seen)], pa.binary()),
        })

    block = F.floor(F.col("place") / ARITY**height).cast("bigint").alias("block")
    rows = nodes.select("tree", "size", block, "place", "digest", "id", "seen")
    return rows.groupBy("tree", "block").applyInArrow(run, BLOCK)


def tiers(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Tables of blocks: the first over the given nodes, each further one over the roots of the blocks before it."""
    found: list[DataFrame] = []
    while True:
        found.append(keep(blocks(nodes, len(found), height), "merkle-blocks"))
        rest = found[-1].filter(F.col("height") > height * len(found))
        if rest.isEmpty():
            return found
        nodes = rest.select(
            "tree", "size", F.col("block").alias("place"), F.col("top").alias("digest"),
            F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("seen"),
        )


def roots(found: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """tree, digest: the root of every tree, from the tier at which the tree ends."""
    return reduce(DataFrame.unionByName, [
        table.filter(_ends(tier, height) & (F.col("height") > height * tier if tier else F.lit(True)))
        .select("tree", F.col("top").alias("digest"))
        for tier, table in enumerate(found)
    ])


def block_paths(found: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The first tier's blocks, each with its path: what stands beside it on every level up to the root.

    `above` has a row for each tree with the path from its root on (tree, lefts, rights, subroot, root). Each tier hands
    its blocks' paths on to the blocks below them.
    """
    paths = None
    for tier in reversed(range(len(found))):
        table = found[tier]
        own = table.filter(_ends(tier, height)).join(above, "tree")
        if paths is not None:
            inner = table.filter(~_ends(tier, height)).join(paths.withColumnRenamed("place", "block"), ["tree", "block"])
            own = own.unionByName(inner.select(*own.columns))
        if tier:
            paths = keep(leaf_paths(own, height), "merkle-paths")
    return own


def leaf_paths(blocks_with_paths: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The path of each leaf of the blocks: through the block, then the block's own."""
    known: dict = {}

    def run(group: pa.Table) -> pa.Table:
        row, levels, upper = _opened(group, known)
        out = [siblings(levels, i) + upper for i in range(row["leaves"])]
        first = row["block"] * ARITY**height
        return pa.table({
            "tree": pa.array([row["tree"]] * len(out), pa.string()),
            "place": pa.array(range(first, first + len(out)), pa.int64()),
            "lefts": pa.array([[left for left, _ in path] for path in out], pa.list_(pa.string())),
            "rights": pa.array([[right for _, right in path] for path in out], pa.list_(pa.string())),
            "subroot": pa.array([row["subroot"]] * len(out), pa.string()),
            "root": pa.array([row["root"]] * len(out), pa.string()),
        })

    return blocks_with_paths.groupBy("tree", "block").applyInArrow(run, PATH)


def proofs(documents: DataFrame, claimed: Column | None = None, fields=FIELDS, height: int = HEIGHT) -> DataFrame:
    """One row per document row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves are hashes of the fields. Per source (fields[1]) they ascend by id (fields[0]), nulls first, then by their own
    digest; every ARITY consecutive nodes of a level become their hash until one is left, the subroot. Subroots, in
    order of the source (null first, by bytes), give the root the same way. A proof is what stands beside a node, level by
    level from leaf to root. folded_root is what the proof gives for the leaf of the row as `claimed` has its last field (null
    where it is to be taken as it is; by default nothing is claimed); verified tells whether that is the root.

    Rows that are equal in all fields are leaves of their own and change places freely. A null source is a source. Null
    and empty texts have different leaves. Other columns are ignored, whatever their names. An empty table gives no rows.

    Leaves are numbered by ranges, so a source with most of the rows is spread; trees are stored as blocks of 16 ** height
    leaves laid out by van Emde Boas; the roots of a tier's blocks are the leaves of the next tier. Texts never leave
    their task.
    """
    values = [F.col(f"`{c}`") for c in fields]
    claim = F.lit(None).cast("string") if claimed is None else claimed
    rows = documents.select(
        values[1].cast("string").alias("source"), values[0].cast("bigint").alias("id"), leaf(*values).alias("digest"),
        F.when(claim.isNotNull(), leaf(*values[:-1], claim)).alias("seen"),
    ).withColumn("tree", field(F.col("source")))
    # Texts are hashed once: the ranges are set by a first pass over what is kept of them.
    rows = keep(rows, "merkle-leaves")
    nodes = placed(rows, "tree", "id", "digest")
    found = tiers(nodes, height)
    sources = nodes.groupBy("tree").agg(F.first("source").alias("source"))
    tops = roots(found, height).join(sources, "tree").select(F.lit("").alias("all"), "tree", "source", "digest")
    tops = keep(placed(tops, "all", "source"), "merkle-tops")
    nothing = {"id": F.lit(None).cast("bigint"), "seen": F.lit(None).cast("binary")}
    upper = tiers(tops.withColumns(nothing).withColumn("tree", F.col("all")), height)
    none = F.array().cast("array<string>")
    root = roots(upper, height).select(
        "tree", none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"),
        F.lower(F.hex("digest")).alias("root"),
    )
    to_root = leaf_paths(block_paths(upper, root, height), height).select("place", "lefts", "rights", "root")
    above = tops.join(to_root, "place").select(
        "tree", "lefts", "rights", F.lower(F.hex("digest")).alias("subroot"), "root"
    )
    return block_paths(found, keep(above, "merkle-above"), height).groupBy("tree", "block").applyInArrow(_checked({}), PROOF)


def _checked(known: dict):
    def run(group: pa.Table) -> pa.Table:
        row, levels, upper = _opened(group, known)
        rest, root = "".join(left + right for left, right in upper), row["root"]
        proof, folded = [], []
        for index in range(row["leaves"]):
            path = siblings(levels, index)
            proof.append(sha256(("".join(a + b for a, b in path) + rest).encode()).hexdigest())
            folded.append(fold(row["seen"][index * DIGEST : (index + 1) * DIGEST].hex(), path + upper))
        many = row["leaves"]
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "leaf": pa.array(levels[0], pa.string()),
            "subroot": pa.array([row["subroot"]] * many, pa.string()), "root": pa.array([root] * many, pa.string()),
            "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([f == root for f in folded], pa.bool_()),
        })

    return run


def _opened(group: pa.Table, known: dict) -> tuple[dict, list[list[str]], list[tuple[str, str]]]:
    """The one row of a group, its nodes in hexadecimal by level, and its path."""
    row = group.to_pylist()[0]
    levels = runs(row["nodes"], _layout_of(known, row["levels"], row["leaves"]))
    return row, levels, list(zip(row["lefts"], row["rights"], strict=True))


def _layout_of(known: dict, levels: int, leaves: int) -> list[np.ndarray]:
    """The layout, worked out once per task for full blocks."""
    if leaves < ARITY**levels:
        return layout(levels, leaves)
    if levels not in known:
        known[levels] = layout(levels, leaves)
    return known[levels]


def _ends(tier: int, height: int) -> Column:
    """Whether a tree has its root in this tier."""
    return F.col("height") <= height * (tier + 1)
