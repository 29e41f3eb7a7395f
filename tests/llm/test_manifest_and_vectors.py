"""Merkle manifest, exact top-k and centroid clustering against plain loops."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from auriga.llm import cell_clusters, merkle, top_products
from auriga.llm.queries import QUERIES

BIG = 1 << 60
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, place int, root int, size string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """Root, and the siblings of every leaf, by hand."""
    paths, level, at = [""] * len(leaves), list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a // 16 * 16 : a // 16 * 16 + 16]
            paths[i] += "".join(h for n, h in enumerate(run) if n != a % 16)
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        at = [a // 16 for a in at]
    return level[0], paths


def plain_manifest(rows):
    """doc_id, leaf, subroot, root, proof of each row; rows are (doc_id, text, lang, source, n_chars)."""
    leaves = [(r[3], r[0], plain_leaf((r[0], r[3], r[2], r[4], r[1]))) for r in rows]
    sources = sorted({r[0] for r in leaves}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted((r for r in leaves if r[0] == source), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[source] = own, *plain_tree([r[2] for r in own])
    root, above = plain_tree([trees[s][1] for s in sources])
    out = []
    for source, up in zip(sources, above, strict=True):
        own, top, paths = trees[source]
        out += [(r[1], r[2], top, root, sha(path + up)) for r, path in zip(own, paths, strict=True)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"Text {i}", "en", "hot", i) for i in range(600)]
    out += [(BIG + i, "Größe" * i, None, "b", None) for i in range(17)]
    out += [(None, None, None, None, None), (None, "", "de", None, 3), (5, "Same", "de", "ß", 1), (5, "Same", "de", "ß", 1)]
    return out + [(7, "x" * 300_000, "en", "long", 300_000), (8, "only", "en", "-", 4), (9, "Other", "en", "ß", 1)]


def documents(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, "s") for r in rows], DOCUMENTS).repartition(5)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_manifest_and_proofs(spark, rows, height):
    found = merkle.proofs(documents(spark, rows), height=height).collect()
    told = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in found]
    assert sorted(told, key=str) == plain_manifest(rows)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in found)


def test_changed_rows_fail_and_others_pass(spark, rows):
    claimed = F.when(F.col("doc_id") % 10 == 0, F.lower("text"))
    found = merkle.proofs(documents(spark, rows), claimed).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["doc_id"] is None or row["doc_id"] < 600:
            assert row["verified"] != (row["doc_id"] is not None and row["doc_id"] % 10 == 0)


@pytest.mark.parametrize("rows", [[], [(1, "a", "b", "c", 1)], [(1, "a", "b", None, 1), (2, "a", "b", "", 1)]])
def test_manifest_of_few_rows(spark, rows):
    found = merkle.proofs(documents(spark, rows)).collect()
    told = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in found]
    assert sorted(told, key=str) == (plain_manifest(rows) if rows else [])
    assert all(r["verified"] for r in found)


@pytest.mark.parametrize("height, leaves", [(0, 1), (1, 2), (2, 3), (3, 8), (3, 5), (4, 16), (4, 11), (5, 27), (6, 64), (7, 100)])
def test_layout_is_van_emde_boas(height, leaves):
    """Every address once; the top half of the tree first, then each bottom tree in one stretch, laid out alike."""
    arity = 2
    places = merkle.layout(height, leaves, arity)
    assert sorted(np.concatenate(places)) == list(range(merkle.nodes_of(height, leaves, arity)))
    if height:
        low = height - (height + 1) // 2
        top = np.concatenate(places[low + 1 :])
        assert top.max() == len(top) - 1
        for tree in range(-(-leaves // arity**low)):
            span = [p[tree * arity ** (low - n) : (tree + 1) * arity ** (low - n)] for n, p in enumerate(places[: low + 1])]
            own = np.concatenate(span)
            assert own.max() - own.min() == len(own) - 1
            inner = merkle.layout(low, len(span[0]), arity)
            assert all((a - own.min() == b).all() for a, b in zip(span, inner, strict=True))


def vectors_frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 2, "x") for i, v in rows], "vec_id bigint, embedding array<float>, row int, square int, ints string"
    ).repartition(3)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(5, 64))
    out = [(i, (centers[i % 5] * rng.uniform(0.1, 2) + rng.normal(size=64) * 0.3).astype(np.float32).tolist()) for i in range(700)]
    out[300] = (300, out[299][1])
    out += [(300, out[299][1]), (BIG, out[3][1]), (BIG + 100, out[4][1]), (None, out[4][1]), (None, out[299][1])]
    out += [(900, None), (901, []), (902, [float("nan")] * 64), (903, [None] * 64), (904, [float("inf")] + [0.0] * 63)]
    return out + [(1000, [1.0, -1.0]), (1001, [0.0] * 64), (1100, [0.0] * 64), (1002, [0.5] * 70)]


def plain_top(rows, k):
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if usable(v)]
    out = []
    for at, (query, one) in enumerate(kept):
        if query is None or query % 100:
            continue
        scored = [
            (-sum(a * b for a, b in zip(one, two, strict=False)), other is None, other or 0)
            for to, (other, two) in enumerate(kept) if to != at
        ]
        out += [(query, n + 1, None if none else other, -score) for n, (score, none, other) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("band, block, k", [(16384, 4096, 10), (50, 4, 10), (20, 1, 3), (64, 3, 1000)])
def test_top_products_are_exact(spark, vectors, band, block, k):
    found = top_products.top_products(
        vectors_frame(spark, vectors), F.col("vec_id") % 100 == 0, k, band=band, query_block=block, fit_rows=100
    )
    assert sorted([tuple(r) for r in found.collect()], key=str) == plain_top(vectors, k)


def test_top_products_of_large_numbers(spark):
    """Products past 2 ** 53, where doubles would lose the last digits."""
    rows = [(i * 100, [1e6 + i, 4e5 - i, 7.0 + i]) for i in range(30)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    found = top_products.top_products(vectors_frame(spark, rows), F.col("vec_id") % 100 == 0, 5, band=7)
    assert sorted([tuple(r) for r in found.collect()], key=str) == plain_top(rows, 5)


def test_top_products_of_nothing(spark, vectors):
    asked = F.col("vec_id") % 100 == 0
    assert top_products.top_products(vectors_frame(spark, []), asked).collect() == []
    assert top_products.top_products(vectors_frame(spark, [(100, None)]), asked).collect() == []
    assert top_products.top_products(vectors_frame(spark, [(101, [1.0])]), asked).collect() == []
    assert top_products.top_products(vectors_frame(spark, [(100, [1.0])]), asked).collect() == []


def plain_clusters(rows, count=16, rounds=3):
    kept = [
        (i, np.array([int(np.floor(64 * float(np.float32(x)))) for x in v])) for i, v in rows if usable(v) and len(v) == 64
    ]
    order = sorted(kept, key=lambda r: (sha(f"1:{'' if r[0] is None else r[0]}"), r[1].tolist()))
    centers = [v for _, v in order[:count]]

    def nearest(v):
        return min(range(len(centers)), key=lambda c: (((v - centers[c]) ** 2).sum(), c))

    for _ in range(rounds):
        own = [nearest(v) for _, v in kept]
        for c in range(len(centers)):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            if members:
                centers[c] = sum(members) // len(members)
    found = [(i, nearest(v), int(((v - centers[nearest(v)]) ** 2).sum())) for i, v in kept]
    total = {c: sum(d for _, o, d in found if o == c) for c in range(len(centers))}
    return sorted(
        [(i, c, d, total[c], sum(total.values()), sha(",".join(map(str, centers[c].tolist())))) for i, c, d in found], key=str
    )


@pytest.mark.parametrize("count", [16, 3])
def test_clusters_are_exact(spark, vectors, count):
    found = cell_clusters.clusters(vectors_frame(spark, vectors), clusters=count, fit_rows=100)
    assert sorted([tuple(r) for r in found.collect()], key=str) == plain_clusters(vectors, count)


def test_clusters_of_few_vectors(spark, vectors):
    assert cell_clusters.clusters(vectors_frame(spark, [])).collect() == []
    assert cell_clusters.clusters(vectors_frame(spark, [(1, None), (2, [1.0])])).collect() == []
    few = vectors[:3] + vectors[:1]
    found = cell_clusters.clusters(vectors_frame(spark, few))
    assert sorted([tuple(r) for r in found.collect()], key=str) == plain_clusters(few)


def test_intervals_hold_every_distance_and_settle_most(vectors):
    given = np.array([np.floor(64 * np.float32(v).astype(float)) for _, v in vectors[:700]], dtype=np.int64)
    edges = cell_clusters.cell_edges(given[:100], np.array([given.min(axis=0), given.max(axis=0)]))
    cell = np.stack([np.searchsorted(edges[1:-1, d], given[:, d], side="right") for d in range(64)], axis=1).astype(np.uint8)
    code, centers = cell[:, 0::2] << 4 | cell[:, 1::2], given[:5]
    tables = cell_clusters.interval_tables(edges, centers)
    bounds = sum(tables[i][code[:, i]] for i in range(32))
    exact = ((given[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (bounds[:, :5] <= exact).all() and (exact <= bounds[:, 5:]).all()
    best, left = cell_clusters.nearest(code, given, tables, centers)
    assert (best == exact.argmin(axis=1)).all()
    assert len(left) < len(given) / 2


@pytest.mark.parametrize("name", ["op11_merkle", "op12_top_products", "op13_cell_clusters"])
def test_registered(name):
    assert name in QUERIES
