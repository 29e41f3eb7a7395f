"""The pipeline's stages on the smallest tables, each held against plain loops over its own input."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from auriga.llm import mixing, queries, simhash, toxicity
from auriga.llm.common import keep, read
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def stages(spark):
    docs = read(spark, SMALL, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(keep(stage(spark, out[-1], SMALL), f"test-{name}"))
    return out


def words_of(text):
    return text.encode().lower().split()


def test_toxic_documents_go(spark, stages):
    predicted = toxicity.toxicity(stages[0], read(spark, SMALL, "labels")).collect()
    assert stages[1].columns == stages[0].columns
    assert {r["doc_id"] for r in stages[1].collect()} == {r["doc_id"] for r in predicted if not r["predicted"]}


def test_one_of_equal_texts_stays(stages):
    last = {}
    for r in stages[1].collect():
        last[r["text"] or ""] = max(r["doc_id"], last.get(r["text"] or "", -1))
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(last.values())


def test_one_of_near_copies_stays(stages):
    prints = {r["doc_id"]: simhash.fingerprint_of((r["text"] or "").encode()) for r in stages[2].collect()}
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2 and find(a) != find(b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert sorted(r["doc_id"] for r in stages[3].collect()) == [i for i in ids if find(i) == i]


def test_the_mix_repeats_and_cuts_documents_only(spark, stages):
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    taken = Counter()
    for r in stages[4].collect():
        whole, part = words_of(texts[r["doc_id"]]), words_of(r["text"])
        assert any(part == whole[at : at + len(part)] for at in range(len(whole) - len(part) + 1))
        assert r["n_chars"] == len(r["text"])
        taken[r["doc_id"]] += len(part)
    assert stages[4].columns == stages[0].columns
    asked = {r["doc_id"]: sum(d["taken"] for d in r["draws"]) for r in mixing.draws(stages[3]).collect()}
    assert taken == Counter({i: n for i, n in asked.items() if n})
    assert all(n <= 2 * len(words_of(texts[i])) for i, n in taken.items())


def test_packed_pieces_are_the_mixed_texts(spark, stages):
    encode, expected = queries.byte_bpe(), Counter()
    for r in stages[4].collect():
        ids = np.append(encode(r["text"]), 0).astype("<u4")
        expected[(r["doc_id"], len(ids))] += len(ids)
    got, places = Counter(), defaultdict(list)
    for p in stages[5].collect():
        got[(p["doc_id"], p["doc_tokens"])] += p["length"]
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    assert got == expected
    for parts in places.values():
        ends = [0, *np.cumsum([length for _, length in sorted(parts)])]
        assert [offset for offset, _ in sorted(parts)] == ends[:-1]
        assert ends[-1] <= 1024
    padded = sum(1024 - sum(length for _, length in parts) for parts in places.values())
    assert padded <= 0.02 * sum(got.values()) + 1024


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    result = corpus_pipeline.run(spark, SMALL)
    assert result.columns == stages[5].columns
    assert result.agg({"length": "sum"}).first()[0] == stages[5].agg({"length": "sum"}).first()[0]
    assert set(columns) <= set(result.columns)


def test_scores_beat_the_unigram(spark):
    rows = queries.QUERIES["op4_hidden_markov"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in held)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_any_rows(spark, name, stage):
    """Nulls in every column, large ids beside null ones, long texts, repeats and names that operators use inside."""
    clashing = "mix_shard int, mix_epoch int, row int, shard string, id int, key string, fingerprint int, _row int, draws string"
    rng = np.random.default_rng(3)
    rows = [(2**60 + i, " ".join(f"w{i}x{n}" for n in rng.integers(0, 300, 60)), "en", f"s{i % 3}", 5) for i in range(100)]
    rows += [(None, "alone " * 5, None, None, None), (None, None, "de", None, 0), (7, "", "en", "s1", 0), (8, None, None, "s2", None)]
    rows += [rows[3], rows[3], (9, "long text of many words " * 40_000, "en", "s1", 1)]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {clashing}"
    more = [1, 2, 3, "s", 4, "k", 5, 6, "d"]
    docs = spark.createDataFrame([(*r, *more) for r in rows], schema).repartition(3)
    found = stage(spark, docs, SMALL).collect()
    asked = {2**60 + i for i in range(100)}
    got = Counter(r["doc_id"] for r in found)
    if name == "mixing":
        # Weights 3, 1, 2 of the sources: the most of s0 is taken, no id is another than those given.
        assert set(got) <= {r[0] for r in rows} and len(set(got) & asked) > 30
    else:
        assert asked <= set(got) and None in got and 9 in got
    if name == "exact_dedup":
        assert got[2**60 + 3] == 1 and got[8] == 1 and got[7] == 0
    if name == "simhash":
        assert got[2**60 + 3] == 1 and got[None] == 2 and got[7] == got[8] == 0
    if name != "packing":
        assert stage(spark, docs, SMALL).columns == docs.columns
    assert stage(spark, docs.limit(0), SMALL).count() == 0
