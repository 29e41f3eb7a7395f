"""Chunking, page text and retrieval against plain loops."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from auriga.operators import documents, retrieval


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_nome string, texto string")


def test_sections_restore_the_marker(spark):
    got = documents.split_sections(docs(spark, "no mark", "# T\nintro\n## One\nx\n## Two\ny\n## "))
    rows = {r.chunk_id: r.texto for r in got.collect()}
    assert rows == {"d0#0": "no mark", "d1#0": "# T\nintro", "d1#1": "## One\nx", "d1#2": "## Two\ny"}


def test_chunk_check_counts(spark):
    row = documents.check_chunks(documents.split_sections(docs(spark, "a\n## b"))).first()
    assert (row.qtd_chunks, row.qtd_vazios) == (2, 0)


def test_bounded_chunks_lose_no_word(spark):
    text = " ".join(f"w{i}" for i in range(2501))
    got = documents.bounded_chunks(docs(spark, text, "  \n ", "one\ttwo")).orderBy("doc_nome", "parte_idx").collect()
    sizes = [r.n_tokens for r in got if r.doc_nome == "d0"]
    assert sum(sizes) == 2501 and max(sizes) <= 1000 and min(sizes) > 500
    assert " ".join(r.texto for r in got if r.doc_nome == "d0") == text
    assert [r.texto for r in got if r.doc_nome != "d0"] == ["one two"]


def test_page_text_drops_markup(spark):
    html = ('<html><head><title>A &amp; B</title><style>p{x:1}</style><script>var t="</p>";</script></head>'
            "<body><!-- no --><p>Hi&nbsp;<b>there</b>\n you&lt;</p></body></html>")
    row = documents.page_text(spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")).first()
    assert (row.titulo, row.texto) == ("A & B", "Hi there you<")


def _rows(df):
    return sorted((r.id_consulta, r.posicao, r[2], r.score) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    known, asked = rng.normal(size=(300, 8)), rng.normal(size=(30, 8))
    known[10] = known[11]

    def to_df(matrix, key):
        return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], f"{key} int, vetor array<double>")

    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(asked) @ unit(known).T, 6)
    best = [(q, place + 1, int(i), float(scores[q, i]))
            for q in range(30) for place, i in enumerate(sorted(range(300), key=lambda i: (-scores[q, i], i))[:4])]
    return to_df(asked, "id_consulta"), to_df(known, "id").repartition(5), best


def test_semantic_is_exact_both_ways(vectors):
    asked, known, best = vectors
    assert _rows(retrieval.semantic_top_k(asked, known)) == best
    assert _rows(retrieval.semantic_top_k(asked, known, query_rows=8)) == best


def test_approximate_recall(vectors):
    asked, known, best = vectors
    exact = {(q, i) for q, _, i, _ in best}
    found = {(r.id_consulta, r.id) for r in retrieval.approximate_top_k(asked, known).collect()}
    assert len(exact & found) / len(exact) >= 0.7


def _bm25(queries, chunks, k=4):
    bags = {c: re.findall(r"\w+", t.lower()) for c, t in chunks}
    mean = sum(map(len, bags.values())) / len(bags)
    out = []
    for q, text in queries:
        scores = {}
        for word in set(re.findall(r"\w+", text.lower())):
            df = sum(word in b for b in bags.values())
            if not df:
                continue
            idf = math.log(1 + (len(bags) - df + 0.5) / (df + 0.5))
            for c, bag in bags.items():
                tf = bag.count(word)
                if tf:
                    scores[c] = scores.get(c, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / mean))
        ranked = sorted(((round(s, 6), c) for c, s in scores.items()), key=lambda x: (-x[0], x[1]))[:k]
        out += [(q, i + 1, c, pytest.approx(s, abs=2e-6)) for i, (s, c) in enumerate(ranked)]
    return out


def test_lexical_matches_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    words = [f"p{i}" for i in range(40)] + ["ção", "Über"]
    chunks = [(f"c{i:03d}", " ".join(rng.choice(words, size=rng.integers(1, 30)))) for i in range(200)]
    queries = [(i, " ".join(rng.choice(words + ["unseen"], size=6))) for i in range(12)]
    chunk_df = spark.createDataFrame(chunks, "chunk_id string, texto string")
    query_df = spark.createDataFrame(queries, "id_consulta int, texto string")
    want = _bm25(queries, chunks)
    assert _rows(retrieval.lexical_top_k(query_df, chunk_df)) == want
    assert _rows(retrieval.lexical_top_k(query_df, chunk_df, most=10)) == want
    assert _rows(retrieval.lexical_top_k(query_df, chunk_df.limit(0))) == []
    assert _rows(retrieval.lexical_top_k(query_df.limit(0), chunk_df)) == []


def test_lexical_bounds_skip_work_and_lose_nothing():
    rng = np.random.default_rng(8)
    words = {f"p{i}": i for i in range(300)}
    often = 1 / np.arange(1, 301)
    bags = [list(rng.choice(list(words), size=rng.integers(5, 60), p=often / often.sum())) for _ in range(6000)]
    asked = [(q, w) for q in range(25) for w in set(bags[q * 7][:15])]
    owners, terms = np.array([q for q, _ in asked]), np.array([words[w] for _, w in asked])
    idf = np.log(6000 / (1 + np.array([sum(w in b for b in bags) for w in words])))
    idf = np.maximum(idf, 0.01)
    media = float(np.mean([len(b) for b in bags]))
    best = retrieval.BestChunks(25, owners, terms, idf, media, 4)
    every = np.zeros((25, 6000))
    for at in range(0, 6000, 500):
        block = bags[at : at + 500]
        postings = retrieval._postings(pa.array(block), words)
        best.add(pa.array([f"c{at + i:04d}" for i in range(len(block))]), postings)
        chunk, term, times, lengths = postings
        impact = idf[term] * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * lengths[chunk] / media))
        for q, t in zip(owners, terms):
            hit = term == t
            every[q, at + chunk[hit]] += impact[hit]
    scores = np.round(every, 6)
    want = [(q, f"c{i:04d}") for q in range(25) for i in sorted(range(6000), key=lambda i: (-scores[q, i], i))[:4]]
    assert list(zip(best.query.tolist(), best.chunk.to_pylist())) == want
    assert best.scored < (every > 0).sum() / 3


def test_context_lists_sources_in_rank_order(spark):
    chunks = documents.split_sections(docs(spark, "alpha beta\n## beta", "beta gamma"))
    asked = spark.createDataFrame([(1, "gamma beta")], "id_consulta int, texto string")
    found = retrieval.lexical_top_k(asked, chunks, k=2)
    text = retrieval.contexts(found, chunks).first().contexto
    assert text.startswith("[d1] beta gamma\n\n[d0] ")


def test_label_centers(spark):
    df = spark.createDataFrame([(0, [1.0, 3.0]), (0, [3.0, 5.0]), (1, [7.0, 7.0])], "label int, embedding array<float>")
    got = {r.label: r.vetor for r in retrieval.label_centers(df, 2).collect()}
    assert got == {0: [2.0, 4.0], 1: [7.0, 7.0]}


def test_tokens_cover_accents(spark):
    row = spark.createDataFrame([("Ação-2, ÜBER_x",)], "texto string").select(documents.tokens().alias("t")).first()
    assert row.t == ["ação", "2", "über", "x"]


def test_rule_policies_join_by_name(spark):
    rules = spark.createDataFrame([("R1", "n", "a.md"), ("R2", "m", "z.md")], "id_regra string, nome string, politica_referencia string")
    chunks = spark.createDataFrame([("a#0", "a.md"), ("b#0", "b.md")], "chunk_id string, politica string")
    assert [r.chunk_id for r in documents.rule_policies(rules, chunks).collect()] == ["a#0"]
    assert documents.rule_policies(rules, chunks.filter(F.lit(False))).count() == 0
