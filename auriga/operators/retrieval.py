"""Exact top-k retrieval of many queries at once, by vector (cosine) or by words (BM25).

Words of a counted batch of queries go to the tasks, which skip what their bounds rule out; those of a larger one
are joined. Exact vectors need every product: a batch of queries counted within QUERY_ROWS travels to the tasks and the corpus is read once without a
shuffle, each task keeping its k best per query; a larger batch is cut into blocks that meet blocks of the
corpus, with equal rows. Approximate vectors are an equality join of signatures.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.operators.documents import tokens
from auriga.sources.stored import store_once

QUERY_ROWS = 1024
CORPUS_BLOCK = 50_000
# Words of all queries that go to the tasks, and chunks that are scored at a time.
ASKED = 1 << 19
POSTING_BLOCK = 2048
DIGITS = 6

# The usual BM25 constants.
K1 = 1.2
B = 0.75

# A scorer is built from a frame of queries; it turns a frame of texts into a
# (queries x texts) matrix of scores, NaN where a text is no candidate.
Scorer = Callable[[pd.DataFrame], Callable[[pd.DataFrame], np.ndarray]]


def top_k(queries: DataFrame, corpus: DataFrame, scorer: Scorer, k: int, query_rows: int = QUERY_ROWS) -> DataFrame:
    """queries(id_consulta, ...) x corpus(id, ...) -> (id_consulta, posicao, id, score).

    Equal scores fall back to the smaller id.
    """
    id_type = dict(corpus.dtypes)["id"]
    query_type = dict(queries.dtypes)["id_consulta"]
    schema = f"id_consulta {query_type}, id {id_type}, score double"
    # Reads at most one row past the bound, so it is also the size check.
    batch = queries.limit(query_rows + 1).toPandas()
    if len(batch) <= query_rows:

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            if batch.empty:
                return
            score, best = scorer(batch), None
            for frame in frames:
                found = _best(batch, frame, score(frame), k)
                best = found if best is None else _keep(pd.concat([best, found]), k)
            if best is not None:
                yield best

        near = corpus.mapInPandas(run, schema)
    else:
        near = _by_blocks(queries, corpus, scorer, k, schema, query_rows)
    place = Window.partitionBy("id_consulta").orderBy(F.col("score").desc(), "id")
    return (
        near.withColumn("posicao", F.row_number().over(place).cast("bigint"))
        .filter(F.col("posicao") <= k)
        .select("id_consulta", "posicao", "id", "score")
    )


def _by_blocks(
    queries: DataFrame, corpus: DataFrame, scorer: Scorer, k: int, schema: str, query_rows: int
) -> DataFrame:
    """Hash both sides into blocks of bounded size and score every pair of blocks."""
    query_blocks = -(-queries.count() // max(1, query_rows // 2))
    corpus_blocks = max(1, -(-corpus.count() // CORPUS_BLOCK))

    def block(column: str, blocks: int):
        return F.pmod(F.xxhash64(column), F.lit(blocks))

    left = corpus.withColumn("_c", block("id", corpus_blocks)).withColumn(
        "_q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint")))
    )
    right = queries.withColumn("_q", block("id_consulta", query_blocks)).withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(corpus_blocks - 1).cast("bigint")))
    )

    def run(texts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if texts.empty or asked.empty:
            return pd.DataFrame(columns=["id_consulta", "id", "score"])
        asked = asked.reset_index(drop=True)
        return _best(asked, texts, scorer(asked)(texts), k)

    return left.groupBy("_q", "_c").cogroup(right.groupBy("_q", "_c")).applyInPandas(run, schema)


def _best(queries: pd.DataFrame, texts: pd.DataFrame, scores: np.ndarray, k: int) -> pd.DataFrame:
    """The k best texts of each query in one frame."""
    ids = texts["id"].to_numpy()
    parts = []
    for query, row in zip(queries["id_consulta"], np.round(scores, DIGITS)):
        candidates = np.flatnonzero(~np.isnan(row))
        if len(candidates) > k:
            values = row[candidates]
            floor = np.partition(values, len(values) - k)[len(values) - k]
            candidates = candidates[values >= floor]
        parts.append(pd.DataFrame({"id_consulta": query, "id": ids[candidates], "score": row[candidates]}))
    return _keep(pd.concat(parts), k)


def _keep(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = rows.sort_values(["id_consulta", "score", "id"], ascending=[True, False, True])
    return ordered.groupby("id_consulta").head(k)


# --- by vector ---------------------------------------------------------------


def cosine(queries: pd.DataFrame) -> Callable[[pd.DataFrame], np.ndarray]:
    wanted = _unit(np.stack(queries["vetor"].to_numpy()).astype(float))

    def score(texts: pd.DataFrame) -> np.ndarray:
        return wanted @ _unit(np.stack(texts["vetor"].to_numpy()).astype(float)).T

    return score


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.full_like(vectors, np.nan), where=length > 0)


def semantic_top_k(queries: DataFrame, corpus: DataFrame, k: int = 4, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Exact nearest texts by cosine; both sides carry a `vetor` array."""
    return top_k(queries.select("id_consulta", "vetor"), corpus.select("id", "vetor"), cosine, k, query_rows)


def signatures(vectors: DataFrame, key: str, bits: int, tables: int, seed: int = 7) -> DataFrame:
    """key, tabela, assinatura: sides of `bits` random hyperplanes that a vector is on, in each table."""
    powers = 2 ** np.arange(bits)
    schema = f"{key} {dict(vectors.dtypes)[key]}, assinaturas array<bigint>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                given = np.stack(frame["vetor"].to_numpy()).astype(float)
                planes = np.random.default_rng(seed).normal(size=(tables, bits, given.shape[1]))
                codes = (np.einsum("tbd,nd->ntb", planes, given) > 0) @ powers
                yield pd.DataFrame({key: frame[key], "assinaturas": list(codes)})

    found = vectors.select(key, "vetor").mapInPandas(run, schema)
    return found.select(key, F.posexplode("assinaturas").alias("tabela", "assinatura"))


def approximate_top_k(
    queries: DataFrame, corpus: DataFrame, k: int = 4, bits: int = 5, tables: int = 32
) -> DataFrame:
    """Nearest texts among those that share a signature in some table; may miss neighbours, never misstates a score.

    Candidates come from an equality join of signatures, whose hot ones adaptive execution splits.
    """
    asked, known = (signatures(df, key, bits, tables) for df, key in ((queries, "id_consulta"), (corpus, "id")))
    pairs = asked.join(known, ["tabela", "assinatura"]).select("id_consulta", "id").distinct()

    def dot(a: str, b: str):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)

    length = F.sqrt(dot("q", "q") * dot("v", "v"))
    scored = (
        pairs.join(queries.select("id_consulta", F.col("vetor").alias("q")), "id_consulta")
        .join(corpus.select("id", F.col("vetor").alias("v")), "id")
        .filter(length > 0)
        .select("id_consulta", "id", F.round(dot("q", "v") / length, DIGITS).alias("score"))
    )
    return best_of_each(scored, "id", k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """recall, scores_equal: how many exact neighbours were found, and whether shared ones have the same score."""
    both = exact.select("id_consulta", "id", F.col("score").alias("exact")).join(
        found.select("id_consulta", "id", "score"), ["id_consulta", "id"], "left"
    )
    same = F.col("score").isNull() | (F.abs(F.col("score") - F.col("exact")) <= 2 * 10.0**-DIGITS)
    return both.agg(F.avg(F.col("score").isNotNull().cast("double")).alias("recall"), F.every(same).alias("scores_equal"))


def best_of_each(scored: DataFrame, key: str, k: int) -> DataFrame:
    """id_consulta, posicao, key, score: the k best per query. Ranks are cut in each task before the shuffle."""
    place = Window.partitionBy("id_consulta").orderBy(F.col("score").desc(), key)
    return (
        scored.withColumn("posicao", F.row_number().over(place).cast("bigint"))
        .filter(F.col("posicao") <= k)
        .select("id_consulta", "posicao", key, "score")
    )


def label_centers(vectors: DataFrame, size: int) -> DataFrame:
    """Mean vector of each label as one aggregate of `size` columns."""
    means = [F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(size)]
    return vectors.groupBy("label").agg(F.array(*means).alias("vetor"))


# --- by words ----------------------------------------------------------------


def lexical_top_k(queries: DataFrame, chunks: DataFrame, k: int = 4, most: int = ASKED) -> DataFrame:
    """queries(id_consulta, texto), chunks(chunk_id, texto) -> the k best chunks by BM25, equal scores by chunk_id.

    Chunks are cut into words once, into a stored table. If the queries have at most `most` words in all (read up to one
    past it, which is the check), they go to the tasks: each scores its chunks in blocks and keeps the k best, so no
    pair is shuffled. Beyond that, postings join the queries on the word. Both give the same rows.
    """
    bags = store_once(chunks.select("chunk_id", tokens().alias("palavras")), "bags")
    size = bags.agg(F.count("*").alias("n"), F.avg(F.size("palavras")).alias("media")).first()
    asked = queries.select("id_consulta", F.explode(F.array_distinct(tokens())).alias("palavra"))
    batch = asked.limit(most + 1).toArrow()
    if batch.num_rows > most:
        return best_of_each(_joined_scores(asked, bags, size), "chunk_id", k)
    return best_of_each(_task_scores(asked, batch, bags, size, k), "chunk_id", k)


def _joined_scores(asked: DataFrame, bags: DataFrame, size) -> DataFrame:
    """Scores by equality joins: words of chunks meet the queries' words first, so only those are counted and shuffled."""
    postings = (
        bags.select("chunk_id", F.size("palavras").alias("tamanho"), F.explode("palavras").alias("palavra"))
        .join(asked.select("palavra").distinct(), "palavra", "left_semi")
        .groupBy("palavra", "chunk_id", "tamanho")
        .agg(F.count("*").alias("tf"))
    )
    spread = postings.groupBy("palavra").agg(F.count("*").alias("df"))
    weighted = asked.join(spread.select("palavra", _idf(size["n"]).alias("peso")), "palavra")
    norm = K1 * (1 - B + B * F.col("tamanho") / F.lit(size["media"]))
    return (
        postings.join(weighted, "palavra")
        .groupBy("id_consulta", "chunk_id")
        .agg(F.round(F.sum(F.col("peso") * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)), DIGITS).alias("score"))
    )


def _idf(rows: int) -> Column:
    return F.log(1 + (F.lit(rows) - F.col("df") + 0.5) / (F.col("df") + 0.5))


def _task_scores(asked: DataFrame, batch: pa.Table, bags: DataFrame, size, k: int) -> DataFrame:
    """The k best of every task: id_consulta, chunk_id, score."""
    spread = (
        bags.select(F.explode(F.array_distinct("palavras")).alias("palavra"))
        .join(asked.select("palavra").distinct(), "palavra", "left_semi")
        .groupBy("palavra").agg(F.count("*").alias("df")).select("palavra", _idf(size["n"]).alias("peso"))
    )
    weights = {row["palavra"]: row["peso"] for row in spread.collect()}
    ids = batch["id_consulta"].unique()
    numbers = {value: n for n, value in enumerate(ids.to_pylist())}
    known = [
        (numbers[q], w) for q, w in zip(batch["id_consulta"].to_pylist(), batch["palavra"].to_pylist(), strict=True) if w in weights
    ]
    words = {w: n for n, w in enumerate(weights)}
    owners = np.array([q for q, _ in known], dtype=np.int64)
    terms = np.array([words[w] for _, w in known], dtype=np.int64)
    idf, media = np.array(list(weights.values())), size["media"]
    chunk_type = dict(bags.dtypes)["chunk_id"]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestChunks(len(ids), owners, terms, idf, media, k)
        for frame in frames:
            for at in range(0, frame.num_rows, POSTING_BLOCK):
                part = frame.slice(at, POSTING_BLOCK)
                best.add(part["chunk_id"], _postings(part["palavras"], words))
        if len(best.query):
            yield best.rows(ids)

    return bags.mapInArrow(run, f"id_consulta {dict(asked.dtypes)['id_consulta']}, chunk_id {chunk_type}, score double")


def _postings(lists: pa.ListArray, words: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """chunk, term, times and length of each asked word of each chunk of a block."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    number = np.array([words.get(w, -1) for w in coded.dictionary.to_pylist()], dtype=np.int64)
    term = number[coded.indices.to_numpy(zero_copy_only=False)] if len(number) else np.empty(0, dtype=np.int64)
    chunk = np.repeat(np.arange(len(lists)), lengths)
    width = max(len(words), 1)
    keys, times = np.unique((chunk * width + term)[term >= 0], return_counts=True)
    return keys // width, keys % width, times, lengths


class BestChunks:
    """The k best chunks of each query so far, block by block of chunks.

    A block has each word's largest impact in it. A query whose words' largest impacts in the block add up to less than its
    k-th score skips the block. Of the others, the words of least impact that cannot lift a chunk to the k-th score by
    themselves open no chunk: only chunks with some other word of the query are counted, and of these
    only the ones that may still reach it are counted in full.
    """

    def __init__(self, queries: int, owners: np.ndarray, terms: np.ndarray, idf: np.ndarray, media: float, k: int):
        self.queries, self.idf, self.media, self.k = queries, idf, media, k
        order = np.argsort(owners, kind="stable")
        self.owners, self.terms = owners[order], terms[order]
        self.floor = np.full(queries, -np.inf)
        self.opened = self.scored = 0
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.chunk = pa.array([], pa.null())

    def add(self, ids: pa.Array, postings: tuple) -> None:
        chunk, term, times, lengths = postings
        impact = self.idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths[chunk] / self.media))
        most = np.zeros(len(self.idf))
        np.maximum.at(most, term, impact)
        bound = most[self.terms]
        reach = np.bincount(self.owners, weights=bound, minlength=self.queries)
        # Scores are rounded; half a unit more keeps what may round up to the floor.
        floor = self.floor - 10.0**-DIGITS
        entry = np.flatnonzero((bound > 0) & (reach[self.owners] >= floor[self.owners]))
        entry = entry[np.lexsort((bound[entry], self.owners[entry]))]
        owner, ub = self.owners[entry], bound[entry]
        total = np.cumsum(ub)
        first = np.searchsorted(owner, owner)
        below = total - (total[first] - ub[first])
        minor = below < floor[owner]
        order = np.argsort(term, kind="stable")
        by_term, starts = term[order], np.searchsorted(term[order], np.arange(len(self.idf) + 1))
        major = entry[~minor]
        spans = starts[self.terms[major] + 1] - starts[self.terms[major]]
        place = order[_ranges(starts[self.terms[major]], spans)]
        pairs, at = np.unique(np.repeat(self.owners[major], spans) * len(lengths) + chunk[place], return_inverse=True)
        part = np.bincount(at, weights=impact[place], minlength=len(pairs))
        query, where = pairs // len(lengths), pairs % len(lengths)
        rest = np.bincount(owner[minor], weights=ub[minor], minlength=self.queries)
        alive = part + rest[query] >= floor[query]
        query, where, part = query[alive], where[alive], part[alive]
        self.opened += len(alive)
        self.scored += len(part)
        self._merge(query, np.round(part + self._minor(query, where, owner[minor], self.terms[entry[minor]], chunk, term, impact), DIGITS), ids, where)

    def _minor(self, query, where, owner, words, chunk, term, impact) -> np.ndarray:
        """What the words that open no chunk add to the chunks that are open."""
        first = np.searchsorted(owner, np.arange(self.queries + 1))
        spans = first[query + 1] - first[query]
        entry = _ranges(first[query], spans)
        pair = np.repeat(np.arange(len(query)), spans)
        key, wanted = chunk * len(self.idf) + term, np.repeat(where, spans) * len(self.idf) + words[entry]
        found = np.searchsorted(key, wanted)
        hit = found < len(key)
        hit[hit] = key[found[hit]] == wanted[hit]
        return np.bincount(pair[hit], weights=impact[found[hit]], minlength=len(query))

    def _merge(self, query: np.ndarray, score: np.ndarray, ids: pa.Array, where: np.ndarray) -> None:
        close = score >= self.floor[query]
        chunk = ids.take(pa.array(where[close]))
        chunk = pa.concat_arrays([self.chunk.cast(chunk.type), chunk])
        query, score = np.concatenate([self.query, query[close]]), np.concatenate([self.score, score[close]])
        name = pc.rank(chunk, "ascending", tiebreaker="dense").to_numpy(zero_copy_only=False)
        order = np.lexsort((name, -score, query))
        query, score = query[order], score[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        kept = nth < self.k
        self.query, self.score, self.chunk = query[kept], score[kept], chunk.take(pa.array(order[kept]))
        last = nth == self.k - 1
        self.floor[query[last]] = score[last]

    def rows(self, ids: pa.Array) -> pa.RecordBatch:
        found = ids.take(pa.array(self.query))
        return pa.RecordBatch.from_arrays([found, self.chunk, pa.array(self.score)], ["id_consulta", "chunk_id", "score"])


def _ranges(starts: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each span, one after another."""
    ends = np.cumsum(spans)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - spans, spans) + np.repeat(starts, spans)


def contexts(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """One context per query: '[document] text' of its hits in rank order.

    The hits are at most k per query; adaptive execution broadcasts them if they are small.
    """
    tagged = F.concat(F.lit("["), F.col("doc_nome"), F.lit("] "), F.col("texto"))
    return (
        chunks.select("chunk_id", tagged.alias("trecho"))
        .join(found, "chunk_id")
        .groupBy("id_consulta")
        .agg(F.array_sort(F.collect_list(F.struct("posicao", "trecho"))).alias("_t"))
        .select("id_consulta", F.array_join("_t.trecho", "\n\n").alias("contexto"))
    )
