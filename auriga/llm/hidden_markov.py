"""A hidden Markov language model: Baum-Welch counts from all partitions, exact scaled forward scores."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.llm.common import ascii_lower, crc_fold, keep, map_frames, sliced, split_words, text_of

FOLDS, HELD_OUT = 7, 2
STATES = 6
ROUNDS = 4
# Words with a symbol of their own; all others share symbols by their first and last letters.
# Rare words must be among the latter, since they stand for words that training has not seen.
OWN_WORDS, LONGEST_OWN, LEAST_OWN = 65_536, 64, 4
SHARED = 8_192
# Baum-Welch runs side by side on stretches of so many tokens, so many at a time; messages pass between them.
# Probabilities are rescaled once in so many steps.
STRETCH, AT_ONCE, RESCALE = 64, 2_048, 4
# Weight of the corpus distribution in a state's emissions, as a share of the state's even part of the tokens.
PRIOR = 0.1
NOISE = 0.5
LOG10 = math.log(10)


@dataclass
class Vocabulary:
    """Symbols: own words 0..n-1, then SHARED symbols, then the end. Sizes are bounded by the parameters."""

    words: dict[str, int]
    counts: np.ndarray
    shared_tokens: np.ndarray
    shared_words: np.ndarray
    texts: int
    tokens: int
    distinct: int

    @property
    def end(self) -> int:
        return len(self.words) + SHARED

    def corpus(self) -> np.ndarray:
        """Probability of each symbol. A shared symbol keeps one count for each of its words and one for unseen ones."""
        mass = np.concatenate([self.counts + 1.0, self.shared_tokens + self.shared_words + 1.0, [self.texts + 1.0]])
        return mass / mass.sum()


@dataclass
class Model:
    start: np.ndarray
    moves: np.ndarray
    emit: np.ndarray


def scores(
    documents: DataFrame,
    states: int = STATES,
    rounds: int = ROUNDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts whose crc32 fold is HELD_OUT are scored only; all others train. Tokens are words, A-Z lower-cased,
    and one end. base_score is the add-one unigram; score is the log10 probability under the model.

    The hidden states emit symbols: one for each of the commonest words, one for each of SHARED classes of
    the rest, by first and last letters, and the end. A word has, within its class, the add-one share of its
    count, one share being left for unseen words. So the states' tables have a fixed size while every word
    of the corpus is counted, and the model is a distribution over words.

    A null text is empty: one token, the end. Repeated rows repeat, in training too. Other columns are
    ignored. Without training texts every count is 0. An empty table gives no rows.

    Common words are looked up in a bounded table that goes to all tasks; the others, of which a corpus has
    no bound, are joined with their counts by a shuffle.
    """
    rows = documents.select(F.col(id_column).cast("bigint").alias("doc_id"), text_of(text_column).alias("text"))
    rows = rows.withColumn("held_out", crc_fold("doc_id", FOLDS) == HELD_OUT)
    counts = keep(word_counts(rows.filter(~F.col("held_out"))), "lm-counts")
    vocabulary = learn_vocabulary(rows.filter(~F.col("held_out")), counts)
    coded = keep(encode(rows.withColumn("row", F.monotonically_increasing_id()), vocabulary), "lm-coded")
    model = train(coded.filter(~F.col("held_out")), vocabulary, states, rounds)
    likely = forward_scores(coded, model)
    rare = (
        coded.select("row", F.explode("rare").alias("pair"))
        .select("row", "pair.word", "pair.times")
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + 1.0)).alias("rare_score"),
            F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    joined = coded.drop("symbols", "rare").join(likely, "row").join(rare, "row", "left")
    rest = F.coalesce("rare_score", F.lit(0.0))
    each = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("own_known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("own_score") + rest - F.col("n_tokens") * each).alias("base_score"),
        (F.col("likely") + rest - F.col("shared_score")).alias("score"),
    )


def word_counts(rows: DataFrame) -> DataFrame:
    words = rows.select(F.explode(split_words(ascii_lower(F.col("text")))).alias("word"))
    return words.groupBy("word").count()


def learn_vocabulary(training: DataFrame, counts: DataFrame) -> Vocabulary:
    """Totals, the commonest words, and tokens and words per shared symbol; at most OWN_WORDS + SHARED rows."""
    common = counts.filter((F.length("word") <= LONGEST_OWN) & (F.col("count") >= LEAST_OWN))
    own = keep(common.orderBy(F.desc("count"), F.xxhash64("word"), "word").limit(OWN_WORDS), "lm-own")
    listed = own.collect()
    letters = F.concat(F.substring("word", 1, 2), F.substring("word", -2, 2))
    shared = (
        counts.join(F.broadcast(own.select("word")), "word", "left_anti")
        .groupBy(F.pmod(F.xxhash64(letters), F.lit(SHARED)).cast("int").alias("symbol"))
        .agg(F.sum("count").alias("tokens"), F.count("*").alias("words"))
        .collect()
    )
    tokens, words = np.zeros(SHARED), np.zeros(SHARED)
    for row in shared:
        tokens[row["symbol"]], words[row["symbol"]] = row["tokens"], row["words"]
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    texts = training.count()
    return Vocabulary(
        {row["word"]: n for n, row in enumerate(listed)}, np.array([row["count"] for row in listed], dtype=float),
        tokens, words, texts, total + texts, distinct + (texts > 0),
    )


def shared_symbol(word: str) -> int:
    value = xxhash.xxh64_intdigest(word[:2] + word[-2:], 42)
    return (value - (1 << 64) if value >> 63 else value) % SHARED


def encode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Symbols of every text, the parts of its scores that common words settle, and its other words."""
    # Plain values travel, so that executors need no module of this package.
    shipped = rows.sparkSession.sparkContext.broadcast(vars(vocabulary))
    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, own_known bigint, own_score double, "
        "shared_score double, symbols binary, rare array<struct<word:string,times:int>>"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = Vocabulary(**shipped.value)
        first = len(v.words)
        own_log = np.log10(v.counts + 1)
        shared_log = np.log10(v.shared_tokens + v.shared_words + 1)
        end_log = math.log10(v.texts + 1)
        find = v.words.get
        for batch in sliced(batches):
            out = []
            for text in batch["text"]:
                words = split(text)
                symbols = np.fromiter((find(w, -1) for w in words), dtype=np.int32, count=len(words))
                gaps = np.flatnonzero(symbols < 0)
                rare = Counter(words[i] for i in gaps)
                code = {w: shared_symbol(w) for w in rare}
                shared = np.fromiter((code[words[i]] for i in gaps), dtype=np.int32, count=len(gaps))
                own = symbols[symbols >= 0]
                symbols[gaps] = shared + first
                out.append((
                    len(words) + 1, len(own) + (v.texts > 0), float(own_log[own].sum()) + end_log,
                    float(shared_log[shared].sum()), np.append(symbols, first + SHARED).astype("<i4").tobytes(),
                    [{"word": w, "times": n} for w, n in rare.items()],
                ))
            names = ["n_tokens", "own_known", "own_score", "shared_score", "symbols", "rare"]
            found = pd.DataFrame(out, columns=names, index=batch.index)
            yield pd.concat([batch[["row", "doc_id", "held_out"]], found], axis=1)

    return map_frames(rows, run, schema)


def split(text: str) -> list[str]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return [w.decode() for w in text.encode().lower().split()]


def initial_model(corpus: np.ndarray, states: int) -> Model:
    """Sticky states whose emissions are the corpus distribution, each shaken by its own noise."""
    noise = np.random.default_rng(5).normal(0.0, NOISE, (len(corpus), states))
    emit = corpus[:, None] * np.exp(noise)
    moves = np.full((states, states), 0.05 / max(states - 1, 1))
    np.fill_diagonal(moves, 0.95 if states > 1 else 1.0)
    even = np.full(states, 1 / states)
    return Model(even, moves, emit / emit.sum(axis=0))


def train(coded: DataFrame, vocabulary: Vocabulary, states: int, rounds: int) -> Model:
    """Baum-Welch: each round adds expected counts over every training text, folded per task, then by symbol."""
    corpus = vocabulary.corpus()
    model = initial_model(corpus, states)
    columns = [f"s{k}" for k in range(states)]
    schema = ", ".join(["kind int", "symbol int"] + [f"{c} double" for c in columns])
    for _ in range(rounds if vocabulary.texts else 0):
        shipped = coded.sparkSession.sparkContext.broadcast(vars(model))

        def run(batches: Iterator[pd.DataFrame], shipped=shipped) -> Iterator[pd.DataFrame]:
            found = Expected(Model(**shipped.value))
            for batch in sliced(batches, 2048):
                found.add([np.frombuffer(s, dtype="<i4") for s in batch["symbols"]])
            yield found.table(columns)

        counts = coded.select("symbols").mapInPandas(run, schema)
        table = counts.groupBy("kind", "symbol").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
        model = updated(table, columns, corpus)
        shipped.unpersist()
    return model


class Expected:
    """Expected counts of starts, moves and emissions under a model, over whole texts.

    A text is cut into stretches that run side by side. What a stretch does to any message is a matrix of states
    by states; products of these give each stretch the message of all tokens before it and of all after it, so
    the counts, those of moves over borders included, are those of one pass over the whole text.
    """

    def __init__(self, model: Model):
        self.model = model
        size, states = model.emit.shape
        # Relative to the likeliest state, so that several steps fit between two rescalings.
        # One symbol more pads the stretches; it says nothing about the state.
        peak = model.emit.max(axis=1, keepdims=True)
        self.emit = np.vstack([model.emit / peak, np.ones(states)]).astype(np.float32)
        self.log_peak = np.log(peak[:, 0])
        self.steps = model.moves.astype(np.float32)
        self.emitted = np.zeros((size, states))
        self.moves = np.zeros((states, states))
        self.start = np.zeros(states)
        self.likely = 0.0

    def add(self, texts: list[np.ndarray]) -> None:
        if not texts:
            return
        pad, states = len(self.emit) - 1, len(self.start)
        sizes = np.array([-(-len(text) // STRETCH) for text in texts])
        first = np.cumsum(sizes) - sizes
        every = np.full((sizes.sum(), STRETCH), pad, dtype=np.int32)
        for text, at in zip(texts, first, strict=True):
            every.reshape(-1)[at * STRETCH : at * STRETCH + len(text)] = text
        head = np.zeros(len(every), dtype=bool)
        head[first] = True
        before = np.repeat(self.model.start[None].astype(np.float32), len(every), axis=0)
        after = np.ones((len(every), states), np.float32)
        # Stretches of like length go together, so that short ones end early.
        order = np.argsort(-(every != pad).sum(axis=1), kind="stable")
        if len(every) > len(texts):
            self._pass_messages(every, head, first, sizes, order, before, after)
        for at in range(0, len(order), AT_ONCE):
            chosen = order[at : at + AT_ONCE]
            self._add(self._columns(every[chosen]), head[chosen], before[chosen], after[chosen])

    def _columns(self, stretches: np.ndarray) -> np.ndarray:
        """Symbols by step, as many steps as the longest stretch has."""
        return stretches[:, : int((stretches < len(self.emit) - 1).sum(axis=1).max())].T

    def _pass_messages(self, every, head, first, sizes, order, before, after) -> None:
        """Fill `before` and `after` of the texts of several stretches, up to a factor per stretch."""
        states = len(self.start)
        effect = np.empty((len(every), states, states), np.float32)
        cut = np.repeat(sizes > 1, sizes)
        order = order[cut[order]]
        for at in range(0, len(order), AT_ONCE):
            chosen = order[at : at + AT_ONCE]
            # The start has no move before it.
            matrix = np.where(head[chosen, None, None], np.eye(states, dtype=np.float32), self.steps)
            for t, symbols in enumerate(self._columns(every[chosen])):
                if t:
                    matrix = (matrix.reshape(-1, states) @ self.steps).reshape(matrix.shape)
                matrix *= self.emit[symbols][:, None]
                if t % RESCALE == RESCALE - 1:
                    matrix /= matrix.max(axis=(1, 2), keepdims=True)
            effect[chosen] = matrix
        last = first + sizes - 1
        for step in range(1, int(sizes.max())):
            longer = sizes > step
            at = first[longer] + step
            message = np.einsum("ni,nij->nj", before[at - 1], effect[at - 1])
            before[at] = message / message.sum(axis=1, keepdims=True)
            at = last[longer] - step
            message = np.einsum("nij,nj->ni", effect[at + 1], after[at + 1])
            after[at] = message / message.sum(axis=1, keepdims=True)

    def _add(self, symbols: np.ndarray, head: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        (steps, rows), states, pad = symbols.shape, len(self.start), len(self.emit) - 1
        # Rescaled every few steps, single precision is enough for counts; their sums are double.
        forward, scale = np.empty((steps, rows, states), np.float32), {}
        alpha = np.where(head[:, None], before, before @ self.steps)
        for t in range(steps):
            alpha = (alpha if t == 0 else alpha @ self.steps) * self.emit[symbols[t]]
            if t % RESCALE == 0:
                scale[t] = alpha.sum(axis=1, keepdims=True)
                alpha /= scale[t]
                self.likely += float(np.log(scale[t]).sum(dtype=float))
            forward[t] = alpha
        # A text's stretches add up to its likelihood, since `before` sums to 1.
        self.likely += float(np.log(alpha.sum(axis=1)).sum(dtype=float))
        beta = after / (alpha * after).sum(axis=1, keepdims=True)
        for t in range(steps - 1, -1, -1):
            seen = self.emit[symbols[t]] * beta
            if t in scale:
                seen /= scale[t]
            earlier = forward[t - 1] * (symbols[t] != pad)[:, None] if t else before * ~head[:, None]
            self.moves += earlier.T @ seen
            forward[t] *= beta
            beta = seen @ self.steps.T
        self.start += forward[0][head].sum(axis=0)
        flat, size = symbols.ravel(), len(self.emitted)
        self.likely += float(self.log_peak @ np.bincount(flat, minlength=size + 1)[:size])
        for k in range(states):
            self.emitted[:, k] += np.bincount(flat, weights=forward[:, :, k].ravel(), minlength=size + 1)[:size]

    def table(self, columns: list[str]) -> pd.DataFrame:
        used = np.flatnonzero(self.emitted.any(axis=1))
        states = len(self.start)
        values = np.vstack([self.emitted[used], self.moves * self.model.moves, self.start[None]])
        out = pd.DataFrame(values, columns=columns)
        out.insert(0, "symbol", np.concatenate([used, np.arange(states), [0]]).astype(np.int32))
        out.insert(0, "kind", np.repeat([0, 1, 2], [len(used), states, 1]).astype(np.int32))
        return out


def updated(table: pd.DataFrame, columns: list[str], corpus: np.ndarray) -> Model:
    """The next model from summed counts; the corpus distribution keeps every emission above 0."""
    states = len(columns)
    tokens = table[table["kind"] == 0][columns].to_numpy().sum()
    emit = max(PRIOR * tokens / states, 1.0) * np.repeat(corpus[:, None], states, axis=1)
    moves, start = np.ones((states, states)), np.ones(states)
    for kind, target in ((0, emit), (1, moves)):
        part = table[table["kind"] == kind]
        target[part["symbol"].to_numpy()] += part[columns].to_numpy()
    start += table[table["kind"] == 2][columns].to_numpy().sum(axis=0)
    return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def log_likelihoods(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """Exact log10 probabilities of symbol sequences by the scaled forward recursion, side by side."""
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([texts[i] for i in order])
    ends = np.cumsum(lengths[order])
    begin = ends - lengths[order]
    active = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right")
    total, alpha = np.zeros(len(texts)), np.repeat(model.start[None], len(texts), axis=0)
    for t, n in enumerate(active):
        alpha = (alpha if t == 0 else alpha[:n] @ model.moves) * model.emit[flat[begin[:n] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:n] += np.log(scale)
    out = np.empty(len(texts))
    out[order] = total / LOG10
    return out


def forward_scores(coded: DataFrame, model: Model) -> DataFrame:
    """row, likely: log10 probability of each text's symbols."""
    shipped = coded.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(**shipped.value)
        for batch in sliced(batches, 4096):
            if len(batch):
                texts = [np.frombuffer(s, dtype="<i4") for s in batch["symbols"]]
                yield pd.DataFrame({"row": batch["row"], "likely": log_likelihoods(texts, model)})

    return coded.select("row", "symbols").mapInPandas(run, "row bigint, likely double")
