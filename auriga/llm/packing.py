"""Retrieval packing: documents fill token windows together with their BM25 neighbours."""

from __future__ import annotations

import math
import zlib
from base64 import b64decode
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.llm.common import keep, map_frames, sliced, text_of

WINDOW = 1024
END_ID = 0
SHARD = 1024
K1, B = 1.2, 0.75
# Terms of more than this share of a shard's tails are common.
COMMON = 0.25
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
CUTS = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary, signature bigint"


def tokenizer(ranks_path: str, pattern: str, json_path: str) -> Callable[[str], np.ndarray]:
    """Ids as the tokenizers library gives them for json_path, from the rank file of the same vocabulary.

    The rank file's library is several times as fast. It knows no special tokens, so a text that spells one
    goes to the tokenizers library itself.
    """
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    exact = []

    def ids(text: str) -> np.ndarray:
        if "<|" not in text:
            return fast.encode_to_numpy(text, disallowed_special=())
        if not exact:
            from tokenizers import Tokenizer

            exact.append(Tokenizer.from_file(json_path))
        return np.array(exact[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return ids


def cut_documents(
    documents: DataFrame,
    load: Callable[[], Callable[[str], np.ndarray]],
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each document's ids and END_ID, cut into full windows and a tail; only tails carry their ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = load()
        for batch in sliced(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(ids_of(text), END_ID).astype("<u4")
                for at in range(0, len(ids), window):
                    part = ids[at : at + window]
                    tail = len(part) < window
                    # The smallest mixed id of the tail brings tails with common ids close together.
                    mark = int(((part.astype(np.uint64) * 0x9E3779B97F4A7C15) >> np.uint64(20)).min()) if tail else 0
                    rows.append((
                        doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids),
                        part.tobytes() if tail else None, mark,
                    ))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "signature"]
            yield pd.DataFrame(rows, columns=names)

    rows = documents.select(F.col(id_column).cast("bigint").alias("doc_id"), text_of(text_column).alias("text"))
    return map_frames(rows, run, CUTS)


def pack(
    documents: DataFrame,
    load: Callable[[], Callable[[str], np.ndarray]],
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's full windows are sequences of their own; its tail, shorter than a window, is packed with
    other tails. Tails are dealt into ranges of a lexical signature and the id, so equal tails spread over
    ranges when they are many. A range is read in shards of SHARD tails; each shard has a BM25 inverted index
    over token ids. A seed's window is filled greedily with its best unused neighbours; the one that doesn't fit
    is cut, and its rest is the next seed. What a shard leaves goes on to the next, so only the last
    sequence of a range is short.

    A null text is empty: one id, END_ID. Repeated rows are packed each. Other columns are ignored. An
    empty table gives no rows. Memory per task: one batch of documents, then one shard of tails.
    """
    cuts = keep(cut_documents(documents, load, window, id_column, text_column), "pack-cuts")
    tails = cuts.filter("ids IS NOT NULL")
    wanted = math.ceil(tails.count() / SHARD)
    parts = max(1, min(wanted, 4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, left = TaskContext.get().partitionId() << 32, []
        for shard in in_shards(batches, SHARD):
            sequences, left = fill(left + shard, window)
            if sequences:
                yield as_pieces(sequences, number)
                number += len(sequences)
        if left:
            yield as_pieces(fill(left, window, last=True)[0], number)

    ranges = tails.repartitionByRange(parts, "signature", "doc_id").sortWithinPartitions("signature", "doc_id", "start")
    packed = map_frames(ranges, run, PIECES)
    # Odd numbers for windows of one document, even ones for packed windows.
    full = cuts.filter("ids IS NULL").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    return full.unionByName(packed.withColumn("sequence_id", F.col("sequence_id") * 2))


def in_shards(batches: Iterator[pd.DataFrame], size: int) -> Iterator[list[tuple]]:
    """Tails as (doc_id, start, doc_tokens, ids), in lists of at most `size`."""
    shard: list[tuple] = []
    for batch in batches:
        for doc_id, start, total, ids in zip(
            batch["doc_id"], batch["start"], batch["doc_tokens"], batch["ids"], strict=True
        ):
            shard.append((doc_id, start, total, np.frombuffer(ids, dtype="<u4")))
            if len(shard) == size:
                yield shard
                shard = []
    if shard:
        yield shard


class Index:
    """BM25 postings of the tails of one shard; term ids are token ids."""

    def __init__(self, tails: list[tuple]):
        lengths = np.array([len(t[3]) for t in tails])
        every = np.concatenate([t[3] for t in tails]).astype(np.int64)
        keys = every * len(tails) + np.repeat(np.arange(len(tails)), lengths)
        keys, count = np.unique(keys, return_counts=True)
        term, owner = keys // len(tails), keys % len(tails)
        by_owner = np.argsort(owner, kind="stable")
        terms = np.split(term[by_owner], np.cumsum(np.bincount(owner, minlength=len(tails)))[:-1])
        self.vocabulary, self.first, size = np.unique(term, return_index=True, return_counts=True)
        self.end = self.first + size
        idf = np.log1p((len(tails) - size + 0.5) / (size + 0.5))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        self.owner = owner
        self.weight = np.repeat(idf, size) * count * (K1 + 1) / (count + norm[owner])
        self.terms, self.size = terms, len(tails)
        # Terms of many tails are scored for all tails at once, as a product of matrices; a term of one tail tells nothing.
        common = size > COMMON * len(tails)
        self.rare = (size > 1) & ~common
        column = np.cumsum(common) - 1
        at = common[np.searchsorted(self.vocabulary, term)]
        has, weigh = np.zeros((2, len(tails), int(common.sum())))
        cells = self.owner[at], column[np.searchsorted(self.vocabulary, term[at])]
        has[cells], weigh[cells] = 1.0, self.weight[at]
        self.base = has @ weigh.T

    def scores(self, at: int) -> np.ndarray:
        """BM25 of every other tail for all terms of tail `at`; terms of no other tail tell nothing."""
        found = np.searchsorted(self.vocabulary, self.terms[at])
        found = found[self.rare[found]]
        if not len(found):
            return self.base[at]
        spans = self.end[found] - self.first[found]
        ends = np.cumsum(spans)
        place = np.arange(ends[-1]) + np.repeat(self.first[found] - ends + spans, spans)
        return self.base[at] + np.bincount(self.owner[place], weights=self.weight[place], minlength=self.size)


def fill(tails: list[tuple], window: int, last: bool = False) -> tuple[list[list[tuple]], list[tuple]]:
    """Sequences of (doc_id, start, doc_tokens, ids), and the tails left over (none if last).

    All sequences are full but the last one of the last call.
    """
    index = Index(tails)
    free = np.ones(len(tails), dtype=bool)
    rest: list[np.ndarray | None] = [t[3] for t in tails]
    begin = [t[1] for t in tails]
    sequences, current, room, query, ranked = [], [], window, None, iter(())
    following = 0
    open_tail = None
    while True:
        if open_tail is None:
            # The best unused neighbour of the seed; without one, the next unused tail in order.
            open_tail = next((int(n) for n in ranked if free[n]), None) if current else None
            if open_tail is None:
                while following < len(tails) and not free[following]:
                    following += 1
                if following == len(tails):
                    break
                open_tail = following
            free[open_tail] = False
        if query is None:
            query = open_tail
            scores = index.scores(query)
            near = np.flatnonzero((scores > 0) & free)
            ranked = iter(near[np.argsort(-scores[near], kind="stable")])
        ids = rest[open_tail][:room]
        current.append((tails[open_tail][0], begin[open_tail], tails[open_tail][2], ids))
        room -= len(ids)
        rest[open_tail] = rest[open_tail][len(ids) :]
        begin[open_tail] += len(ids)
        if not len(rest[open_tail]):
            open_tail = None
        if not room:
            sequences.append(current)
            current, room, query, ranked = [], window, None, iter(())
    if current and last:
        sequences.append(current)
        current = []
    return sequences, current


def as_pieces(sequences: list[list[tuple]], number: int) -> pd.DataFrame:
    rows = []
    for sequence in sequences:
        offset = 0
        for doc_id, start, total, ids in sequence:
            rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, number, offset))
            offset += len(ids)
        number += 1
    return pd.DataFrame(
        rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    )
