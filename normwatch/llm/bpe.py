"""Byte-level BPE by ranks: encoding and decoding of whole texts.

A pre-token is first looked up in the vocabulary as a whole, through a minimal perfect hash: one
slot per vocabulary entry, found by two hashes and a displacement, and verified by its bytes.  What
is not in the vocabulary is merged from its bytes: neighbouring symbols are linked, and a heap
yields the pair of lowest rank, leftmost first.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import in_arrow, table
from normwatch.llm.pretokens import PieceTable, text_slices

_U = np.uint64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], _U)


def _slots(hashes: np.ndarray, shift: np.ndarray, size: int) -> np.ndarray:
    h = hashes ^ (shift.astype(_U) * _U(0x9E3779B97F4A7C15))
    h ^= h >> _U(31)
    h *= _U(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> _U(29))) % _U(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct tokens: ``place`` gives each its own slot.

    Tokens fall into buckets of about three.  From the largest bucket on, each gets the first
    displacement that sends its tokens to free slots; buckets of one token note their slot.
    """

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.buckets = max(1, self.size // 3)
        self.shift = np.zeros(self.buckets, np.int64)
        hashes = _hashes(tokens)
        bucket = (hashes % _U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        begins = np.cumsum(counts) - counts
        free = np.ones(self.size, bool)
        for b in np.argsort(-counts, kind="stable"):
            own = hashes[order[begins[b] : begins[b] + counts[b]]]
            if len(own) < 2:
                break
            at = 0
            while True:
                tries = np.arange(at, at + 256)
                slots = _slots(own[None, :], tries[:, None], self.size)
                good = free[slots].all(axis=1)
                ordered = np.sort(slots, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    row = int(good.argmax())
                    self.shift[b] = at + row
                    free[slots[row]] = False
                    break
                at += 256
        left = np.flatnonzero(free)
        single = np.flatnonzero(counts == 1)
        self.shift[single] = -1 - left
        self.token_at = np.zeros(self.size, np.int64)
        if self.size:
            self.token_at[self.place(tokens)] = np.arange(self.size)

    def place(self, tokens: list[bytes]) -> np.ndarray:
        """The slot of each token; of a token that is not in the set, any slot."""
        hashes = _hashes(tokens)
        shift = self.shift[(hashes % _U(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, _slots(hashes, np.maximum(shift, 0), self.size))


class Vocabulary:
    """Tokens with their ranks, which are also their ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = list(ranks)
        self.perfect = PerfectHash(self.tokens)
        self.bytes_of: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def whole(self, tokens: list[bytes]) -> list[int]:
        """The id of each token that is in the vocabulary as a whole, else -1."""
        if not tokens or not self.tokens:
            return [-1] * len(tokens)
        own = self.tokens
        near = self.perfect.token_at[self.perfect.place(tokens)].tolist()
        return [self.ranks[t] if own[n] == t else -1 for t, n in zip(tokens, near)]

    def merged(self, token: bytes) -> list[int]:
        """The ids of a token that has to be merged from its bytes."""
        get, size = self.ranks.get, len(token)
        base = size + 1
        ends = list(range(1, base))
        before = list(range(-1, size))
        heap = []
        for i in range(size - 1):
            rank = get(token[i : i + 2])
            if rank is not None:
                heap.append((rank * base + i) * base + i + 2)
        heapq.heapify(heap)
        while heap:
            entry, end = divmod(heapq.heappop(heap), base)
            i = entry % base
            middle = ends[i]
            # Stale if a symbol is gone, or either side has grown since.
            if middle == 0 or middle >= end or ends[middle] != end:
                continue
            ends[i], ends[middle] = end, 0
            if end < size:
                before[end] = i
                rank = get(token[i : ends[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank * base + i) * base + ends[end])
            left = before[i]
            if left >= 0:
                rank = get(token[left:end])
                if rank is not None:
                    heapq.heappush(heap, (rank * base + left) * base + end)
        ids, i = [], 0
        while i < size:
            ids.append(self.ranks[token[i : ends[i]]])
            i = ends[i]
        return ids

    def encode_tokens(self, tokens: list[bytes]) -> list[list[int]]:
        """Both tiers, for pre-tokens."""
        found = self.whole(tokens)
        return [[i] if i >= 0 else self.merged(t) for t, i in zip(tokens, found)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


# One table for each vocabulary and Python worker, kept from task to task.
_TABLES: dict[tuple, PieceTable] = {}


def _pieces(key: tuple, vocabulary: Vocabulary, pattern: str) -> PieceTable:
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = PieceTable(pattern, vocabulary.encode_tokens)
    return _TABLES[key]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode(
    docs: DataFrame, rank_path: str, pattern: str, decoded: bool = False
) -> DataFrame:
    """doc_id, ids (array of int) and, if asked for, the bytes that the ids decode to.

    The rank file is read by the driver and sent to the executors; its size does not depend on the
    data.  A null text counts as empty; an empty text has no ids.  Repeated rows and null doc_ids
    are encoded like any other.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(read_ranks(rank_path)))
    key = (rank_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        pieces = _pieces(key, vocabulary, pattern)
        for batch in batches:
            for part in text_slices(batch, 1):
                numbers = [pieces.numbers(t) for t in part.column(1).to_pylist()]
                ids = list(pieces.values(numbers))
                columns, names = [part.column(0), _lists(ids)], ["doc_id", "ids"]
                if decoded:
                    back = [vocabulary.decode(i.tolist()) for i in ids]
                    columns, names = [*columns, pa.array(back, pa.binary())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                pieces.tidy()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return in_arrow(rows, run, schema)


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``, to doc_id and ids.  Null ids decode to nothing."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(rank_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = [shared.value.decode(i or []) for i in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(back, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    return in_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded binary")


def encoded_digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of what they decode to."""
    both = encode(docs, rank_path, pattern, decoded=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``, encoded and decoded again."""
    import public_tokenizers

    return encoded_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
