"""Token counts of whole texts under a byte-level BPE with a merge list.

Rank-synchronous merging: many pre-tokens lie in one flat array of symbols with the begin of each.
In every round each sequence merges all places of its own lowest-ranked pair at once; sequences
without a pair left are done, and their symbols are counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import in_arrow, table
from normwatch.llm.pretokens import PieceTable, text_slices

# Symbols merged together; bounds memory, not results.
BLOCK_SYMBOLS = 1 << 20
LIMIT = 1024
_NONE = np.iinfo(np.int32).max


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in such files: printable bytes stand for themselves,
    the others are numbered from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    others = [b for b in range(256) if b not in letters]
    return letters | {b: chr(0x100 + n) for n, b in enumerate(others)}


@dataclass
class MergeTable:
    """Pairs of symbol ids by their key (left id, right id) with rank and merged id."""

    of_byte: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray  # by rank
    special: list[str]

    @classmethod
    def read(cls, path: str) -> MergeTable:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, ids = content["model"], content["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        letters = _byte_letters()
        of_byte = np.array([ids[letters[b]] for b in range(256)], np.int32)
        special = [t["content"] for t in content.get("added_tokens") or []]
        return cls(of_byte, keys[order], order.astype(np.int32), merged, special)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """How many symbols are left of each pre-token."""
        result = np.zeros(len(tokens), np.int64)
        sizes = np.array([len(t) for t in tokens], np.int64)
        upto = np.cumsum(sizes)
        begin = 0
        while begin < len(tokens):
            base = int(upto[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, base + BLOCK_SYMBOLS)))
            result[begin:end] = self._merge(tokens[begin:end], sizes[begin:end])
            begin = end
        return result

    def _merge(self, tokens: list[bytes], sizes: np.ndarray) -> np.ndarray:
        done = np.zeros(len(tokens), np.int64)
        if not len(self.keys):
            return sizes
        row = np.flatnonzero(sizes)
        size = sizes[row]
        symbol = self.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        start = np.cumsum(size) - size
        rank = np.full(len(symbol), _NONE, np.int32)
        rank[:-1] = self.pair_ranks(symbol[:-1], symbol[1:])
        rank[start + size - 1] = _NONE
        while len(row):
            lowest = np.minimum.reduceat(rank, start)
            ready = lowest < _NONE
            if not ready.all():
                done[row[~ready]] = size[~ready]
                keep = np.repeat(ready, size)
                symbol, rank = symbol[keep], rank[keep]
                row, size, lowest = row[ready], size[ready], lowest[ready]
                start = np.cumsum(size) - size
                if not len(row):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # Of places that overlap (a a a), every other one merges, from the left.
            fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
            number = np.arange(len(at))
            run = np.maximum.accumulate(np.where(fresh, number, 0))
            at = at[(number - run) % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            # The merged symbol ends its sequence where the second one did.
            last = np.zeros(len(symbol), bool)
            last[start + size - 1] = True
            last[at] |= last[at + 1]
            moved = np.cumsum(keep) - 1
            gone = np.add.reduceat((~keep).astype(np.int64), start)
            symbol, rank, last = symbol[keep], rank[keep], last[keep]
            size = size - gone
            start = np.cumsum(size) - size
            changed = moved[at]
            before = changed[changed > 0] - 1
            changed = np.unique(np.concatenate([changed, before]))
            rank[changed] = _NONE
            changed = changed[~last[changed]]
            rank[changed] = self.pair_ranks(symbol[changed], symbol[changed + 1])
        return done


_TABLES: dict[tuple, PieceTable] = {}


def _pieces(key: tuple, merges: MergeTable, pattern: str) -> PieceTable:
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = PieceTable(pattern, lambda t: merges.counts(t).reshape(-1, 1).tolist())
    return _TABLES[key]


def token_counts(
    docs: DataFrame, merges_path: str, pattern: str, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row of ``docs``.

    Strings of added tokens inside a text count as one token each, wherever they stand.  A null
    text counts as empty and has no tokens.  Repeated rows and null doc_ids are counted like others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(MergeTable.read(merges_path))
    key = (merges_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = shared.value
        pieces = _pieces(key, merges, pattern)
        ordered = sorted(merges.special, key=len, reverse=True)
        special = regex.compile("|".join(map(regex.escape, ordered))) if ordered else None
        for batch in batches:
            for part in text_slices(batch, 1):
                numbers, extra = [], []
                for text in part.column(1).to_pylist():
                    cut = special.split(text) if special else [text]
                    extra.append(len(cut) - 1)
                    numbers.append([n for s in cut for n in pieces.numbers(s)])
                sums = [int(v.sum()) for v in pieces.values(numbers)]
                tokens = np.array(sums, np.int64) + np.array(extra, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(tokens)],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )
                pieces.tidy()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    counted = in_arrow(rows, run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``."""
    import public_tokenizers

    return token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )
