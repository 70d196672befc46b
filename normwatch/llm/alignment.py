"""Alignment of two tokenizers: which tokens of one meet which of the other.

The byte ends of both token sequences are merged.  Merge-path partitioning divides the merge: binary
searches along diagonals cut both sequences into pieces of equal work that are merged on their own;
each emits its overlaps, and where a cut separates equal ends, the pieces are stitched.

Neither tokenizer has a token that runs from a character that is not white space into a space, so a
text may be cut before such spaces.  What lies between, a word mostly, is encoded and merged once
and then known.  Texts are handled in blocks.  A block remembers its own words and pairs, so that
corpus-wide counts come back to it once for each pair of the block, not for each link.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import in_arrow, stored, table
from normwatch.llm.pretokens import text_slices

# UTF-8 bytes of the texts of a block, but for a single longer text.
BLOCK_BYTES = 4 << 20
# What a worker remembers: bounds its memory, not its results.
REMEMBERED_WORDS = 450_000
REMEMBERED_BYTES = 16 << 20
# Words encoded at a time.
ENCODED_WORDS = 1 << 14
# Ends merged in one piece.
PIECE_WORK = 1 << 15
_SPACE = "▁"


def merge_cuts(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of ``work`` merged elements begin in a and in b, and the ends of both.

    Binary searches along all diagonals at once; of equal elements that of a comes first.
    """
    diagonal = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low = np.maximum(diagonal - len(b), 0)
    high = np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = np.minimum(middle, max(len(a) - 1, 0))
        across = np.clip(diagonal - middle - 1, 0, max(len(b) - 1, 0))
        before = open_ & (a[at] <= b[across])
        low = np.where(before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low, diagonal - low


def _merged_piece(a: np.ndarray, b: np.ndarray, a_from: int, b_from: int):
    """end, index in a, index in b and whether both end there, for every distinct end of a piece."""
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")
    ends = both[order]
    of_a = order < len(a)
    taken_a = np.cumsum(of_a) - of_a
    fresh = np.ones(len(ends), bool)
    fresh[1:] = ends[1:] != ends[:-1]
    first = np.flatnonzero(fresh)
    common = np.diff(np.append(first, len(ends))) == 2
    return ends[first], a_from + taken_a[first], b_from + first - taken_a[first], common


def overlaps(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK):
    """The overlaps of two sequences of ranges that cover the same bytes, given by their ends.

    Returns for each overlap, in order: its end, the index of its range in a and in b, and whether
    both ranges end there (which closes a group).
    """
    cut_a, cut_b = merge_cuts(a, b, work)
    pieces = []
    for k in range(len(cut_a) - 1):
        i, j = cut_a[k], cut_b[k]
        piece = _merged_piece(a[i : cut_a[k + 1]], b[j : cut_b[k + 1]], i, j)
        if pieces and len(piece[0]) and piece[0][0] == pieces[-1][0][-1]:
            # The end of a was the last of one piece, the equal end of b is the first of the next.
            pieces[-1][3][-1] = True
            piece = tuple(column[1:] for column in piece)
        if len(piece[0]):
            pieces.append(piece)
    if not pieces:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, bool)
    return tuple(np.concatenate(columns) for columns in zip(*pieces))


def _byte_of_letter() -> dict[str, int]:
    """The byte for which each letter of a byte-level vocabulary stands: printable bytes stand for
    themselves, the others are numbered from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + n): b for n, b in enumerate(others)}


class TokenizerPair:
    """A byte-level BPE (A, by the tokenizers library) and a piece BPE (B, by sentencepiece)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_of_letter()
        with open(a_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError("a piece runs across a space: texts cannot be cut into words")
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # Decimal ids with what follows them in the text of groups.
        self.a_text = _followed(len(self.a_bytes), ",|")
        self.b_text = _followed(len(self.b_bytes), ",;\n")

    def ids(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of space+word in A, and of word, to which B adds the space itself."""
        spaced = [f" {w}" for w in words]
        return (
            [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)],
            self.b.encode(words, num_threads=1),
        )


def _followed(size: int, signs: str) -> np.ndarray:
    """For each sign the decimal numbers below ``size`` with the sign after them."""
    return np.array([[f"{i}{sign}" for i in range(size)] for sign in signs], object)


class _Flat:
    """Ragged numbers in one growing array."""

    def __init__(self, kind: type):
        self.data, self.ends = np.zeros(1 << 16, kind), np.zeros(1, np.int64)

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.ends[-1])
        if used + len(values) > len(self.data):
            grown = np.zeros(2 * (used + len(values)), self.data.dtype)
            grown[:used] = self.data[:used]
            self.data = grown
        self.data[used : used + len(values)] = values
        self.ends = np.append(self.ends, used + np.cumsum(sizes))

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined values of the rows ``at``, and the size of each."""
        begin = self.ends[at]
        size = self.ends[at + 1] - begin
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        return self.data[np.repeat(begin - upto + size, size) + np.arange(total)], size


class _Numbers(dict):
    """Numbers of words; a new word gets the next number and waits to be encoded."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.waiting.append(word)
        return number


class WordTable:
    """Words that were met, with their ids, links and groups.  A word follows a space that is not
    part of it; white space may lie within."""

    # A space is a cut if it follows something else than white space and ends no text.
    _cut = regex.compile(r"(?<=\S) (?!\Z)").split
    _ragged = regex.compile(r"\s |\s\Z").search

    def __init__(self, tokenizers: TokenizerPair):
        self.pair = tokenizers
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.held = 0
        self.spelled: list[bytes] = []  # groups as text
        self.links = _Flat(np.int64)  # A id << 32 | B id, by place
        self.counts = np.zeros((0, 3), np.int64)  # tokens of A, of B, groups
        self.right = np.zeros(0, bool)  # both sequences spell the word

    def words(self, text: str) -> list[int]:
        """The numbers of the words of space+text."""
        spaced = " " + text
        if self._ragged(spaced):
            parts = self._cut(spaced)
            parts[0] = parts[0][1:]
        else:
            parts = text.split(" ")
        known = self.numbers
        return [known[p] for p in parts]

    def settle(self) -> None:
        """Encode and align the words that wait."""
        waiting, self.numbers.waiting = self.numbers.waiting, []
        self.held += sum(map(len, waiting))
        counts, right = [self.counts], [self.right]
        for begin in range(0, len(waiting), ENCODED_WORDS):
            found = self._settled(waiting[begin : begin + ENCODED_WORDS])
            counts.append(found[0])
            right.append(found[1])
        self.counts, self.right = np.concatenate(counts), np.concatenate(right)

    def _settled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = self.pair
        a_ids, b_ids = own.ids(words)
        spelled = [b" " + w.encode() for w in words]
        a_bytes, b_bytes = own.a_bytes.__getitem__, own.b_bytes.__getitem__
        right = np.array(
            [
                b"".join(map(a_bytes, a)) == s == b"".join(map(b_bytes, b))
                for a, b, s in zip(a_ids, b_ids, spelled)
            ]
        )
        for k in np.flatnonzero(~right):
            a_ids[k], b_ids[k], spelled[k] = [], [], b""
        n_a = np.array([len(t) for t in a_ids], np.int64)
        n_b = np.array([len(t) for t in b_ids], np.int64)
        a = np.array(list(chain.from_iterable(a_ids)), np.int64)
        b = np.array(list(chain.from_iterable(b_ids)), np.int64)
        ends, at_a, at_b, closes = overlaps(np.cumsum(own.a_sizes[a]), np.cumsum(own.b_sizes[b]))
        upto = np.searchsorted(ends, np.cumsum([len(s) for s in spelled]), "right")
        closed = np.concatenate([[0], np.cumsum(closes)])
        n_groups = np.diff(closed[upto], prepend=0)
        self.links.extend((a[at_a] << 32) | b[at_b], np.diff(upto, prepend=0))
        closing = np.flatnonzero(closes)
        self.spelled += self._groups(a, b, at_a[closing], at_b[closing], n_groups)
        return np.stack([n_a, n_b, n_groups], 1), right

    def _groups(self, a, b, last_a, last_b, n_groups) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each word, from the last tokens of every group.

        Each token is written with the sign that follows it; a sort by group and side brings the
        tokens of both in order.
        """
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[last_a] = 1
        sign_b[last_b] = 1
        sign_b[last_b[np.cumsum(n_groups)[n_groups > 0] - 1]] = 2
        group_a = np.cumsum(sign_a == 1) - (sign_a == 1)
        group_b = np.cumsum(sign_b > 0) - (sign_b > 0)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        written = np.concatenate([self.pair.a_text[sign_a, a], self.pair.b_text[sign_b, b]])
        lines = iter("".join(written[order].tolist()).encode().split(b"\n"))
        return [next(lines) if n else b"" for n in n_groups.tolist()]

    def text_words(self, texts: list[str]) -> list[np.ndarray]:
        """Word numbers of each text, settled; none for a text that the tokenizers do not spell."""
        found = [self.words(t) if t else [] for t in texts]
        self.settle()
        arrays = [np.array(n, np.int64) for n in found]
        odd = [k for k, n in enumerate(arrays) if not self.right[n].all()]
        # What is wrong in a word may be right in the whole text, or not: ask for that.
        whole = [self.numbers[texts[k]] for k in odd]
        self.settle()
        for k, n in zip(odd, whole):
            arrays[k] = np.array([n] if self.right[n] else [], np.int64)
        return arrays

    def tidy(self) -> None:
        """Forget all words when there are too many.  Call between blocks."""
        if len(self.numbers) > REMEMBERED_WORDS or self.held > REMEMBERED_BYTES:
            self.clear()


_WORDS: dict[tuple[str, str], WordTable] = {}


def _word_table(a_path: str, b_path: str) -> WordTable:
    key = (a_path, b_path)
    if key not in _WORDS:
        _WORDS.clear()
        _WORDS[key] = WordTable(TokenizerPair(*key))
    return _WORDS[key]


BLOCK_SCHEMA = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "words array<int>, times array<int>, "
    "pairs array<long>, holders array<int>, word_ends array<int>, word_pairs array<int>"
)


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted.  (For many values a sort is faster than hashing them.)"""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _block(words: WordTable, block: int, ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
    """One row for each document, and one (the last) for what they share.

    Documents list their distinct words, numbered within the block, and how often each occurs.  The
    last row has the pairs of ids that are linked in the block, the number of documents that hold
    each, and for each word the pairs (by number) of its links.
    """
    found = words.text_words(texts)
    sizes = np.array([len(n) for n in found], np.int64)
    joined = np.concatenate([*found, np.zeros(0, np.int64)])
    used, local = np.unique(joined, return_inverse=True)
    doc = np.repeat(np.arange(len(found)), sizes)
    totals = np.zeros((len(found), 4), np.int64)
    links, n_links = words.links.gather(used)
    each = np.concatenate([words.counts[used], n_links[:, None]], 1)[local]
    filled = np.flatnonzero(sizes)
    if len(filled):
        starts = (np.cumsum(sizes) - sizes)[filled]
        totals[filled] = np.add.reduceat(each, starts, axis=0)
    spelled = words.spelled
    digests = [
        hashlib.sha256(b";".join([spelled[k] for k in n.tolist()])).hexdigest() if len(n) else ""
        for n in found
    ]
    held, times = np.unique(doc * max(len(used), 1) + local, return_counts=True)
    held_doc, held_word = np.divmod(held, max(len(used), 1))

    pairs, link_pair = np.unique(links, return_inverse=True)
    word_of_link = np.repeat(np.arange(len(used)), n_links)
    once = _distinct(word_of_link * max(len(pairs), 1) + link_pair)
    once_word, once_pair = np.divmod(once, max(len(pairs), 1))
    once_sizes = np.bincount(once_word, minlength=len(used))
    once_flat = _Flat(np.int64)
    once_flat.extend(once_pair, once_sizes)
    holders = np.zeros(len(pairs), np.int64)
    # Documents in slices, so that what is held at once stays within a few times the block.
    for part in np.array_split(np.arange(len(held)), max(1, len(held) >> 18)):
        if len(part):
            # A document that is cut by a slice is counted in the slice where it begins.
            first = np.searchsorted(held_doc, held_doc[part[0]], "left")
            first = part[0] if first == part[0] else np.searchsorted(held_doc, held_doc[part[0]], "right")
            last = np.searchsorted(held_doc, held_doc[part[-1]], "right")
            own = slice(int(first), int(last))
            holding, n = once_flat.gather(held_word[own])
            keys = _distinct(np.repeat(held_doc[own], n) * len(pairs) + holding)
            holders += np.bincount(keys % len(pairs), minlength=len(pairs))

    n, none = len(found), pa.nulls(1)
    held_sizes = np.bincount(held_doc, minlength=n)

    def with_last(column: pa.Array, last: pa.Array | None = None) -> pa.Array:
        return pa.concat_arrays([column, none.cast(column.type) if last is None else last])

    def only_last(flat: np.ndarray, kind: pa.DataType) -> pa.Array:
        last = _lists(flat.astype(kind.to_pandas_dtype()), np.array([len(flat)]))
        return pa.concat_arrays([pa.nulls(n, last.type), last])

    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    names += ["words", "times", "pairs", "holders", "word_ends", "word_pairs"]
    columns = [
        pa.array(np.full(n + 1, block, np.int64)),
        with_last(pa.array(ids, pa.int64())),
        *[with_last(pa.array(np.ascontiguousarray(totals[:, k]))) for k in range(4)],
        with_last(pa.array(digests, pa.string())),
        with_last(_lists(held_word.astype(np.int32), held_sizes)),
        with_last(_lists(times.astype(np.int32), held_sizes)),
        only_last(pairs, pa.int64()),
        only_last(holders, pa.int32()),
        only_last(np.cumsum(n_links), pa.int32()),
        only_last(link_pair, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``BLOCK_SCHEMA`` rows of all ``docs``, written: see ``_block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_table(a_path, b_path)
        task, number = TaskContext.get().partitionId() << 33, 0
        ids: list[int | None] = []
        texts: list[str] = []
        held = 0
        for batch in batches:
            for part in text_slices(batch, 1, BLOCK_BYTES // 4):
                ids += part.column(0).to_pylist()
                texts += part.column(1).to_pylist()
                held += part.column(1).nbytes
                if held >= BLOCK_BYTES:
                    yield _block(words, task + number, ids, texts)
                    ids, texts, held, number = [], [], 0, number + 1
                    words.tidy()
        if ids:
            yield _block(words, task + number, ids, texts)
            words.tidy()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    return stored(in_arrow(rows, run, BLOCK_SCHEMA), "blocks")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """block, at, pair and holders: the pairs of every block by their number."""
    zipped = F.posexplode(F.arrays_zip("pairs", "holders")).alias("at", "of")
    shared = blocks.where("pairs is not null").select("block", zipped)
    return shared.select("block", "at", "of.pairs", "of.holders").withColumnRenamed("pairs", "pair")


def link_counts(blocks: DataFrame) -> DataFrame:
    """a, b, n and top for every pair of ids linked anywhere: n documents hold it, and top tells
    whether no pair of the same a is held by more."""
    counts = block_pairs(blocks).groupBy("pair").agg(F.sum("holders").alias("n"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    counts = stored(counts, "pair_counts")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(best, "a").select(
        F.col("a").cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"),
        "n",
        (F.col("n") == F.col("most")).alias("top"),
    )


DOCUMENT_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def _summed(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with the sums of the counts of their links."""
    shared = rows.filter(pa.compute.is_valid(rows["pairs"]))
    rows = rows.filter(pa.compute.is_null(rows["pairs"])).combine_chunks()
    size = len(shared["pairs"][0])
    n, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = counts["at"].to_numpy()
    n[at], top[at] = counts["n"].to_numpy(), counts["top"].to_numpy()
    word_pairs = shared["word_pairs"][0].values.to_numpy()
    ends = np.concatenate([[0], shared["word_ends"][0].values.to_numpy()])
    sums = []
    for of_pair in (top, n):
        upto = np.concatenate([[0], np.cumsum(of_pair[word_pairs])])
        of_word = upto[ends[1:]] - upto[ends[:-1]]
        words = rows["words"].combine_chunks()
        held = of_word[words.flatten().to_numpy()] * rows["times"].combine_chunks().flatten().to_numpy()
        upto = np.concatenate([[0], np.cumsum(held)])
        sizes = pa.compute.list_value_length(words).to_numpy(zero_copy_only=False)
        to = np.cumsum(sizes).astype(np.int64)
        sums.append(pa.array(upto[to] - upto[to - sizes.astype(np.int64)]))
    return pa.table(
        [rows["doc_id"], rows["n_a"], rows["n_b"], rows["n_groups"], rows["n_links"], *sums, rows["groups_sha256"]],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    )


def document_alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row.

    A encodes space+text and B the text, to which it adds the space; strings of special tokens are
    ordinary text.  Groups end where a token of A and one of B end; links are the pairs of tokens
    that share bytes.  The count of a pair of ids is the number of rows of ``docs`` that hold it
    linked; n_best counts the links whose count is the highest of their A id, and count_sum adds the
    counts up.  Null and empty texts, and those whose tokens do not spell space+text (U+2581 reads
    as a space in B), have zeros and an empty digest.  Repeated rows and null ids are rows like
    others; texts are used whole; other columns are ignored; an empty table gives no rows.
    """
    blocks = aligned_blocks(docs, a_path, b_path)
    pair = F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long"))
    counts = link_counts(blocks).select(pair.alias("pair"), "n", "top")
    known = block_pairs(blocks).join(counts, "pair")
    known = known.select(F.col("block").alias("of_block"), "at", "n", "top")
    rows = blocks.drop("holders").groupBy("block").cogroup(known.groupBy("of_block"))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _summed(left, right)

    return rows.applyInArrow(run, DOCUMENT_SCHEMA)


def aligned_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and groups (begin and end in bytes of space+text, a and b ids) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_table(a_path, b_path)
        kind = pa.struct(
            {"begin": pa.int64(), "end": pa.int64(), "a": pa.list_(pa.int32()), "b": pa.list_(pa.int32())}
        )
        for batch in batches:
            for part in text_slices(batch, 1, BLOCK_BYTES // 8):
                rows = []
                for numbers in words.text_words(part.column(1).to_pylist()):
                    groups, begin = [], 0
                    spelled = b";".join([words.spelled[k] for k in numbers.tolist()]).decode()
                    for group in spelled.split(";") if spelled else []:
                        a, b = ([int(t) for t in side.split(",")] for side in group.split("|"))
                        end = begin + int(words.pair.a_sizes[a].sum())
                        groups.append({"begin": begin, "end": end, "a": a, "b": b})
                        begin = end
                    rows.append(groups)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(rows, pa.list_(kind))], names=["doc_id", "groups"]
                )
                words.tidy()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    kind = "array<struct<begin:long,end:long,a:array<int>,b:array<int>>>"
    return in_arrow(rows, run, f"doc_id long, groups {kind}")


def op13_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``."""
    import public_tokenizers

    return document_alignments(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
