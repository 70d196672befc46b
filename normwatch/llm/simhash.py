"""Near duplicates by SimHash with deletion-variant signatures.

Fingerprints (64 bits) link when at most three bits differ.  They are cut into two segments of 32
bits, so one segment of a linked pair differs by at most one bit.  Each fingerprint is indexed
under 2 x 33 signatures: a segment as it is, and the segment with one bit replaced by a wildcard.
Rows with equal signatures meet in an equality self-join, carried out as a sort by signature, and
every candidate is verified on all 64 bits.

A signature may be shared by very many fingerprints.  Those above ``BUCKET`` are not paired: the
remaining 32 bits are cut in the same way (again at most one differing bit in one of two segments),
and so on down to eight bits, where a bucket holds at most 2,048 distinct fingerprints.  No case is
dropped.  A bucket returns a star per linked set instead of all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import (
    binary_text,
    bounded_side,
    connected_components,
    in_arrow,
    same,
    sorted_runs,
    stored,
    table,
)

SHINGLE_WORDS = 3
MAX_BITS = 3
BUCKET = 512
_LAST_BUCKET = 4096
_CHUNK = 1 << 22
_ONE = np.uint64(1)
WHITE_SPACE = b" \t\n\x0b\x0c\r"


def _word_chunks(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words in pieces, so that a very long text is never held as one list."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _CHUNK)
        while end < len(text) and text[end] not in WHITE_SPACE:
            end += 1
        yield text[at:end].lower().split()
        at = end


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a whole text over its word shingles, repeats included.

    Fewer words than a shingle has make one shingle; no words make zero.
    """
    digest = xxhash.xxh64_intdigest
    counts, number, tail = np.zeros(64, np.int64), 0, []
    for piece in _word_chunks(text):
        tail = tail + piece
        if len(tail) < words:
            continue
        joined = b" ".join(tail)
        ends = np.cumsum([len(w) + 1 for w in tail]).tolist()
        starts = [0, *ends]
        hashes = [digest(joined[a : b - 1], 42) for a, b in zip(starts, ends[words - 1 :])]
        counts += _bit_counts(hashes)
        number += len(hashes)
        tail = tail[len(tail) - words + 1 :]
    if not number:
        return digest(b" ".join(tail), 42) if tail else 0
    bits = (2 * counts > number).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the 64 bits of the fingerprint as a long; null texts count as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text().alias("text"))
    return in_arrow(rows, _fingerprint_batches, "doc_id long, fp long")


def _identified_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints with the SHA-256 and the bytes of the text."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        made = np.array([fingerprint(t) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(made.view(np.int64)),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["doc_id", "fp", "digest", "size"],
        )


# A region is the part of the fingerprint that a level cuts: lowest bit and width.  The choice of a
# level is segment * (half + 1) + wildcard, where the last wildcard stands for the segment as it is.
_LEVELS = 3


def _cut(low: np.ndarray, width: int, fp: np.ndarray, choice: np.ndarray):
    """For each row and its choice: bits of the segment that stay fixed, and the other segment."""
    half = width // 2
    segment, wildcard = choice // (half + 1), choice % (half + 1)
    begin = low + segment * half
    mask = np.uint64((1 << half) - 1) << begin.astype(np.uint64)
    wild = np.where(wildcard < half, _ONE << (begin + wildcard % half).astype(np.uint64), np.uint64(0))
    return mask & ~wild, wild, low + (1 - segment) * half


def _regions(path: np.ndarray, level: int):
    """Fixed mask, wildcards and free region of rows whose choices so far are packed in path."""
    low = np.zeros(len(path), np.int64)
    width = 64
    fixed = np.zeros(len(path), np.uint64)
    wilds = np.zeros(len(path), np.uint64)
    for number in range(level):
        choice = (path >> (8 * number)) & 255
        mask, wild, low = _cut(low, width, None, choice)
        fixed |= mask
        wilds |= wild
        width //= 2
    return fixed, wilds, low, width


def signature_rows(fp: np.ndarray, path: np.ndarray, level: int) -> pa.RecordBatch:
    """The variants of the next level for rows that share the choices in ``path``."""
    _, _, _, width = _regions(path[:1], level)
    choices = 2 * (width // 2 + 1)
    new = np.repeat(path, choices) | (np.tile(np.arange(choices), len(fp)) << (8 * level))
    wide = np.repeat(fp, choices)
    fixed, _, _, _ = _regions(new, level + 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(new.astype(np.int32)), pa.array((wide & fixed).view(np.int64)), pa.array(wide.view(np.int64))],
        names=["path", "sig", "fp"],
    )


def _first_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for part in np.array_split(fp, max(1, len(fp) // 5000)):
            if len(part):
                yield signature_rows(part, np.zeros(len(part), np.int64), 0)


def _stars(fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a bucket as (fingerprint, smallest linked one), transitively closed within it."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= most
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(axis=1)
        if (new == label).all():
            break
        label = new
    linked = label != np.arange(len(fp))
    return fp[linked], fp[label[linked]]


def _verify(level: int, most: int):
    bucket = BUCKET if level < _LEVELS else _LAST_BUCKET

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, rows in sorted_runs(batches, ["path", "sig"], bucket):
            path = rows.column("path").to_numpy().astype(np.int64)
            fp = rows.column("fp").to_numpy().view(np.uint64)
            if kind == "part":
                for at in range(0, len(fp), 4096):
                    more = signature_rows(fp[at : at + 4096], path[at : at + 4096], level)
                    yield pa.RecordBatch.from_arrays(
                        [more.column(0), more.column(1), more.column(2)], names=["path", "a", "b"]
                    )
                continue
            sig = rows.column("sig").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (sig[1:] != sig[:-1])]))
            sizes = np.diff(np.concatenate([starts, [len(fp)]]))
            # A wildcard that all rows of a bucket agree on repeats the bucket without it.
            _, wilds, _, _ = _regions(path[starts], level)
            differ = np.bitwise_or.reduceat(fp, starts) ^ np.bitwise_and.reduceat(fp, starts)
            useful = (sizes > 1) & ((differ & wilds) == wilds)
            first = starts[useful & (sizes == 2)]
            a, b = fp[first], fp[first + 1]
            close = np.bitwise_count(a ^ b) <= most
            left, right = [a[close]], [b[close]]
            for i in np.flatnonzero(useful & (sizes > 2)):
                x, y = _stars(fp[starts[i] : starts[i] + sizes[i]], most)
                left.append(x)
                right.append(y)
            a, b = np.concatenate(left), np.concatenate(right)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), -1, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                    names=["path", "a", "b"],
                )

    return run


def fingerprint_links(distinct: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column fp) that differ in at most ``most`` bits.

    Not every pair is returned, but every linked pair is connected by the links.
    """
    if not 0 <= most <= 3:
        raise ValueError("two segments find at most three differing bits")
    rows = in_arrow(distinct.select("fp"), _first_signatures, "path int, sig long, fp long")
    links = None
    for level in range(1, _LEVELS + 1):
        ordered = rows.repartition("path", "sig").sortWithinPartitions("path", "sig", "fp")
        found = in_arrow(ordered, _verify(level, most), "path int, a long, b long")
        found = stored(found, "links")
        here = found.where("path < 0").select("a", "b")
        links = here if links is None else links.union(here)
        more = found.where("path >= 0")
        if more.isEmpty():
            break
        rows = more.select("path", F.col("a").alias("sig"), F.col("b").alias("fp"))
    return links.distinct()


def _components(rows: DataFrame, most: int) -> DataFrame:
    """f, root and component_id for every fingerprint of ``rows`` (doc_id, fp); a component has one root."""
    each = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = stored(connected_components(fingerprint_links(each, most)), "roots")
    rooted = each.join(roots, each.fp == roots.node, "left").select(
        each.fp, "least", F.coalesce("root", each.fp).alias("root")
    )
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(rooted.join(component, "root").select(F.col("fp").alias("f"), "root", "component_id"), "named")


def near_duplicates(docs: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own included; it is null
    only if all of them are null.  Texts without words have fingerprint zero and link like any
    other.  Repeated rows have equal results.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    named = _components(rows, most).select("f", "component_id")
    return rows.join(bounded_side(named, 24), F.col("fp") == F.col("f")).select(
        "doc_id", "fp", "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Rows of a component that repeat that doc_id are returned once (the longest, then the last by
    SHA-256); a component whose doc_ids are all null keeps one row.  Rows of different components
    may share a doc_id, or have none, and are all returned.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text().alias("text"))
    rows = in_arrow(rows, _identified_batches, "doc_id long, fp long, digest binary, size long")
    rows = stored(rows, "fingerprints")
    found = rows.join(bounded_side(_components(rows, MAX_BITS), 24), F.col("fp") == F.col("f"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    chosen = F.max(F.struct("size", "digest", key.alias("key"))).alias("one")
    kept = found.where(same(F.col("doc_id"), F.col("component_id"))).groupBy("root").agg(chosen)
    kept = stored(kept.select(F.col("one.key").alias("k_key"), F.col("one.digest").alias("k_digest")), "kept")
    # Text keys without NULL: the join and the grouping then share one exchange of the rows.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    row_key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(binary_text(), 256))
    joined = docs.select(row, row_key.alias("key"), digest.alias("digest")).join(
        kept, (F.col("key") == F.col("k_key")) & (F.col("digest") == F.col("k_digest")), "left_semi"
    )
    # Rows left with one key and digest have the same text: any of them.
    return joined.groupBy("key", "digest").agg(F.first("row").alias("row")).select("row.*")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """All rows of ``documents`` with fingerprint and component."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")
