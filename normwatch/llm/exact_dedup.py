"""Exact duplicates of whole texts, batch by batch against immutable snapshots.

Texts are equal when they are identical after deleting every character of ``[\\x20\\x09-\\x0D]``.
Each batch is digested once (SHA-256 of the normalised bytes).  Copies within the batch are grouped
on their own; one digest per group is then screened by the binary-fuse filters of the earlier
snapshots.  What no filter holds is new.  Positives are joined to the exact buckets of the
snapshots, and the normalised bytes of both representatives are compared before they count as
equal.  New digests become the next snapshot.

Filters are cut into buckets by digest and travel to the rows of their bucket in a shuffle; none is
broadcast.  Digests in a batch are distinct before they are screened, so no bucket is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import binary_text, bounded_side, in_arrow, same, stored, table
from normwatch.llm.fuse import FuseFilter

WHITE_SPACE = b" \t\n\x0b\x0c\r"
# Digests in one bucket of a filter; its filter takes about nine bits for each.
BUCKET_DIGESTS = 200_000
# Batches that ``dedup`` cuts a table into.
BATCHES = 3


@dataclass
class Snapshot:
    """The digests first seen in one batch: exact entries and their filters, both written."""

    entries: DataFrame  # digest, doc_id, root (digest and batch where the group began)
    filters: DataFrame  # bucket, filter


def normalised(text: bytes) -> bytes:
    """The bytes that decide equality.  All deleted characters are single bytes in UTF-8."""
    return text.translate(None, WHITE_SPACE)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.sha256(normalised(t)).digest() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), batch.column(2)],
            names=["doc_id", "digest", "n_points"],
        )


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, digest and the code points of the original text; a null text counts as empty."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        binary_text().alias("text"),
        F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_points"),
    )
    return in_arrow(rows, _digest_batches, "doc_id long, digest binary, n_points long")


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plain = [normalised(t) for t in batch.column(1).to_pylist()]
        digests = [hashlib.sha256(t).digest() for t in plain]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(plain, pa.binary())],
            names=["doc_id", "digest", "plain"],
        )


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _keys(digests: pa.ChunkedArray) -> np.ndarray:
    """The leading eight bytes of each digest."""
    joined = b"".join(d[:8] for d in digests.to_pylist())
    return np.frombuffer(joined, "<u8")


def _build_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[np.ndarray]] = {}

    def done(bucket: int) -> pa.RecordBatch:
        made = FuseFilter.build(np.concatenate(held.pop(bucket)))
        return pa.RecordBatch.from_pydict(
            {"bucket": pa.array([bucket], pa.int32()), "filter": pa.array([made.to_bytes()])}
        )

    for batch in batches:
        buckets = batch.column(0).to_numpy()
        keys = _keys(batch.column(1))
        cuts = np.flatnonzero(np.diff(buckets)) + 1
        for part, at in zip(np.split(keys, cuts), np.concatenate([[0], cuts])):
            if not len(part):
                continue
            bucket = int(buckets[at])
            if bucket not in held:
                for other in list(held):
                    yield done(other)
            held.setdefault(bucket, []).append(part)
    for other in list(held):
        yield done(other)


def make_snapshot(entries: DataFrame, buckets: int) -> Snapshot:
    """Build the filters of written entries, one task per range of buckets."""
    cut = (
        entries.select(_bucket(buckets).alias("bucket"), "digest")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
    )
    filters = in_arrow(cut, _build_filters, "bucket int, filter binary")
    return Snapshot(entries, stored(filters, "filters"))


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, the filters of a bucket before its digests."""
    current, filters = None, []
    for batch in batches:
        buckets = batch.column(0).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]])
        for begin, end in zip(cuts[:-1], cuts[1:]):
            if begin == end:
                continue
            if buckets[begin] != current:
                current, filters = buckets[begin], []
            part = batch.slice(begin, end - begin)
            blobs = part.column(1).to_pylist()
            filters += [FuseFilter.from_bytes(b) for b in blobs if b is not None]
            part = part.filter(pa.array([b is None for b in blobs]))
            if not part.num_rows:
                continue
            keys = _keys(part.column(2))
            held = np.zeros(len(keys), bool)
            for one in filters:
                held |= one.contains(keys)
            found = part.filter(pa.array(held))
            yield pa.RecordBatch.from_arrays([found.column(2)], names=["digest"])


def screen(digests: DataFrame, snapshots: list[Snapshot], buckets: int) -> DataFrame:
    """The incoming digests that some filter holds: every true member, and few others."""
    filters = snapshots[0].filters
    for other in snapshots[1:]:
        filters = filters.union(other.filters)
    rows = digests.select(
        _bucket(buckets).alias("bucket"), F.lit(None).cast("binary").alias("filter"), "digest"
    )
    heads = filters.select("bucket", "filter", F.lit(None).cast("binary").alias("digest"))
    sorted_rows = (
        rows.union(heads)
        .repartition("bucket")
        .sortWithinPartitions("bucket", F.col("digest").isNotNull())
    )
    return in_arrow(sorted_rows, _screen, "digest binary")


def _equal_bytes(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those pairs (digest, batch, doc_id, other_id, root) whose texts are the same bytes.

    Only the texts of representatives are read back; they are shuffled by digest.
    """
    ids = stored(
        pairs.select("digest", F.explode(F.array("doc_id", "other_id")).alias("doc_id")).distinct(),
        "checked",
    )
    wanted = bounded_side(ids.select(F.col("digest").alias("d"), F.col("doc_id").alias("i")), 64)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), binary_text().alias("text"))
    plain = in_arrow(texts, _with_bytes, "doc_id long, digest binary, plain binary").join(
        wanted, same(F.col("doc_id"), F.col("i")) & (F.col("digest") == F.col("d")), "left_semi"
    )
    # Rows that repeat a doc_id and its text would repeat the pair.
    plain = plain.groupBy("doc_id", "digest").agg(F.min("plain").alias("plain"))
    left = plain.select(F.col("doc_id").alias("li"), F.col("digest").alias("ld"), F.col("plain").alias("lp"))
    right = plain.select(F.col("doc_id").alias("ri"), F.col("digest").alias("rd"), F.col("plain").alias("rp"))
    return (
        pairs.join(left, (F.col("digest") == F.col("ld")) & same(F.col("doc_id"), F.col("li")))
        .join(right, (F.col("digest") == F.col("rd")) & same(F.col("other_id"), F.col("ri")))
        .where("lp = rp")
        .select("digest", "batch", "root")
    )


def dedup(
    docs: DataFrame, batches: int = BATCHES, bucket_digests: int = BUCKET_DIGESTS
) -> DataFrame:
    """One row per row of ``docs``: its group, and whether it stays.

    The table is taken as ``batches`` arrivals (by a hash of doc_id); the result does not depend on
    how many.  Of equal texts the row with the most code points in the original text stays, then
    the one with the smallest doc_id; a null doc_id counts as the largest.  Null texts equal empty
    ones.  A repeated row is one more member of its group, and exactly one row of a group stays.

    Columns: doc_id, keep_id, group_size, kept, digest.
    """
    arrival = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    rows = stored(digest_rows(docs).withColumn("batch", arrival), "digests")
    buckets = max(1, -(-rows.count() // bucket_digests))
    # One row per digest and batch.  A null doc_id sorts last.
    best = F.min(
        F.struct(
            (-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("u"), F.col("doc_id")
        )
    )
    groups = stored(
        rows.groupBy("batch", "digest").agg(F.count("*").alias("n"), best.alias("best")), "groups"
    )
    snapshots: list[Snapshot] = []
    rooted: DataFrame | None = None  # digest, batch, root: the batch in which the group began
    for number in range(batches):
        fresh = groups.where(F.col("batch") == number).select(
            "digest", "batch", F.col("best.doc_id").alias("doc_id")
        )
        if not snapshots:
            part = fresh.withColumn("root", F.lit(number))
        else:
            positive = screen(fresh, snapshots, buckets)
            entries = snapshots[0].entries
            for other in snapshots[1:]:
                entries = entries.union(other.entries)
            exact = entries.select("digest", F.col("doc_id").alias("other_id"), "root")
            pairs = stored(
                fresh.join(positive, "digest").join(exact, "digest"), "positives"
            )
            equal = _equal_bytes(pairs, docs).groupBy("digest", "batch").agg(F.min("root").alias("root"))
            part = fresh.join(equal, ["digest", "batch"], "left").withColumn(
                "root", F.coalesce("root", F.lit(number))
            )
        part = stored(part, "rooted")
        rooted = part if rooted is None else rooted.union(part)
        if number < batches - 1:
            snapshots.append(make_snapshot(part.where(F.col("root") == number), buckets))

    sums = groups.join(rooted.select("digest", "batch", "root"), ["digest", "batch"])
    total = sums.groupBy("digest", "root").agg(
        F.sum("n").alias("group_size"), F.min("best").alias("keep")
    )
    result = sums.select("digest", "batch", "root").join(total, ["digest", "root"])
    result = result.select("digest", "batch", "group_size", "keep")
    # Equal rows (same doc_id, text and length) are numbered, so that one of them stays.
    alike = rows.groupBy("batch", "digest", "doc_id", "n_points").agg(F.count("*").alias("same_rows"))
    placed = alike.join(result, ["digest", "batch"])
    is_best = same(F.col("doc_id"), F.col("keep.doc_id")) & (F.col("n_points") == -F.col("keep.p"))
    return placed.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        "digest",
        is_best.alias("is_best"),
        F.explode(F.sequence(F.lit(1), F.col("same_rows").cast("int"))).alias("copy"),
    ).select(
        "doc_id", "keep_id", "group_size", (F.col("is_best") & (F.col("copy") == 1)).alias("kept"), "digest"
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A repeated row (same doc_id, same text) is returned once, whichever other columns it has.
    """
    # Text keys without NULL: the join and the grouping then share one exchange of the rows.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    kept = stored(
        dedup(docs).where("kept").select(key.alias("k_key"), F.col("digest").alias("k_digest")),
        "kept",
    )
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    plain = F.regexp_replace(F.col("row.text").cast("string"), r"[\x20\x09-\x0D]+", "")
    digest = F.unhex(F.sha2(F.coalesce(plain, F.lit("")).cast("binary"), 256))
    row_key = F.coalesce(F.col("row.doc_id").cast("long").cast("string"), F.lit(""))
    joined = named.select("row", row_key.alias("key"), digest.alias("digest")).join(
        kept, (F.col("key") == F.col("k_key")) & (F.col("digest") == F.col("k_digest")), "left_semi"
    )
    # In a repeated row only white space can differ; the longest, as kept, comes first.
    longest = F.coalesce(F.length(F.col("row.text").cast("string")), F.lit(0))
    one = joined.groupBy("key", "digest").agg(F.max_by("row", longest).alias("row"))
    return one.select("row.*")


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All rows of ``documents`` by the contract of the query."""
    return dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
), r AS (
  SELECT doc_id, h,
         first_value(doc_id) OVER (PARTITION BY h ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM r
"""
