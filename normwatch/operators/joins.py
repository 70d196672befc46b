"""Joins whose strategy follows from what is known, without running the data to find out.

``spread_join`` never starts a job.  It has three ways:

1. the right side is declared to fit (``right_bytes``): it is broadcast, the left is not shuffled;
2. hot keys are given: their rows are spread over salts, the rows they meet are copied per salt;
3. else it is a plain join: Spark broadcasts a side that its statistics or the running query show to
   be small, and splits partitions that turn out to be skewed.

Hot keys are worth the trouble where an aggregate on the key follows, which keeps Spark from
splitting.  ``hot_keys`` counts them, exactly and without a limit on their number; take it once, of
a stored table, and pass it on.  Whichever way is taken, every pair is produced exactly once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key that one task should get at most.
HOT_KEY_ROWS = 5_000_000
# The entry of rows without a key among hot keys.
NO_KEY = None

HotKeys = Mapping[int | None, int]


def driver_bytes(rows: Iterable[tuple]) -> int:
    """Size of a table made from rows that are in the driver already."""
    return sum(16 + sum(16 + len(str(value)) for value in row) for row in rows)


def hot_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int | None = None
) -> dict[int | None, int]:
    """Hashes of the keys with at least ``min_rows`` rows, and their row counts.

    Rows that lack part of the key count under ``NO_KEY``.  Counts are combined before the shuffle.
    At most (rows of ``df``) / ``min_rows`` keys come back.
    """
    least = HOT_KEY_ROWS if min_rows is None else min_rows
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    hashed = df.select(F.when(present, F.xxhash64(*keys)).alias("key_hash"))
    counts = hashed.groupBy("key_hash").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return {row["key_hash"]: row["n"] for row in counts.collect()}


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    where: Column | None = None,
    right_bytes: int | None = None,
    broadcast_bytes: int | None = None,
    hot: HotKeys | None = None,
    hot_right: HotKeys | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join on equal columns ``on`` (pairs left, right) and an optional residual condition.

    Column names of the two sides must be disjoint.  ``how`` is inner, left, left_semi or
    left_anti.  ``right_bytes`` is an upper bound the caller vouches for.  ``hot`` and ``hot_right``
    are hot keys of the two sides; those of the right only in an inner join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    if hot_right and how != "inner":
        raise ValueError("only an inner join can copy rows of the left side")
    match = [F.col(a) == F.col(b) for a, b in on]
    if where is not None:
        match.append(where)
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if right_bytes is not None and right_bytes <= limit:
        return left.join(F.broadcast(right), reduce(Column.__and__, match), how)
    least = HOT_KEY_ROWS if hot_rows is None else hot_rows
    own = {k: -(-n // least) for k, n in (hot or {}).items() if n > least}
    other = {k: -(-n // least) for k, n in (hot_right or {}).items() if n > least}
    if how not in ("left", "left_anti"):
        # Rows without a key meet nothing and are dropped before the shuffle.
        own.pop(NO_KEY, None)
    other.pop(NO_KEY, None)
    if not own and not other:
        return left.join(right, reduce(Column.__and__, match), how)

    # Both sides must agree on the hash, so the right keys are hashed in the type of the left.
    left_hash = F.xxhash64(*[F.col(a) for a, _ in on])
    right_hash = F.xxhash64(*[F.col(b).cast(left.schema[a].dataType) for a, b in on])
    for name, mine, copies in (("x", own, "right"), ("y", other, "left")):
        if not mine:
            continue
        spread, copied = (left, right) if copies == "right" else (right, left)
        spread_hash, copied_hash = (
            (left_hash, right_hash) if copies == "right" else (right_hash, left_hash)
        )
        keys = [a for a, _ in on] if copies == "right" else [b for _, b in on]
        spread = spread.withColumn(f"salt_{name}", _salt(spread, spread_hash, keys, mine))
        numbers = F.sequence(F.lit(0), _salts_of(copied_hash, mine) - 1)
        copied = copied.withColumn(f"salted_{name}", F.explode(numbers))
        left, right = (spread, copied) if copies == "right" else (copied, spread)
        match.append(F.col(f"salt_{name}") == F.col(f"salted_{name}"))
    joined = left.join(right, reduce(Column.__and__, match), how)
    return joined.drop("salt_x", "salted_x", "salt_y", "salted_y")


def _salts_of(key_hash: Column, salts: Mapping[int | None, int]) -> Column:
    """The number of salts of a key: a lookup in a table of the keys, 1 for all others."""
    known = {k: n for k, n in salts.items() if k is not NO_KEY}
    if not known:
        return F.lit(1)
    by_number: dict[int, list[int]] = {}
    for key, number in known.items():
        # Powers of two keep the number of branches small.
        by_number.setdefault(1 << (number - 1).bit_length(), []).append(key)
    picks = [F.when(key_hash.isin(keys), F.lit(n)) for n, keys in sorted(by_number.items())]
    return F.coalesce(*picks, F.lit(1))


def _salt(
    rows: DataFrame, key_hash: Column, keys: Sequence[str], salts: Mapping[int | None, int]
) -> Column:
    number = _salts_of(key_hash, salts)
    if NO_KEY in salts:
        # Rows without a key meet nothing, so their salt need not exist on the other side.
        missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        number = F.when(missing, F.lit(salts[NO_KEY])).otherwise(number)
    plain = [f.name for f in rows.schema if isinstance(f.dataType, T.AtomicType)]
    # The task number spreads equal copies of a row; a retried task gets the same number.
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in plain])
    return F.when(number > 1, F.pmod(row_hash, number).cast("int")).otherwise(F.lit(0))
