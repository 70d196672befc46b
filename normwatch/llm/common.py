"""What several corpus operators need: written tables, checked broadcasts, components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from normwatch.session import scratch_path

# A side of a join is broadcast only if rows x bytes per row stay below this.
BROADCAST_BYTES = 16 * 1024 * 1024
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and go on from the written copy.

    The copy survives lost executors, and what is read twice is computed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of all executors, once for each Spark context."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if any(name.startswith(f"{package.name}-code") for name in map(_base, context.listFiles)):
        return
    # The driver serves this file to the executors while the program runs.
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{package.name}-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def _base(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def in_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function of this package.

    Arrow batches are bounded by bytes, unless the session has its own bound: the usual 10,000 rows
    of long texts, held as Arrow data and as Python objects, are too much for a worker.
    """
    spark = df.sparkSession
    _ship_package(spark)
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def bounded_side(written: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table with a broadcast hint if its counted size lies within the bound.

    Counting reads only the footers of the files.  Larger tables are joined by a shuffle.
    """
    if written.count() * row_bytes <= limit:
        return F.broadcast(written)
    return written


def same(left: Column, right: Column) -> Column:
    """Equality under which NULL equals NULL; usable as a join key."""
    return left.eqNullSafe(right)


def column_array(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column without NULLs as numpy array."""
    return batch.column(name).to_numpy(zero_copy_only=False)


def byte_texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """Texts of a binary column; NULL counts as empty."""
    return [t if t is not None else b"" for t in batch.column(name).to_pylist()]


def binary_text(name: str = "text") -> Column:
    """The UTF-8 bytes of a text column, NULL counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def sorted_runs(
    batches: Iterator[pa.RecordBatch], keys: list[str], most: int
) -> Iterator[tuple[str, pa.Table]]:
    """Cut rows that arrive sorted by ``keys`` where the key changes.

    Yields ``("whole", rows)``: rows of one or more keys, each complete and of at most ``most``
    rows, and ``("part", rows)``: a piece of a key with more rows.  Memory stays within one batch
    plus ``most`` rows.
    """
    carry: pa.Table | None = None
    hot: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        if carry is not None:
            rows = pa.concat_tables([carry, rows]).combine_chunks()
            carry = None
        columns = [rows.column(k).to_numpy() for k in keys]
        change = np.zeros(rows.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        first = 0
        if hot is not None:
            if tuple(c[0] for c in columns) == hot:
                end = int(starts[1]) if len(starts) > 1 else rows.num_rows
                yield "part", rows.slice(0, end)
                if end == rows.num_rows:
                    continue
                first = 1
            hot = None
        last = int(starts[-1])
        sizes = np.diff(np.concatenate([starts, [rows.num_rows]]))
        # Runs but the last are complete; cut out those above the bound.
        begin = int(starts[first]) if first < len(starts) else rows.num_rows
        for i in np.flatnonzero(sizes[:-1] > most):
            if i < first:
                continue
            if starts[i] > begin:
                yield "whole", rows.slice(begin, int(starts[i]) - begin)
            yield "part", rows.slice(int(starts[i]), int(sizes[i]))
            begin = int(starts[i] + sizes[i])
        if last > begin:
            yield "whole", rows.slice(begin, last - begin)
        if rows.num_rows - last > most:
            yield "part", rows.slice(last)
            hot = tuple(c[-1] for c in columns)
        else:
            carry = rows.slice(last).combine_chunks()
    if carry is not None and carry.num_rows:
        yield "whole", carry


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of an undirected graph given as columns a, b; root is the smallest node.

    Large-star and small-star steps alternate, each an aggregate and a join of narrow rows, until
    the written edges no longer change.  Every round is written to the shared folder.  Self loops
    give their node a component.  NULL ends are left out.
    """
    present = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    links = present.where("a <> b")
    current = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        name,
    )
    before = None
    while True:
        mark = current.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
        ).first()
        if (mark["n"], mark["x"]) == before or mark["n"] == 0:
            break
        before = (mark["n"], mark["x"])
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Larger neighbours of a node go to the smallest node around it.
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.where("a <> b").distinct()
        # Smaller neighbours and the node itself go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b")
        )
        current = stored(small.where("a <> b").distinct(), name)
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    loops = present.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    alone = loops.distinct().join(roots.select("node"), "node", "left_anti")
    return roots.union(own).union(alone).distinct()
