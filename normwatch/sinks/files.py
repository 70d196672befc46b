"""Parquet, JSON and N-Triples files.

Every writer overwrites its target.  Partitioned writes are rebalanced on the partition column
first: rows of one date come together in files of the advisory size, a hot date is split over
several tasks, and no task opens a file per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

from normwatch.operators.triples import ntriples_lines


def _writer(
    df: DataFrame, partition_by: Sequence[str], single_file: bool
) -> DataFrameWriter:
    if single_file:
        # One task gathers and writes all rows, as asked for; what is upstream stays parallel.
        df = df.repartition(1)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), single_file: bool = False
) -> None:
    """Parquet files; with ``single_file`` one file (per date), written by one task."""
    _writer(df, partition_by, single_file).parquet(path)


def write_json(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), single_file: bool = False
) -> None:
    """JSON lines."""
    _writer(df, partition_by, single_file).json(path)


def write_nested_json(df: DataFrame, path: str) -> None:
    """Framed records, one JSON document per line, NULL fields left out."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_ntriples(triples: DataFrame, path: str) -> None:
    """Triples with full IRIs, one statement per line."""
    ntriples_lines(triples).write.mode("overwrite").text(path)


def round_trip_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and read back with the same column types."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to SQL under a name."""
    df.createOrReplaceTempView(name)
    return df
