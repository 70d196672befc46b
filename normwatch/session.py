"""Session helpers: local session for tests, shared scratch space, lineage cuts."""

from __future__ import annotations

import atexit
import hashlib
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int = 8, app: str = "normwatch") -> SparkSession:
    """A ``local[cpus]`` session for tests and benchmarks.  On a cluster use its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("NORMWATCH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) that lacks the setting gets a temporary folder, which is
    removed when the program ends.  On a cluster the setting is required.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="normwatch-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy.

    The planner takes the size of the copy from its files.  A checkpoint would keep the estimate of
    the plan it was made by, and as that of a join is a product, the estimates of tables that are
    joined with themselves round by round soon have millions of digits.
    """
    path = scratch_path(df.sparkSession, "cut")
    # Digests and names are most of what is written; zstd takes half the space.
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files_mark(df: DataFrame) -> str:
    """A digest of the names, sizes and times of the files a result is read from."""
    files = df.inputFiles()
    if not files:
        return "none"
    listed = df.sparkSession.read.format("binaryFile").load(files)
    each = F.xxhash64("path", "modificationTime", "length")
    row = listed.select(each.alias("h")).agg(F.bit_xor("h"), F.count("*")).first()
    return f"{row[0]}-{row[1]}"


def written_once(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The written copy of ``df``, written by whoever asks for it first.

    A copy is known by ``name``, the plan, its columns and the state of the files it reads; if any of
    them changes, a new copy is written.  Nothing is held in the memory of executors.  ``folder``
    (default: the shared folder) keeps the copies; one that was not finished is not used.  Plans
    that read anything but files, or are not repeatable, should not be kept like this.
    """
    spark = df.sparkSession
    parts = (name, str(df.semanticHash()), df.schema.json(), _files_mark(df))
    mark = hashlib.sha256("\n".join(parts).encode()).hexdigest()
    base = f"{(folder or shared_dir(spark)).rstrip('/')}/{name}-{mark}"
    try:
        found = spark.read.schema("path string").json(f"{base}/done").agg(F.min("path")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    if found is None:
        found = f"{base}/{uuid.uuid4().hex}"
        df.write.parquet(found)
        done = literal_table(spark, [(found,)], "path string")
        done.write.mode("append").json(f"{base}/done")
    return spark.read.schema(df.schema).parquet(found)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write rows grouped by ``key`` as a table bucketed by it, in the shared folder.

    Joins and groupings of the copy by the key are not shuffled again.  There are as many buckets as
    shuffle partitions, so the grouping and the buckets agree and each bucket is one file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").bucketBy(buckets, key).option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return {
        "string": pa.string(),
        "double": pa.float64(),
        "bigint": pa.int64(),
        "int": pa.int32(),
        "boolean": pa.bool_(),
    }[kind.simpleString()]


def literal_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A table of rows written down in the program.

    Built from Arrow it becomes a local relation, whose size the planner knows, instead of an RDD.
    """
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [
        pa.array(column, _arrow_type(field.dataType)) for column, field in zip(columns, schema)
    ]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)
