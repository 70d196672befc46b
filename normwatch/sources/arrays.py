"""One large JSON array read by many tasks.

A file is read in byte ranges, cut at every closing brace.  Whether a brace ends a record depends on
all text before it: is it inside a string, and how deep?  So each piece is described for both cases,
the descriptions are added up within ranges, the ranges are added up in order (few rows), and with
that each piece knows where it stands.  Pieces of a record are then joined again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from normwatch.operators.joins import spread_join
from normwatch.session import cut_lineage
from normwatch.sources.inference import infer_schema
from normwatch.sources.records import from_json_text

RANGE_CONF = "spark.sql.files.maxPartitionBytes"
# Bytes that one task reads, in ranges of any size.
TASK_BYTES = 16 * 1024 * 1024
_RANGE = ["file", "start"]


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _without_strings(text: Column) -> Column:
    """The text outside strings, if it begins outside one; escapes were removed before."""
    return F.regexp_replace(text, r'(?s)"[^"]*("|$)', "")


def _pieces(spark: SparkSession, path: str | list[str], ranges_of_task: int = 1) -> DataFrame:
    """Pieces of files with what they change: parity of quotes, and depth for both beginnings."""
    rows = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    if ranges_of_task > 1:
        # Small ranges share a task, which reads them one after the other: what tasks report to the
        # driver does not grow with the number of ranges.
        number = rows.rdd.getNumPartitions()
        least = min(number, spark.sparkContext.defaultParallelism)
        rows = rows.coalesce(max(least, -(-number // ranges_of_task)))
    rows = rows.select(*_RANGE, F.monotonically_increasing_id().alias("no"), "value")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = _count(plain, '"') % 2
    after_string = F.regexp_replace(plain, r'(?s)^[^"]*("|$)', "")

    def change(outside: Column, ends_outside: Column) -> Column:
        # The brace that follows the piece closes something if it is not in a string.
        return _count(outside, "{[") - _count(outside, "]") - F.when(ends_outside, 1).otherwise(0)

    return rows.select(
        *_RANGE,
        "no",
        "value",
        quotes.alias("quotes"),
        change(_without_strings(plain), quotes == 0).alias("change_out"),
        change(_without_strings(after_string), quotes == 1).alias("change_in"),
    )


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with the record they belong to, and whether they end it."""
    line = Window.partitionBy(*_RANGE).orderBy("no")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    flipped = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    # What a piece changes if its range begins outside a string, and inside one.
    each = pieces.withColumn("flipped", flipped).withColumns(
        {
            "if_out": F.when(F.col("flipped") == 0, F.col("change_out")).otherwise(F.col("change_in")),
            "if_in": F.when(F.col("flipped") == 0, F.col("change_in")).otherwise(F.col("change_out")),
        }
    )
    each = cut_lineage(each.select(*_RANGE, "no", "value", "quotes", "flipped", "if_out", "if_in"))
    ranges = each.groupBy(*_RANGE).agg(
        (F.sum("quotes") % 2).alias("quotes"), F.sum("if_out").alias("out"), F.sum("if_in").alias("in")
    )
    files = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(files), F.lit(0)) % 2)
    ranges = ranges.withColumn("change", F.when(F.col("inside") == 0, F.col("out")).otherwise(F.col("in")))
    depth = F.coalesce(F.sum("change").over(files), F.lit(0))
    ranges = ranges.select(
        F.col("file").alias("r_file"), F.col("start").alias("r_start"), "inside", depth.alias("depth")
    )
    on = [("file", "r_file"), ("start", "r_start")]
    known = spread_join(each, ranges, on).drop("r_file", "r_start")
    change = F.when(F.col("inside") == 0, F.col("if_out")).otherwise(F.col("if_in"))
    outside = (F.col("inside") + F.col("flipped") + F.col("quotes")) % 2 == 0
    deep = F.col("depth") + F.sum(change).over(upto)
    ends = F.when(outside & (deep == 1), 1).otherwise(0)
    known = cut_lineage(known.select(*_RANGE, "no", "value", ends.alias("ends")))
    # Records are numbered through the ranges of a file in the same way.
    totals = known.groupBy(*_RANGE).agg(F.sum("ends").alias("n"))
    first = F.coalesce(F.sum("n").over(files), F.lit(0)).alias("first")
    totals = totals.select(F.col("file").alias("t_file"), F.col("start").alias("t_start"), first)
    joined = spread_join(known, totals, [("file", "t_file"), ("start", "t_start")])
    record = F.col("first") + F.coalesce(F.sum("ends").over(before), F.lit(0))
    return joined.select("file", "start", "no", "value", "ends", record.alias("record"))


def array_records(
    spark: SparkSession, path: str | list[str], range_bytes: int | None = None
) -> DataFrame:
    """The texts (value) of the objects in JSON arrays, one array to a file, on any number of lines.

    Files are read in ranges of ``range_bytes`` (default: the setting of the session).  Strings may
    hold brackets, braces, quotes and escapes.  What stands between records and is no object stays
    in front of the next record, so that it is found corrupt and not lost; text after the last
    record is left out.  A record has to fit into a task, a file need not.
    """
    before = spark.conf.get(RANGE_CONF)
    ranges_of_task = 1
    if range_bytes is not None:
        ranges_of_task = max(1, TASK_BYTES // range_bytes)
        spark.conf.set(RANGE_CONF, str(range_bytes))
    try:
        pieces = cut_lineage(_pieces(spark, path, ranges_of_task))
    finally:
        spark.conf.set(RANGE_CONF, before)
    placed = _placed(pieces)
    parts = F.sort_array(F.collect_list(F.struct("start", "no", "value")))
    records = placed.groupBy("file", "record").agg(parts.alias("parts"), F.max("ends").alias("ends"))
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    whole = records.where("ends = 1")
    return whole.select(F.regexp_replace(text, r"(?s)^[\s,\[]*", "").alias("value"))


def read_json_array(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    range_bytes: int | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """Records of large JSON arrays, with a declared schema or the one they turn out to have."""
    texts = cut_lineage(array_records(spark, path, range_bytes))
    return from_json_text(texts, "value", schema or infer_schema(texts), corrupt)
