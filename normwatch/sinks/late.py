"""Writing again to what is there: one date replaced, or only rows added that are new.

Ids repeat when a job runs again, so a row that was written is known by its id.  The rows there are
many and the new ones few: a Bloom filter of the new ids, of a fixed size, screens the rows of the
same dates where they lie, and only what it lets through is compared exactly.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.operators.joins import spread_join
from normwatch.session import cut_lineage

# Words of 64 bits, of which an id sets four in one word.  In memory that is a bounded table.
FILTER_WORDS = 1 << 18
_BITS = 4


def _word_of(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), words)


def _mask_of(key: Column) -> Column:
    """A word with the bits of an id set."""
    spread = F.xxhash64(F.lit(1), key)
    mask = F.lit(0).cast("long")
    for i in range(_BITS):
        at = F.shiftrightunsigned(spread, 8 * i).bitwiseAND(F.lit(63)).cast("int")
        # The last bit of a word is that of the sign.
        bit = F.when(at == 63, F.lit(-(1 << 63))).otherwise(F.pow(F.lit(2.0), at).cast("long"))
        mask = mask.bitwiseOR(bit)
    return mask


def bloom_words(ids: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """(word, bits) of a Bloom filter of the ids; at most ``words`` rows."""
    marked = ids.where(F.col(key).isNotNull()).select(
        _word_of(F.col(key), words).alias("word"), _mask_of(F.col(key)).alias("mask")
    )
    return marked.groupBy("word").agg(F.bit_or("mask").alias("bits"))


def screened(rows: DataFrame, key: str, filter_: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The rows whose id the filter may hold: all that it holds, and few others."""
    probed = rows.withColumn("word_", _word_of(F.col(key), words)).withColumn("mask_", _mask_of(F.col(key)))
    within = F.col("bits").bitwiseAND(F.col("mask_")) == F.col("mask_")
    # The size of the filter is fixed.
    kept = spread_join(probed, filter_, [("word_", "word")], "left_semi", within, right_bytes=words * 32)
    return kept.drop("word_", "mask_")


def _written(df: DataFrame, path: str, format_: str) -> DataFrame | None:
    try:
        return df.sparkSession.read.schema(df.schema).format(format_).load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def replace_dates(df: DataFrame, path: str, date: str = "datum", format_: str = "parquet") -> None:
    """Replace the dates that ``df`` has rows of; files of other dates are not touched."""
    writer = df.hint("rebalance", date).write.mode("overwrite").partitionBy(date)
    writer.option("partitionOverwriteMode", "dynamic").format(format_).save(path)


def new_rows(
    df: DataFrame, path: str, key: str = "_id", date: str = "datum", format_: str = "parquet"
) -> DataFrame:
    """The rows of ``df`` that are not below ``path`` yet, each id of a date once; written aside.

    Of rows with the same id and date any one is taken.  Rows without an id are always new.
    """
    unnamed = df.where(F.col(key).isNull())
    named = cut_lineage(df.where(F.col(key).isNotNull()).dropDuplicates([key, date]))
    there = _written(df, path, format_)
    if there is not None:
        dates = named.select(F.col(date).alias("of_date")).distinct()
        of_dates = there.select(F.col(key).alias("there"), F.col(date).alias("there_date"))
        # Other dates are not read: this becomes a filter on the folders.
        same_date = F.col("there_date").eqNullSafe(F.col("of_date"))
        of_dates = of_dates.join(F.broadcast(dates), same_date, "left_semi")
        known = screened(of_dates, "there", bloom_words(named, key))
        same = (F.col(key) == F.col("there")) & F.col(date).eqNullSafe(F.col("there_date"))
        named = named.join(known, same, "left_anti")
    return cut_lineage(named.unionByName(unnamed))


def add_late(
    df: DataFrame, path: str, key: str = "_id", date: str = "datum", format_: str = "parquet"
) -> DataFrame:
    """Append the new rows of ``df`` by date and return them; a second call adds nothing."""
    added = new_rows(df, path, key, date, format_)
    added.hint("rebalance", date).write.mode("append").partitionBy(date).format(format_).save(path)
    return added
