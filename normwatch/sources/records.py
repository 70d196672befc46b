"""Records from JSON files, JSON text and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from normwatch.schemas import OBSERVATION_AS_TEXT


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """JSON files with a declared schema.

    A multi-line file (an array or one document) is read by one task, so keep such files moderate
    and many; JSON lines (``multiline=False``) and Parquet split within a file.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet files; they describe themselves."""
    return spark.read.parquet(path)


CORRUPT = "_corrupt_record"


def from_json_text(
    texts: DataFrame, column: str, schema: T.StructType, corrupt: str | None = None
) -> DataFrame:
    """Records from a column of JSON texts, each an object or an array of objects.

    A text that is neither gives one record of NULLs; with ``corrupt`` its text is kept in a column
    of that name, which is NULL for all other records.
    """
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    text = F.col(column)
    # Read as an array, an object is an array of one; what is neither becomes one corrupt record.
    records = F.from_json(text, T.ArrayType(kept), options)
    lost = F.from_json(F.lit("{}"), kept).withField(CORRUPT, text)
    records = F.when(text.isNotNull() & (records.isNull()), F.array(lost)).otherwise(
        F.coalesce(records, F.array(F.from_json(F.lit("{}"), kept)))
    )
    rows = texts.select(F.explode(records).alias("record"))
    columns = [F.col(f"record.`{f.name}`").alias(f.name) for f in schema.fields]
    if corrupt is not None:
        columns.append(F.col(f"record.{CORRUPT}").alias(corrupt))
    return rows.select(*columns)


def unwrap_envelope(documents: DataFrame, field: str = "@graph") -> DataFrame:
    """The records a document holds in an array, one row each."""
    return documents.select(F.explode(F.col(f"`{field}`")).alias("record")).select("record.*")


def typed_observations(observations: DataFrame) -> DataFrame:
    """Observations read with the number as text, with the number as a double.

    ``7.7`` and ``"7.7"`` both become 7.7; other text becomes NULL.
    """
    result = F.col("result")
    number = result["numerieke_waarde"].try_cast("double")
    return observations.withColumn(
        "result", F.when(result.isNotNull(), result.withField("numerieke_waarde", number))
    )


def read_observations(
    spark: SparkSession, path: str | list[str], multiline: bool = True
) -> DataFrame:
    """Observation records; ``resultTime`` stays the text that was written."""
    return typed_observations(read_json(spark, path, OBSERVATION_AS_TEXT, multiline))


def systems_from_alt(systems: DataFrame) -> DataFrame:
    """Systems of the second layout, whose operating properties are named by ``parameter``."""
    properties = F.transform(
        "hasOperatingRange.hasOperatingProperty",
        lambda op: F.struct(
            op["_type"].alias("_type"),
            op["parameter"].alias("forProperty"),
            op["value"].alias("value"),
            op["minValue"].alias("minValue"),
            op["maxValue"].alias("maxValue"),
        ),
    )
    kind = F.col("hasOperatingRange._type").alias("_type")
    operating = F.struct(kind, properties.alias("hasOperatingProperty"))
    return systems.withColumn("hasOperatingRange", operating)


def bands_from_alt(bands: DataFrame) -> DataFrame:
    """Bands of the second layout, in the names of the first."""
    return bands.select(
        F.col("_id").alias("id"),
        F.col("klasse").alias("subject"),
        F.col("parameter").alias("forProperty"),
        F.col("label").alias("prefLabel"),
        F.lit(None).cast("string").alias("definition"),
        F.col("note").alias("scopeNote"),
        F.col("type").alias("dc_type"),
        "actie",
        "value",
        "minValue",
        "maxValue",
        "operatie",
    )
