"""Schemas of JSON records found from the records, and reading with them.

Types merge commutatively, so partitions are combined in any order and one pass over the texts
suffices; what a task holds is one type, not rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from normwatch.sources.records import from_json_text

# Names in backquotes are left alone.
_OBJECT = re.compile(r"(`(?:[^`]|``)*`)|OBJECT<")


def _as_type(text: str | None) -> T.DataType:
    """A type as the VARIANT functions write it."""
    if text is None:
        return T.NullType()
    written = _OBJECT.sub(lambda m: m.group(1) or "STRUCT<", text)
    return T.StructType.fromDDL(f"v {written}")["v"].dataType


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; VARIANT if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        mine = {f.name: f.dataType for f in a}
        theirs = {f.name: f.dataType for f in b}
        return T.StructType(
            [
                T.StructField(name, merge_types(mine.get(name, T.NullType()), theirs.get(name, T.NullType())))
                for name in sorted(mine.keys() | theirs.keys())
            ]
        )
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.VariantType()


def _readable(kind: T.DataType) -> T.DataType:
    """The type that values are read as: numbers with decimals as doubles, and as text what never
    had a value, has values of several types, or is an object without fields."""
    if isinstance(kind, T.StructType):
        if not kind.fields:
            return T.StringType()
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        whole = isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18
        return T.LongType() if whole else T.DoubleType()
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    return kind


def infer_schema(texts: DataFrame, column: str = "value") -> T.StructType:
    """The schema of JSON texts, each an object or an array of objects, in one pass over them.

    Fields are those of any record, by name.  Whole numbers are bigint, or double if any record has
    decimals or more digits; a field that is always null, or has values of several types, is string,
    as which any JSON value can be read.  Texts that are no JSON, or hold neither objects nor arrays
    of them, say nothing; without any record the schema has no fields.
    """
    # A VARIANT forgets that 40.0 was written with decimals, so they are made to be other than zero;
    # that changes the type of no other value.
    marked = F.regexp_replace(F.col(column), r"([0-9])\.([0-9])", "$1.5$2")
    value = F.try_parse_json(marked)
    is_array = F.startswith(F.ltrim(F.col(column)), F.lit("["))
    kinds = texts.agg(
        F.schema_of_variant_agg(F.when(F.rlike(column, F.lit(r"^\s*\{")), value)).alias("objects"),
        F.schema_of_variant_agg(F.when(is_array, value)).alias("arrays"),
    ).first()
    objects, arrays = _as_type(kinds["objects"]), _as_type(kinds["arrays"])
    items = arrays.elementType if isinstance(arrays, T.ArrayType) else T.NullType()
    if not isinstance(items, T.StructType):
        items = T.NullType()
    merged = merge_types(objects, items)
    if not isinstance(merged, T.StructType):
        return T.StructType()
    return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in merged])


def from_json_inferred(texts: DataFrame, column: str = "value") -> DataFrame:
    """Records of JSON texts with the schema that they turn out to have."""
    return from_json_text(texts, column, infer_schema(texts, column))


def read_json_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON lines files with the schema that they turn out to have."""
    return from_json_inferred(spark.read.text(path).where(F.trim("value") != ""), "value")
