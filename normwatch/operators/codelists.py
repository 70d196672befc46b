"""Slices of a code list: schemes, leaf concepts, typed concepts and band concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONCEPT_SCHEME = "http://www.w3.org/2004/02/skos/core#ConceptScheme"


def code_list_schemes(codes: DataFrame, scheme_type: str = CONCEPT_SCHEME) -> DataFrame:
    """The concept schemes of the code list."""
    return codes.where(F.array_contains("type", scheme_type)).select("id", "prefLabel")


def leaf_concepts(codes: DataFrame, scheme: str) -> DataFrame:
    """Concepts of a scheme with an empty list of narrower ones; a missing list is no leaf."""
    leaf = (F.col("inScheme") == scheme) & (F.array_size("narrower") == 0)
    return codes.where(leaf).select("id", "type", "inScheme", "prefLabel", "broader")


def typed_concepts(codes: DataFrame, scheme: str, type_: str) -> DataFrame:
    """Concepts of a scheme that have a type, one row per occurrence of the type."""
    each = codes.where(F.col("inScheme") == scheme).withColumn("type", F.explode("type"))
    return each.where(F.col("type") == type_).select(
        "id",
        "type",
        "inScheme",
        "prefLabel",
        "dct_type",
        "applicableUnit",
        "subject",
        "seeAlso",
    )


def concepts_for_class(concepts: DataFrame, class_: str) -> DataFrame:
    """Ids of the concepts that apply to a class."""
    return concepts.where(F.array_contains("dct_type", class_)).select("id")


def classes_for_concept(
    concepts: DataFrame, concept_id: str | None = None, separator: str = "|"
) -> DataFrame:
    """The classes a concept applies to as one text; for one concept (its first row), or for all."""
    joined = F.array_join("dct_type", separator).alias("classes")
    if concept_id is None:
        return concepts.select("id", joined)
    return concepts.where(F.col("id") == concept_id).select("id", joined).limit(1)


def band_concepts(
    codes: DataFrame, scheme: str, ignore_types: list[str] | None = None
) -> DataFrame:
    """Band concepts of a scheme, one row per type and class.

    With ``ignore_types``, concepts that have no type besides those are left out.
    """
    rows = codes.where(F.col("inScheme") == scheme)
    if ignore_types:
        ignored = F.array(*[F.lit(t) for t in ignore_types])
        rows = rows.where(F.size(F.array_except("type", ignored)) > 0)
    each = rows.withColumn("type", F.explode("type")).withColumn(
        "dct_type", F.explode("dct_type")
    )
    return each.select(
        "id",
        "type",
        "inScheme",
        "prefLabel",
        "definition",
        "scopeNote",
        "dct_type",
        "relevantProperty",
        "maxValue",
        "minValue",
        "operatie",
    )
