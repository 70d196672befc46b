"""Compact IRIs (``prefix:rest``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix_of(col: Column) -> Column:
    """The text before the first colon, or NULL where there is none."""
    return F.when(F.instr(col, ":") > 0, F.substring_index(col, ":", 1))


def rest_of(col: Column) -> Column:
    """The text after the first colon."""
    return F.substring(col, F.instr(col, ":") + 1, F.length(col))


def expand_iri(col: Column, prefixes: Mapping[str, str] | None) -> Column:
    """Full IRI of a compact one; one with an unknown prefix stays as it is."""
    if not prefixes:
        return col
    pairs = [F.lit(part) for item in prefixes.items() for part in item]
    namespace = F.try_element_at(F.create_map(*pairs), prefix_of(col))
    return F.coalesce(F.concat(namespace, rest_of(col)), col)
