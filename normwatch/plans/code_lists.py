"""Job: the slices of a code list, each written as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from normwatch.operators.codelists import (
    CONCEPT_SCHEME,
    band_concepts,
    code_list_schemes,
    leaf_concepts,
    typed_concepts,
)
from normwatch.session import written_once
from normwatch.sinks import write_parquet

PROPERTY = "http://www.w3.org/ns/ssn/Property"


def run_code_lists(
    codes: DataFrame,
    out: str,
    class_scheme: str,
    property_scheme: str,
    band_scheme: str,
    property_type: str = PROPERTY,
    scheme_type: str = CONCEPT_SCHEME,
    cache: bool = False,
) -> dict[str, str]:
    """Write schemes, system classes, parameters and bands; returns the path of each.

    Every slice is one narrow pass over the columns it needs.  ``cache`` reads the code list once and
    keeps a written copy for the four passes and for later jobs on the same files, which pays where
    it is slow to read or to derive.
    """
    if cache:
        codes = written_once(codes, "codes")
    slices = {
        "schemes": code_list_schemes(codes, scheme_type),
        "classes": leaf_concepts(codes, class_scheme),
        "parameters": typed_concepts(codes, property_scheme, property_type),
        "bands": band_concepts(codes, band_scheme),
    }
    paths = {name: f"{out}/{name}" for name in slices}
    for name, rows in slices.items():
        write_parquet(rows, paths[name])
    return paths
