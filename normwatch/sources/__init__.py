"""Readers."""

from normwatch.sources.arrays import array_records, read_json_array
from normwatch.sources.context import Context, STANDARD_CONTEXT, read_context
from normwatch.sources.inference import from_json_inferred, infer_schema, read_json_inferred
from normwatch.sources.records import (
    bands_from_alt,
    from_json_text,
    read_json,
    read_observations,
    read_parquet,
    systems_from_alt,
    typed_observations,
    unwrap_envelope,
)

__all__ = [
    "Context",
    "STANDARD_CONTEXT",
    "array_records",
    "bands_from_alt",
    "from_json_inferred",
    "from_json_text",
    "infer_schema",
    "read_context",
    "read_json",
    "read_json_array",
    "read_json_inferred",
    "read_observations",
    "read_parquet",
    "systems_from_alt",
    "typed_observations",
    "unwrap_envelope",
]
