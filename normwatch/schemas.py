"""Declared schemas.  Inference would turn all-NULL columns into strings and whole numbers into
bigint, and costs a pass over the files."""

from __future__ import annotations

from pyspark.sql import types as T


def _record(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D = T.StringType(), T.DoubleType()

# Field names below are fixed values: they name the columns of the input files.

RESULT = _record(
    ("_type", _S), ("eenheid", _S), ("kwalitatieve_waarde", _S), ("numerieke_waarde", _D)
)
OBSERVATION = _record(
    ("_id", _S),
    ("_type", _S),
    ("hasFeatureOfInterest", _S),
    ("observedProperty", _S),
    ("result", RESULT),
    ("resultTime", _S),
)
# Reading form: a number may be written as text, and JSON text is not accepted for a double.
RESULT_AS_TEXT = _record(
    ("_type", _S), ("eenheid", _S), ("kwalitatieve_waarde", _S), ("numerieke_waarde", _S)
)
OBSERVATION_AS_TEXT = _record(
    *[(f.name, RESULT_AS_TEXT if f.name == "result" else f.dataType) for f in OBSERVATION]
)
OPERATING_PROPERTY = _record(
    ("_type", _S), ("forProperty", _S), ("value", _D), ("minValue", _D), ("maxValue", _D)
)
GEOMETRY = _record(("_type", _S), ("asWKT", _S))
_SYSTEM_HEAD = [
    ("_id", _S),
    ("_type", _S),
    ("label", _S),
    ("type", _S),
    ("hasGeometry", GEOMETRY),
]
_SYSTEM_TAIL = [
    ("isDeelVan", _S),
    ("exploitant", _S),
    ("locatie", _S),
    ("dataleverancier", _S),
]
SYSTEM = _record(
    *_SYSTEM_HEAD,
    *_SYSTEM_TAIL,
    (
        "hasOperatingRange",
        _record(("_type", _S), ("hasOperatingProperty", T.ArrayType(OPERATING_PROPERTY))),
    ),
)
# Second layout: own identifier record, and the operating property is named by `parameter`.
OPERATING_PARAMETER = _record(
    ("_type", _S), ("parameter", _S), ("value", _D), ("minValue", _D), ("maxValue", _D)
)
SYSTEM_ALT = _record(
    *_SYSTEM_HEAD,
    (
        "alternatieveId",
        _record(("_type", _S), ("dc_type", _S), ("armoscode", _S), ("schemaAgency", _S)),
    ),
    *_SYSTEM_TAIL,
    (
        "hasOperatingRange",
        _record(
            ("_id", _S),
            ("_type", _S),
            ("hasOperatingProperty", T.ArrayType(OPERATING_PARAMETER)),
        ),
    ),
)
# Third layout: conditions at the top level.
CONDITION = _record(("parameter", _S), ("value", _D), ("minValue", _D), ("maxValue", _D))
SYSTEM_NESTED = _record(("_id", _S), ("type", _S), ("parameterconditie", T.ArrayType(CONDITION)))

BAND = _record(
    ("id", _S),
    ("subject", _S),
    ("forProperty", _S),
    ("prefLabel", _S),
    ("definition", _S),
    ("scopeNote", _S),
    ("dc_type", _S),
    ("actie", _S),
    ("value", _D),
    ("minValue", _D),
    ("maxValue", _D),
    ("operatie", _S),
)
BAND_ALT = _record(
    ("_id", _S),
    ("klasse", _S),
    ("parameter", _S),
    ("label", _S),
    ("type", _S),
    ("actie", _S),
    ("value", _D),
    ("minValue", _D),
    ("maxValue", _D),
    ("operatie", _S),
    ("note", _S),
)
NESTED_BAND = _record(
    ("minValue", _D),
    ("maxValue", _D),
    ("operatie", _S),
    ("label", _S),
    ("type", _S),
    ("note", _S),
)
NORM_NESTED = _record(
    ("klasse", _S), ("parameter", _S), ("bandbreedtes", T.ArrayType(NESTED_BAND))
)
CONCEPT = _record(
    ("id", _S),
    ("type", T.ArrayType(_S)),
    ("inScheme", _S),
    ("prefLabel", _S),
    ("broader", _S),
    ("narrower", T.ArrayType(_S)),
    ("dct_type", T.ArrayType(_S)),
    ("applicableUnit", _S),
    ("relevantQuantityKind", _S),
    ("subject", _S),
    ("seeAlso", _S),
    ("definition", _S),
    ("scopeNote", _S),
    ("relevantProperty", _S),
    ("minValue", _D),
    ("maxValue", _D),
    ("operatie", _S),
)
TRIPLE = _record(("s", _S), ("p", _S), ("o", _S), ("o_kind", _S), ("datatype", _S))


def envelope(record: T.StructType) -> T.StructType:
    """A document that holds its records in ``@graph``."""
    return _record(("@context", _S), ("@graph", T.ArrayType(record)))
