"""Records as triples ``(s, p, o, o_kind, datatype)`` and back to text lines.

``o_kind`` is ``iri``, ``bnode`` or ``literal``; ``datatype`` is set for typed literals.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from normwatch.functions import record_key
from normwatch.functions.iris import expand_iri
from normwatch.operators.joins import spread_join
from normwatch.sources.context import ID, PLAIN, Context

RDF_TYPE = "rdf:type"
_TRIPLE = "array<struct<s:string,p:string,o:string,o_kind:string,datatype:string>>"


@dataclass
class _Parts:
    """Triples of a value: known one by one, and as arrays of unknown length."""

    single: list[Column] = field(default_factory=list)
    arrays: list[Column] = field(default_factory=list)

    def add(self, other: _Parts) -> None:
        self.single += other.single
        self.arrays += other.arrays

    def array(self) -> Column:
        single = F.array(*self.single) if self.single else F.array().cast(_TRIPLE)
        return F.concat(single, *self.arrays) if self.arrays else single


@dataclass(frozen=True)
class _Making:
    """What is the same for all values: context, wanted predicates, full or compact names."""

    context: Context
    wanted: Collection[str] | None
    full: bool

    def wants(self, p: str) -> bool:
        return self.wanted is None or p in self.wanted

    def name(self, iri: str | None) -> str | None:
        return self.context.expand(iri) if self.full and iri is not None else iri

    def triple(self, s: Column, p: str, o: Column, kind: Column, datatype: str | None) -> Column:
        return F.struct(
            s.alias("s"),
            F.lit(self.name(p)).alias("p"),
            o.alias("o"),
            kind.alias("o_kind"),
            F.lit(self.name(datatype)).cast("string").alias("datatype"),
        )


def _reference_kind(o: Column) -> Column:
    return F.when(o.startswith("_:"), F.lit("bnode")).otherwise(F.lit("iri"))


def _native_datatype(kind: T.DataType) -> str | None:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "xsd:double"
    if isinstance(kind, T.IntegralType):
        return "xsd:integer"
    if isinstance(kind, T.BooleanType):
        return "xsd:boolean"
    return None


def _term(name: str, context: Context) -> tuple[str, str] | None:
    if name == "_type":
        return RDF_TYPE, ID
    if name in context.terms:
        return context.terms[name]
    return (name, PLAIN) if ":" in name else None


def _value_triples(
    making: _Making,
    subject: Column,
    p: str,
    how: str,
    value: Column,
    kind: T.DataType,
    node: Column,
) -> _Parts:
    """The triples one field value gives; ``node`` names a nested record without id."""
    if isinstance(kind, T.ArrayType):

        def of_item(item: Column, i: Column) -> Column:
            inner = F.concat(node, F.lit("-"), i.cast("string"))
            return _value_triples(making, subject, p, how, item, kind.elementType, inner).array()

        items = F.flatten(F.transform(value, of_item))
        return _Parts(arrays=[F.coalesce(items, F.array().cast(_TRIPLE))])
    if isinstance(kind, T.StructType):
        own = value["_id"] if "_id" in kind.names else F.lit(None).cast("string")
        nested = F.coalesce(own, node)
        parts = _record_triples(making, nested, value, kind, node)
        if making.wants(p):
            present = F.when(value.isNotNull(), nested)
            parts.single.append(making.triple(subject, p, present, _reference_kind(nested), None))
        return parts
    if not making.wants(p):
        return _Parts()
    text = value.cast("string")
    if how == ID:
        return _Parts([making.triple(subject, p, text, _reference_kind(text), None)])
    datatype = _native_datatype(kind) if how == PLAIN else how
    return _Parts([making.triple(subject, p, text, F.lit("literal"), datatype)])


def _record_triples(
    making: _Making, subject: Column, record: Column | None, schema: T.StructType, node: Column
) -> _Parts:
    parts = _Parts()
    for item in schema:
        term = _term(item.name, making.context)
        if item.name == "_id" or term is None:
            continue
        value = F.col(f"`{item.name}`") if record is None else record[item.name]
        inner = F.concat(node, F.lit(f"-{item.name}"))
        parts.add(_value_triples(making, subject, *term, value, item.dataType, inner))
    return parts


def to_triples(
    records: DataFrame,
    context: Context,
    node_key: Sequence[str] | None = None,
    predicates: Collection[str] | None = None,
    full_terms: bool = False,
) -> DataFrame:
    """All triples of nested records; fields the context has no term for are left out.

    A nested record without ``_id`` gets a node name made from the values of ``node_key`` (default:
    all columns) of its record, so it is the same on every run.  With ``predicates`` only their
    triples are made.  ``full_terms`` writes predicates and datatypes as full IRIs, which leaves
    only subjects and objects to :func:`expand_iris`.  Rows are expanded in place, nothing is
    shuffled.
    """
    identity = record_key(*(node_key or records.columns))
    keyed = records.withColumn("node_key_", F.concat(F.lit("_:"), identity))
    node = F.col("node_key_")
    subject = F.coalesce(F.col("_id"), node) if "_id" in records.columns else node
    making = _Making(context, predicates, full_terms)
    parts = _record_triples(making, subject, None, records.schema, node)
    rows = keyed.select(F.explode(parts.array()).alias("t")).select("t.*")
    return rows.where(F.col("o").isNotNull())


def expand_iris(
    triples: DataFrame,
    prefixes: Mapping[str, str],
    columns: Sequence[str] = ("s", "p", "o", "datatype"),
) -> DataFrame:
    """Compact IRIs in full, by a lookup of the prefix; literals and unknown prefixes stay.

    The prefixes are a configuration held in the driver; they become a literal map in the
    expressions, so nothing is joined.
    """
    full = {name: expand_iri(F.col(name), prefixes) for name in columns}
    if "o" in full:
        full["o"] = F.when(F.col("o_kind") == "iri", full["o"]).otherwise(F.col("o"))
    return triples.withColumns(full)


def union_graphs(*graphs: DataFrame) -> DataFrame:
    """Union of graphs as sets: equal triples collapse (before the shuffle where they can)."""
    return reduce(DataFrame.unionByName, graphs).dropDuplicates()


def subjects_of(triples: DataFrame, predicate: str, value: str | None = None) -> DataFrame:
    """Distinct subjects that have a property, or have it with the given value."""
    wanted = F.col("p") == predicate
    if value is not None:
        wanted = wanted & (F.col("o") == value)
    return triples.where(wanted).select("s").distinct()


def path_values(triples: DataFrame, path: Sequence[str]) -> DataFrame:
    """``(s, o, o_kind, datatype)`` reached from each subject along a path of predicates.

    Only triples of the predicates on the path take part.  A side that turns out small or skewed at
    run time is broadcast or split by the adaptive planner.
    """

    def step(predicate: str) -> DataFrame:
        return triples.where(F.col("p") == predicate).select("s", "o", "o_kind", "datatype")

    reached = step(path[0])
    for predicate in path[1:]:
        start = reached.where(F.col("o_kind") != "literal").select("s", F.col("o").alias("via"))
        onward = step(predicate).withColumnRenamed("s", "via_s")
        joined = spread_join(start, onward, [("via", "via_s")])
        reached = joined.select("s", "o", "o_kind", "datatype")
    return reached


# Characters that the grammar keeps out of IRIs, besides the control characters.
_NOT_IN_IRI = ' <>"{}|^`\\\\'


def _nt_iri(value: Column) -> Column:
    """An IRI in angle brackets; what the grammar forbids is written as an escape."""
    forbidden = "".join([*map(chr, range(0x20)), *_NOT_IN_IRI])
    escaped = F.replace(value, F.lit("\\"), F.lit("\\u005C"))
    for character in forbidden:
        if character != "\\":
            escaped = F.replace(escaped, F.lit(character), F.lit(f"\\u{ord(character):04X}"))
    clean = ~F.rlike(value, F.lit(r'[\x00-\x20<>"{}|^`\\]'))
    return F.concat(F.lit("<"), F.when(clean, value).otherwise(escaped), F.lit(">"))


def _nt_term(value: Column, kind: Column) -> Column:
    return F.when(kind == "bnode", value).otherwise(_nt_iri(value))


def _nt_literal(value: Column, datatype: Column) -> Column:
    escaped = value
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(written))
    suffix = F.coalesce(F.concat(F.lit("^^"), _nt_iri(datatype)), F.lit(""))
    return F.concat(F.lit('"'), escaped, F.lit('"'), suffix)


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One N-Triples statement per triple, in a column ``value``."""
    o, kind = F.col("o"), F.col("o_kind")
    object_ = F.when(kind == "literal", _nt_literal(o, F.col("datatype"))).otherwise(
        _nt_term(o, kind)
    )
    subject = _nt_term(F.col("s"), _reference_kind(F.col("s")))
    predicate = _nt_iri(F.col("p"))
    return triples.select(F.concat_ws(" ", subject, predicate, object_, F.lit(".")).alias("value"))
