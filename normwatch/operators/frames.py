"""Framing: triples regrouped to one nested record per subject.

The graph is read once.  One grouping by subject gathers what any level of the frame needs, combined
before the shuffle: of a single-valued field the least and the greatest value, so its size is fixed;
only fields declared ``many`` gather sets.  The result is written, and each level takes the subjects
it wants from there, those of its type; embedded records are joined to the records that link to
them, and only the links are shuffled for that.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from normwatch.operators.joins import spread_join
from normwatch.operators.triples import RDF_TYPE
from normwatch.session import bucketed

# Names the single-valued fields of a record that had several values.
SEVERAL = "_several"


@dataclass(frozen=True)
class Field:
    """A field of a framed record.

    ``many`` gives an array of all values.  ``kind`` keeps only objects of that ``o_kind``.
    ``embed`` replaces the object by its own record.
    """

    predicate: str
    many: bool = False
    cast: str | None = None
    kind: str | None = None
    embed: Frame | None = None


@dataclass(frozen=True)
class Frame:
    """``type_`` keeps subjects of that type; ``types`` adds the types as ``_type``."""

    fields: Mapping[str, Field] = field(default_factory=dict)
    type_: str | None = None
    types: bool = True


class _Level:
    """The facts that one level of a frame needs of each subject, and the records made from them."""

    def __init__(self, spec: Frame, several: str, number: int):
        if several == "array":
            fields = {name: replace(item, many=True) for name, item in spec.fields.items()}
            spec = replace(spec, fields=fields)
        self.spec, self.several, self.mark = spec, several, f"l{number}_"
        self.predicates = {item.predicate for item in spec.fields.values()}
        if spec.types or spec.type_ is not None:
            self.predicates.add(RDF_TYPE)
        self.inner: dict[str, _Level] = {}
        self.last = number
        for name, item in spec.fields.items():
            if item.embed is not None:
                inner = self.inner[name] = _Level(item.embed, several, self.last + 1)
                self.last = inner.last

    def all_predicates(self) -> set[str]:
        return self.predicates.union(*[inner.all_predicates() for inner in self.inner.values()])

    def facts(self) -> list[Column]:
        """Aggregates over the triples of a subject.  Only sets that are asked for can grow."""
        is_type = F.col("p") == RDF_TYPE
        columns = [F.bool_or(F.col("p").isin(sorted(self.predicates))).alias(f"{self.mark}any")]
        if self.spec.type_ is not None:
            wanted = is_type & (F.col("o") == self.spec.type_) & (F.col("o_kind") == "iri")
            columns.append(F.bool_or(wanted).alias(f"{self.mark}is"))
        if self.spec.types:
            types = F.collect_set(F.when(is_type, F.col("o")))
            columns.append(F.array_sort(types).alias(f"{self.mark}types"))
        for i, item in enumerate(self.spec.fields.values()):
            match = F.col("p") == item.predicate
            if item.kind is not None:
                match = match & (F.col("o_kind") == item.kind)
            found = F.when(match, F.col("o"))
            if item.many:
                columns.append(F.array_sort(F.collect_set(found)).alias(f"{self.mark}set{i}"))
            else:
                columns.append(F.min(found).alias(f"{self.mark}min{i}"))
                columns.append(F.max(found).alias(f"{self.mark}max{i}"))
        for inner in self.inner.values():
            columns += inner.facts()
        return columns

    def records(self, facts: DataFrame) -> DataFrame:
        """The records of this level, with the records they lead to in place of links."""
        chosen = facts.where(F.col(f"{self.mark}any"))
        if self.spec.type_ is not None:
            chosen = chosen.where(F.col(f"{self.mark}is"))
        columns, doubled = [F.col("s").alias("_id")], []
        if self.spec.types:
            columns.append(F.col(f"{self.mark}types").alias("_type"))
        for i, (name, item) in enumerate(self.spec.fields.items()):
            if item.many:
                value = F.col(f"{self.mark}set{i}")
                value = value if item.cast is None else value.cast(f"array<{item.cast}>")
            else:
                value = F.col(f"{self.mark}min{i}")
                differ = value != F.col(f"{self.mark}max{i}")
                if self.several == "error":
                    told = F.raise_error(F.lit(f"several values for {name}; declare it as many"))
                    value = F.when(differ, told).otherwise(value)
                doubled.append(F.when(differ, F.lit(name)))
                value = value if item.cast is None else value.try_cast(item.cast)
            columns.append(value.alias(name))
        if self.several == "report":
            names = F.array_compact(F.array(*doubled)) if doubled else F.array().cast("array<string>")
            columns.append(F.when(F.size(names) > 0, names).alias(SEVERAL))
        records = chosen.select(*columns)
        for name, inner in self.inner.items():
            records = _embedded(records, name, self.spec.fields[name], inner.records(facts))
        return records


def _embedded(records: DataFrame, name: str, item: Field, inner: DataFrame) -> DataFrame:
    """Replace the links in column ``name`` by the records they lead to.

    Records without a link take no part in the join: they would all meet in one task.
    """
    node = F.struct(*inner.columns).alias("node")
    nodes = inner.select(F.col("_id").alias("node_id"), node)
    kind = nodes.schema["node"].dataType
    if not item.many:
        linked = records.where(F.col(name).isNotNull())
        joined = spread_join(linked, nodes, [(name, "node_id")], how="left")
        with_node = joined.withColumn(name, F.col("node")).select(*records.columns)
        bare = records.where(F.col(name).isNull()).withColumn(name, F.lit(None).cast(kind))
        return with_node.unionByName(bare)
    links = records.select(F.col("_id").alias("of"), F.explode(name).alias("link"))
    found = spread_join(links, nodes, [("link", "node_id")])
    sets = found.groupBy("of").agg(F.collect_set("node").alias("found_nodes"))
    joined = spread_join(records, sets, [("_id", "of")], how="left")
    embedded = F.coalesce("found_nodes", F.array().cast(T.ArrayType(kind)))
    return joined.withColumn(name, embedded).select(*records.columns)


def subject_facts(triples: DataFrame, level: _Level) -> DataFrame:
    """One row per subject with what any level needs of it, written.

    The graph is read once and combined before its one shuffle.  Every level is then made from the
    written rows, which are bucketed by subject.
    """
    rows = triples.where(F.col("p").isin(sorted(level.all_predicates())))
    return bucketed(rows.groupBy("s").agg(*level.facts()), "s", "facts")


def frame(triples: DataFrame, spec: Frame, several: str = "report") -> DataFrame:
    """One record per subject: ``_id``, ``_type`` (array) and the fields of the frame.

    With ``spec.type_`` only subjects of that type are kept.  Subjects that have none of the
    predicates of the frame do not appear.  ``several`` says what becomes of several values of a
    single-valued field: ``report`` takes the least and names the field in ``_several`` (else NULL),
    ``array`` makes an array of every field, ``error`` fails.  Links that are NULL or lead nowhere
    embed nothing.  The graph is read and combined when this is called.
    """
    if several not in ("report", "array", "error"):
        raise ValueError("several is report, array or error")
    level = _Level(spec, several, 0)
    return level.records(subject_facts(triples, level))


# Observation records as read, and alarms as constructed from rules.
OBSERVATION_FRAME = Frame(
    type_="sosa:Observation",
    fields={
        "hasFeatureOfInterest": Field("sosa:hasFeatureOfInterest"),
        "observedProperty": Field("sosa:observedProperty"),
        "result": Field(
            "sosa:hasResult",
            embed=Frame(
                types=False,
                fields={
                    "eenheid": Field("http://qudt.org/schema/qudt/unit"),
                    "kwalitatieve_waarde": Field("rdf:value", kind="iri"),
                    "numerieke_waarde": Field("rdf:value", kind="literal", cast="double"),
                }
            ),
        ),
        "resultTime": Field("sosa:resultTime"),
    },
)


def alarm_frame(type_: str | None = "sh:Violation") -> Frame:
    """Alarms of one severity (or of any, with None) with all their results."""
    return Frame(
        type_=type_,
        fields={
            "hasFeatureOfInterest": Field("sosa:hasFeatureOfInterest"),
            "observedProperty": Field("sosa:observedProperty"),
            "phenomenonTime": Field("sosa:phenomenonTime"),
            "wasInformedBy": Field("prov:wasInformedBy"),
            "resultTime": Field("sosa:resultTime"),
            "result": Field(
                "sosa:hasResult",
                many=True,
                embed=Frame(fields={"message": Field("rdf:value")}),
            ),
        },
    )
