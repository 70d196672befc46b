"""Term contexts: what a field name or a prefix stands for.

A context is a small configuration file; it is read in the driver.  Documents that carry their own
namespaces bring them in their ``@context``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from normwatch.session import literal_table

ID = "id"
PLAIN = "plain"


@dataclass(frozen=True)
class Context:
    """``terms`` maps a field name to (IRI, kind), ``prefixes`` a prefix to its namespace.

    The kind is ``id`` for references, ``plain`` for untyped values, else a datatype IRI.
    """

    terms: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    prefixes: Mapping[str, str] = field(default_factory=dict)

    def merged(self, other: Context) -> Context:
        """Both contexts; ``other`` wins."""
        return Context({**self.terms, **other.terms}, {**self.prefixes, **other.prefixes})

    def expand(self, iri: str) -> str:
        """The full form of a compact IRI."""
        prefix, colon, rest = iri.partition(":")
        return self.prefixes[prefix] + rest if colon and prefix in self.prefixes else iri

    def term_table(self, spark: SparkSession) -> DataFrame:
        """``(term, iri, value_kind)``."""
        rows = [(term, iri, kind) for term, (iri, kind) in self.terms.items()]
        return literal_table(spark, rows, "term string, iri string, value_kind string")

    def prefix_table(self, spark: SparkSession) -> DataFrame:
        """``(prefix, namespace)``."""
        rows = list(self.prefixes.items())
        return literal_table(spark, rows, "prefix string, namespace string")


def context_from(definitions: Mapping) -> Context:
    """Context from the ``@context`` object of a document: texts are prefixes, objects are terms."""
    terms, prefixes = {}, {}
    for name, definition in definitions.items():
        if isinstance(definition, str):
            # Other names for keywords are not prefixes.
            if not definition.startswith("@"):
                prefixes[name] = definition
        elif definition and "@id" in definition:
            kind = definition.get("@type", PLAIN)
            terms[name] = (definition["@id"], ID if kind == "@id" else kind)
    terms = {name: term for name, term in terms.items() if not term[0].startswith("@")}
    return Context(terms, prefixes)


def read_context(path: str) -> Context:
    """Context from a JSON file."""
    with open(path, encoding="utf-8") as file:
        document = json.load(file)
    return context_from(document.get("@context", document))


# Terms of the observation records and the public vocabularies they refer to.
STANDARD_CONTEXT = Context(
    terms={
        "label": ("rdfs:label", PLAIN),
        "type": ("dcterms:type", ID),
        "dc_type": ("dc:type", PLAIN),
        "subject": ("dcterms:subject", ID),
        "phenomenonTime": ("sosa:phenomenonTime", "xsd:dateTime"),
        "resultTime": ("sosa:resultTime", "xsd:dateTime"),
        "result": ("sosa:hasResult", ID),
        "hasFeatureOfInterest": ("sosa:hasFeatureOfInterest", ID),
        "hasGeometry": ("gsp:hasGeometry", ID),
        "asWKT": ("gsp:asWKT", "gsp:wktLiteral"),
        "locatie": ("locn:location", ID),
        "hasProperty": ("ssn:hasProperty", ID),
        "hasResult": ("sosa:hasResult", ID),
        "eenheid": ("http://qudt.org/schema/qudt/unit", ID),
        "numerieke_waarde": ("rdf:value", "xsd:decimal"),
        "kwalitatieve_waarde": ("rdf:value", ID),
        "boolean_value": ("rdf:value", "xsd:boolean"),
        "integer_value": ("rdf:value", "xsd:integer"),
        "seeAlso": ("rdfs:seeAlso", ID),
        "observedProperty": ("sosa:observedProperty", ID),
        "datum": ("dcterms:date", "xsd:date"),
        "isDeelVan": ("dcterms:isPartOf", ID),
        "wasInformedBy": ("prov:wasInformedBy", ID),
        # Plain text of a constructed result; the first file layout has no term for it.
        "message": ("rdf:value", PLAIN),
    },
    prefixes={
        "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
        "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
        "dcterms": "http://purl.org/dc/terms/",
        "dc": "http://purl.org/dc/elements/1.1/",
        "gsp": "http://www.opengis.net/ont/geosparql#",
        "locn": "http://www.w3.org/ns/locn#",
        "prov": "http://www.w3.org/ns/prov#",
        "qb": "http://purl.org/linked-data/cube#",
        "schema": "https://schema.org/",
        "sh": "http://www.w3.org/ns/shacl#",
        "skos": "http://www.w3.org/2004/02/skos/core#",
        "sosa": "http://www.w3.org/ns/sosa/",
        "ssn": "http://www.w3.org/ns/ssn/",
        "time": "http://www.w3.org/2006/time#",
        "unit": "http://qudt.org/vocab/unit/",
        "xsd": "http://www.w3.org/2001/XMLSchema#",
    },
)
