import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from samples import OBSERVATIONS, PREFIXES, observations

from normwatch import schemas
from normwatch.operators.frames import OBSERVATION_FRAME, Field, Frame, frame
from normwatch.operators.triples import (
    expand_iris,
    ntriples_lines,
    path_values,
    subjects_of,
    to_triples,
    union_graphs,
)
from normwatch.sinks import write_ntriples
from normwatch.sources import STANDARD_CONTEXT, Context, read_context


def flat(df):
    return Counter(
        tuple(row)
        for row in df.select(
            "_id",
            "hasFeatureOfInterest",
            "observedProperty",
            "result.eenheid",
            "result.kwalitatieve_waarde",
            "result.numerieke_waarde",
            "resultTime",
        ).collect()
    )


def one_day(spark):
    """Observations whose ids do not repeat."""
    return observations(spark).where("resultTime LIKE '2025-04-05%'")


def test_frame_undoes_to_triples(spark):
    rows = one_day(spark)
    assert flat(frame(to_triples(rows, STANDARD_CONTEXT), OBSERVATION_FRAME)) == flat(rows)


def test_one_id_at_two_times_is_not_silently_reduced(spark):
    triples = to_triples(observations(spark), STANDARD_CONTEXT)
    with pytest.raises(Exception, match="several values"):
        frame(triples, OBSERVATION_FRAME, several="error").collect()
    told = frame(triples, OBSERVATION_FRAME).where("_id = 'observation:24'").first()
    assert told["_several"] == ["result", "resultTime"]
    every = frame(triples, OBSERVATION_FRAME, several="array").where("_id = 'observation:24'").first()
    assert len(every["result"]) == 2 and told["resultTime"] == min(every["resultTime"])
    repeated = {i for i, n in Counter(o["_id"] for o in OBSERVATIONS).items() if n > 1}
    marked = frame(triples, OBSERVATION_FRAME).where("_several is not null")
    assert {row["_id"] for row in marked.collect()} == repeated
    times = Frame({"resultTime": Field("sosa:resultTime", many=True)}, "sosa:Observation")
    row = frame(triples, times).where("_id = 'observation:24'").first()
    assert len(row["resultTime"]) == 2


def test_levels_share_one_read_and_one_grouping(spark):
    triples = to_triples(one_day(spark), STANDARD_CONTEXT)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        framed = frame(triples, OBSERVATION_FRAME)
        plan = framed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)
    # The graph was read before; of the written facts only the links are shuffled.
    assert "explode" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert framed.count() == one_day(spark).count()


def test_records_without_a_link_embed_nothing(spark):
    rows = [
        ("a", "rdf:type", "T", "iri", None), ("a", "has", "x", "iri", None),
        ("b", "rdf:type", "T", "iri", None), ("c", "rdf:type", "T", "iri", None),
        ("c", "has", "nowhere", "iri", None), ("x", "v", "1", "literal", None),
        # Several values of a level count only where its records are made.
        ("x", "has", "p", "iri", None), ("x", "has", "q", "iri", None),
    ]
    triples = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, datatype string")
    inner = Frame({"v": Field("v")}, types=False)
    for several in ("report", "error"):
        framed = frame(triples, Frame({"has": Field("has", embed=inner)}, "T"), several)
        found = {r["_id"]: r["has"] and r["has"]["v"] for r in framed.collect()}
        assert found == {"a": "1", "b": None, "c": None}


def test_many_embedded_records(spark):
    rows = [
        ("a", "rdf:type", "T", "iri", None),
        ("a", "has", "_:1", "bnode", None),
        ("a", "has", "_:2", "bnode", None),
        ("a", "has", "gone", "iri", None),
        ("_:1", "value", "x", "literal", None),
        ("_:2", "value", "y", "literal", None),
        ("_:2", "value", "y", "literal", None),
        ("b", "rdf:type", "T", "iri", None),
        ("c", "has", "_:1", "bnode", None),
    ]
    triples = spark.createDataFrame(rows, schemas.TRIPLE)
    inner = Frame({"value": Field("value")})
    framed = frame(triples, Frame({"has": Field("has", many=True, embed=inner)}, "T"))
    got = {row["_id"]: sorted(n["value"] for n in row["has"]) for row in framed.collect()}
    assert got == {"a": ["x", "y"], "b": []}
    every = frame(triples, Frame({"has": Field("has", many=True, embed=inner)}))
    assert {row["_id"] for row in every.collect()} == {"a", "b", "c"}


def test_kinds_of_values(spark):
    schema = T.StructType.fromDDL(
        "_id string, _type array<string>, count long, exact boolean, weight double, other string, "
        "label array<string>, parts array<struct<_id: string, label: string>>"
    )
    parts = [("x:2", "p"), (None, "q")]
    row = ("x:1", ["x:A", "x:B"], 3, True, 1.5, "dropped", ["l1", "l2"], parts)
    context = Context(
        {
            "count": ("x:count", "plain"),
            "exact": ("x:exact", "plain"),
            "weight": ("x:weight", "plain"),
            "label": ("x:label", "plain"),
            "parts": ("x:part", "id"),
        }
    )
    got = {tuple(r) for r in to_triples(spark.createDataFrame([row], schema), context).collect()}
    nodes = {t[2] for t in got if t[3] == "bnode"}
    assert len(nodes) == 1
    node = nodes.pop()
    assert got == {
        ("x:1", "rdf:type", "x:A", "iri", None),
        ("x:1", "rdf:type", "x:B", "iri", None),
        ("x:1", "x:count", "3", "literal", "xsd:integer"),
        ("x:1", "x:exact", "true", "literal", "xsd:boolean"),
        ("x:1", "x:weight", "1.5", "literal", "xsd:double"),
        ("x:1", "x:label", "l1", "literal", None),
        ("x:1", "x:label", "l2", "literal", None),
        ("x:1", "x:part", "x:2", "iri", None),
        ("x:2", "x:label", "p", "literal", None),
        ("x:1", "x:part", node, "bnode", None),
        (node, "x:label", "q", "literal", None),
    }


def test_wanted_predicates_are_the_only_ones_made(spark):
    every = to_triples(observations(spark), STANDARD_CONTEXT)
    wanted = ["sosa:hasResult", "rdf:value"]
    some = to_triples(observations(spark), STANDARD_CONTEXT, predicates=wanted)
    kept = every.where(F.col("p").isin(wanted))
    assert Counter(map(tuple, some.collect())) == Counter(map(tuple, kept.collect()))


def test_full_terms_need_no_lookup(spark):
    context = STANDARD_CONTEXT.merged(Context(prefixes=PREFIXES))
    compact = to_triples(observations(spark), context)
    full = to_triples(observations(spark), context, full_terms=True)
    by_lookup = expand_iris(compact, context.prefixes)
    at_once = expand_iris(full, context.prefixes, columns=("s", "o"))
    assert Counter(map(tuple, at_once.collect())) == Counter(map(tuple, by_lookup.collect()))


def test_record_without_id_is_a_node(spark):
    rows = spark.createDataFrame([(None, "n"), (None, "n")], "_id string, label string")
    triples = to_triples(rows, STANDARD_CONTEXT)
    assert triples.select("s").distinct().count() == 1
    assert union_graphs(triples).count() == 1


def test_paths_and_subjects(spark):
    triples = to_triples(observations(spark), STANDARD_CONTEXT)
    reached = path_values(triples, ["sosa:hasResult", "rdf:value"])
    assert reached.count() == len(OBSERVATIONS)
    assert subjects_of(triples, "sosa:observedProperty", "prop:ph").count() == 1


def test_lines(spark, tmp_path):
    rows = [
        ("ex:a", "ex:p", 'say "hi"\\\nnow', "literal", None),
        ("ex:a", "ex:p", "7.7", "literal", "xsd:decimal"),
        ("_:n", "ex:p", "ex:b", "iri", None),
        ("http://h/x", "ex:p", "_:n", "bnode", None),
        ("ex:a", "ex:p", "ex:not an iri", "literal", None),
    ]
    triples = spark.createDataFrame(rows, schemas.TRIPLE)
    names = {"ex": "http://e/", "xsd": "http://x#"}
    want = {
        r'<http://e/a> <http://e/p> "say \"hi\"\\\nnow" .',
        '<http://e/a> <http://e/p> "7.7"^^<http://x#decimal> .',
        "_:n <http://e/p> <http://e/b> .",
        "<http://h/x> <http://e/p> _:n .",
        '<http://e/a> <http://e/p> "ex:not an iri" .',
    }
    expanded = expand_iris(triples, names)
    assert {row["value"] for row in ntriples_lines(expanded).collect()} == want
    write_ntriples(expanded, str(tmp_path / "nt"))
    assert {row["value"] for row in spark.read.text(str(tmp_path / "nt")).collect()} == want


def test_forbidden_characters_are_escaped(spark):
    rows = [
        ("http://x/a b", "http://x/p", 'q>"<>', "iri", None),
        ("http://x/a\\b", "http://x/{p}", "v", "literal", "http://x/d t"),
    ]
    lines = ntriples_lines(spark.createDataFrame(rows, schemas.TRIPLE)).collect()
    assert {row["value"] for row in lines} == {
        r"<http://x/a\u0020b> <http://x/p> <q\u003E\u0022\u003C\u003E> .",
        r'<http://x/a\u005Cb> <http://x/\u007Bp\u007D> "v"^^<http://x/d\u0020t> .',
    }


def test_node_names_keep_parts_apart(spark):
    rows = spark.createDataFrame([("a|b", None), ("a", "b")], "x string, y string")
    context = Context({"x": ("v:x", "plain"), "y": ("v:y", "plain")})
    assert to_triples(rows, context, ["x", "y"]).select("s").distinct().count() == 2


def test_context_file(spark, tmp_path):
    document = {
        "@context": {
            "_id": {"@id": "@id", "@type": "@id"},
            "graph": "@graph",
            "label": {"@id": "rdfs:label"},
            "about": {"@id": "schema:about", "@type": "@id"},
            "day": {"@id": "dcterms:date", "@type": "xsd:date"},
            "observation": PREFIXES["observation"],
        },
        "graph": [],
    }
    path = tmp_path / "context.json"
    path.write_text(json.dumps(document))
    context = read_context(str(path))
    assert context.terms == {
        "label": ("rdfs:label", "plain"),
        "about": ("schema:about", "id"),
        "day": ("dcterms:date", "xsd:date"),
    }
    assert context.prefixes["observation"] == PREFIXES["observation"]
    assert "graph" not in context.prefixes
    merged = STANDARD_CONTEXT.merged(context)
    assert "sosa" in merged.prefixes and "observation" in merged.prefixes
    assert merged.prefix_table(spark).count() == len(merged.prefixes)
    assert merged.term_table(spark).where("term = 'day'").first()["value_kind"] == "xsd:date"
