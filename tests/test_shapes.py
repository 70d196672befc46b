"""Validation of graphs against a walk along the paths of every subject."""

import random
from collections import defaultdict
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from normwatch.operators.rules import Rule, validate
from normwatch.operators import shapes
from normwatch.operators.shapes import Shape, shapes_of, validate_graph
from normwatch.operators.triples import to_triples
from normwatch.plans import testviews as tv
from samples import observations

DDL = "s string, p string, o string, o_kind string, datatype string"


def graph_of(spark, triples):
    rows = [(s, p, o, kind, None) for s, p, o, kind in triples]
    return spark.createDataFrame(rows, DDL).repartition(3)


def walk(triples, s, path):
    """The set of (value, kind) reached."""
    ends = {(s, "iri")}
    for p in path:
        ends = {(o, k) for at, kind in ends if kind != "literal" for s_, p_, o, k in triples if s_ == at and p_ == p}
    return ends


def number(text):
    try:
        return Decimal(text)
    except InvalidOperation:
        return None


def brute(triples, shapes):
    rows = set()
    subjects = {s for s, *_ in triples}
    for shape in shapes:
        for s in subjects:
            had = walk(triples, s, (shape.target_predicate,))
            if not any(shape.target in (None, o) for o, _ in had):
                continue
            values = walk(triples, s, shape.path)
            wrong = []
            if shape.kind == "has_value":
                wrong = [] if any(o == shape.operand for o, _ in values) else [None]
            elif shape.kind == "count":
                least, most = int(shape.lo or 0), float(shape.hi or "inf")
                wrong = [] if least <= len(values) <= most else [None]
            elif shape.kind == "instance":
                for o, kind in values:
                    classes = walk(triples, o, ("rdf:type",)) if kind != "literal" else set()
                    if all(c != shape.operand for c, _ in classes):
                        wrong.append(o)
            elif shape.kind == "less_than":
                others = [o for o, _ in walk(triples, s, shape.other)]
                for o, _ in values:
                    mine = number(o)
                    for other in others:
                        theirs = number(other)
                        if mine is None or theirs is None or not mine < theirs:
                            wrong.append(o)
            else:
                for o, _ in values:
                    n = number(o)
                    if shape.kind == "decimal" and n is None:
                        wrong.append(o)
                    if shape.kind == "min_exclusive" and (n is None or not n > Decimal(shape.lo)):
                        wrong.append(o)
                    if shape.kind == "match" and n is not None and Decimal(shape.lo) < n <= Decimal(shape.hi):
                        wrong.append(o)
            rows |= {(s, shape.rule_id, o) for o in wrong}
    return sorted(rows, key=str)


def shape(rule_id, kind, path, target=None, predicate="kind", **more):
    return Shape(rule_id, "sh:Info", f"message {rule_id}", kind, path, predicate, target, **more)


SHAPES = [
    shape("none", "none", ("v",)),
    shape("num", "decimal", ("part", "v")),
    shape("above", "min_exclusive", ("part", "v"), "a", lo="2.5"),
    shape("band", "match", ("v",), "b", lo="1", hi="3", hi_inclusive=True),
    shape("one", "has_value", ("part", "unit"), "a", operand="u1"),
    shape("few", "count", ("part",), "b", lo="1", hi="2"),
    shape("any", "count", ("part", "part"), lo="1"),
    shape("most", "count", ("v",), predicate="unit", hi="1"),
    shape("less", "less_than", ("v",), other=("part", "v")),
    shape("less2", "less_than", ("part", "v"), "a", other=("w",)),
    shape("is", "instance", ("part",), operand="Good"),
    shape("is2", "instance", ("v",), "b", operand="Good"),
]


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs_against_a_walk(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(25)]
    triples = set()
    for s in nodes:
        for _ in range(rng.randint(0, 2)):
            triples.add((s, "kind", rng.choice("abc"), "iri"))
        for _ in range(rng.randint(0, 3)):
            triples.add((s, "part", rng.choice(nodes), "iri"))
        for p in ("v", "w"):
            for _ in range(rng.randint(0, 3)):
                text = rng.choice(["0.5", "1", "2.5", "3", "3.00", "7", "1e2", "text", ""])
                triples.add((s, p, text, "literal"))
        if rng.random() < 0.5:
            triples.add((s, "unit", rng.choice(["u1", "u2"]), "iri"))
        if rng.random() < 0.4:
            triples.add((s, "rdf:type", rng.choice(["Good", "Bad"]), "iri"))
    # A literal that spells the name of a node reaches nothing.
    triples |= {("n0", "part", "n1", "literal"), ("n0", "v", "n2", "literal"), ("n1", "v", "n3", "iri")}
    triples = sorted(triples)
    # A graph is a set: repeated triples change nothing.
    found = validate_graph(graph_of(spark, triples + triples[::3]), SHAPES, {})
    got = sorted(((r["focusNode"], r["rule"], r["value"]) for r in found.collect()), key=str)
    assert got == brute(triples, SHAPES)
    assert len(got) > 20


def test_moments_compare_with_moments_only(spark):
    rows = [
        ("a", "from", "2025-04-06T10:00:00Z"), ("a", "to", "2025-04-06T13:00:00+02:00"),
        ("a", "to", "2025-04-07T00:00:00Z"),
        ("b", "from", "2025-04-06T12:00:00Z"), ("b", "to", "2025-04-06T13:00:00+02:00"),
        ("c", "from", "2025-04-06T10:00:00Z"), ("c", "to", "no moment"),
        ("d", "from", "5"), ("d", "to", "2025-04-06T10:00:00Z"),
        ("e", "from", "2025-04-06T10:00:00Z"),
        ("f", "to", "2025-04-06T10:00:00Z"),
    ]
    triples = [(s, p, o, "literal") for s, p, o in rows]
    rule = [shape("t", "less_than", ("from",), predicate="from", other=("to",))]
    found = validate_graph(graph_of(spark, triples), rule, {}).collect()
    assert sorted(r["focusNode"] for r in found) == ["b", "c", "d"]


def test_numbers_keep_their_digits_and_range(spark):
    rows = [
        ("a", "v", "7.50000000001"), ("a", "w", "7.50000000002"),
        ("b", "v", "7.50000000002"), ("b", "w", "7.50000000001"), ("b", "w", "1e30"),
        ("c", "v", "1e30"), ("c", "w", "1e31"), ("c", "w", "9"),
        ("d", "v", "5"), ("d", "w", "1e31"), ("d", "w", "9"),
    ]
    triples = [(s, p, o, "literal") for s, p, o in rows]
    rule = [shape("t", "less_than", ("v",), predicate="v", other=("w",))]
    found = validate_graph(graph_of(spark, triples), rule, {}).collect()
    assert sorted((r["focusNode"], r["value"]) for r in found) == [("b", "7.50000000002"), ("c", "1e30")]


def test_rules_on_triples_report_what_rules_on_records_do(spark):
    rules = [
        Rule("info", "sh:Info", "observed"),
        Rule("low", "sh:Violation", "low", "match", "prop:irrigation", hi="500", hi_inclusive=True),
        Rule("num", "sh:Warning", "number", "decimal", None, "status"),
        Rule("unit", "sh:Info", "unit", "has_value", "prop:ph", "unit", operand="unit:PH"),
    ]
    rows = observations(spark).dropDuplicates(["_id"])
    want = validate(rows, rules)
    graph = to_triples(rows, tv.CONTEXT, tv.NODE_KEY)
    got = validate_graph(graph, shapes_of(rules)).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 0


def test_carried_columns_and_empty_inputs(spark):
    triples = [
        ("a", "kind", "x", "iri"), ("a", "v", "t", "literal"), ("a", "tag", "2", "iri"),
        ("a", "tag", "1", "iri"), ("b", "kind", "x", "iri"), ("b", "v", "t", "literal"),
    ]
    shapes = [shape("num", "decimal", ("v",))]
    found = validate_graph(graph_of(spark, triples), shapes, {"tag": ("tag",)})
    assert sorted((r["focusNode"], r["tag"]) for r in found.collect()) == [("a", "1"), ("b", None)]
    assert validate_graph(graph_of(spark, triples).where("false"), SHAPES, {}).count() == 0
    bare = validate_graph(graph_of(spark, triples), [SHAPES[0]], {"tag": ("tag",)})
    assert bare.count() == 0 and bare.columns == found.columns


def test_wrong_shapes_are_refused():
    with pytest.raises(ValueError):
        shape("x", "odd", ("v",))
    with pytest.raises(ValueError):
        shape("x", "less_than", ("v",))
    with pytest.raises(ValueError):
        shape("x", "count", ())
    with pytest.raises(ValueError):
        shapes_of([Rule("x", "sh:Info", "m", "decimal", None, "nowhere")])


def test_numbers_are_read_where_limits_are_compared_only(spark):
    rows = [(f"n:{i}", p, o, k, None) for i in range(3) for p, o, k in (
        ("p:is", "k", "iri"), ("p:size", str(i), "literal"), ("p:code", str(i), "literal"))]
    graph = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, datatype string")
    some = [
        shapes.Shape("large", "sh:Info", "above 1", "min_exclusive", ("p:size",), "p:is", lo="1"),
        shapes.Shape("below", "sh:Info", "below size", "less_than", ("p:code",), "p:is", other=("p:size",)),
    ]
    compiled = shapes._Compiled(graph, some, {})
    read = compiled.reached.where("number is not null").select("at").distinct().collect()
    assert [r["at"] for r in read] == [compiled.at[("p:size",)]]
    found = {(r["focusNode"], r["rule"], r["value"]) for r in shapes.validate_graph(graph, some, {}).collect()}
    assert found == {(f"n:{i}", "below", str(i)) for i in range(3)} | {(f"n:{i}", "large", str(i)) for i in range(2)}
