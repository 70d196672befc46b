"""Canonical blank nodes against trying all renamings."""

import itertools
import random

import pytest

from normwatch import schemas
from normwatch.operators import canonical as colours
from normwatch.operators.canonical import canonical_graph, canonical_labels, union_loads
from normwatch.operators.triples import to_triples
from normwatch.sources import STANDARD_CONTEXT
from samples import observations


def table(spark, triples):
    return spark.createDataFrame([(*t, None) for t in triples], schemas.TRIPLE).repartition(2)


def canonical(spark, triples):
    return {(r["s"], r["p"], r["o"], r["o_kind"]) for r in canonical_graph(table(spark, triples)).collect()}


def renamed(triples, names):
    def of(x, kind):
        return names.get(x, x) if kind == "bnode" or x.startswith("_:") else x

    return {(names.get(s, s), p, of(o, k), k) for s, p, o, k in triples}


def blanks(triples):
    return sorted({s for s, *_ in triples if s.startswith("_:")} | {o for _, _, o, k in triples if k == "bnode"})


def isomorphic(a, b):
    mine, theirs = blanks(a), blanks(b)
    if len(mine) != len(theirs) or len(a) != len(b):
        return False
    return any(renamed(a, dict(zip(mine, order))) == set(b) for order in itertools.permutations(theirs))


def made(rng, n):
    nodes = [f"_:{i}" for i in range(n)]
    triples = set()
    for _ in range(rng.randint(1, 7)):
        triples.add((rng.choice(nodes), rng.choice("pq"), rng.choice(nodes), "bnode"))
    for _ in range(rng.randint(0, 2)):
        triples.add((rng.choice(nodes), "v", rng.choice("xy"), "literal"))
    if rng.random() < 0.4:
        triples.add(("name", "has", rng.choice(nodes), "bnode"))
    return triples


def test_known_shapes(spark):
    def ring(n, mark):
        return {(f"_:{mark}{i}", "p", f"_:{mark}{(i + 1) % n}", "bnode") for i in range(n)}

    six, threes = canonical(spark, ring(6, "a")), canonical(spark, ring(3, "a") | ring(3, "b"))
    assert six != threes and len(six) == len(threes) == 6
    # Alike within one load, and not merged.
    twins = {("n", "has", "_:a", "bnode"), ("n", "has", "_:b", "bnode"), ("_:a", "v", "1", "literal"), ("_:b", "v", "1", "literal")}
    assert len(canonical(spark, twins)) == 4
    children = canonical(spark, {("_:r", "has", f"_:k{i}", "bnode") for i in range(30)})
    assert children == canonical(spark, {("_:z", "has", f"_:q{i}", "bnode") for i in range(30)})
    assert len(children) == 30
    # A literal or a name that looks like a label stays.
    plain = {("n", "v", "_:a", "literal"), ("_:a", "v", "_:a", "bnode")}
    assert ("n", "v", "_:a", "literal") in canonical(spark, plain)


@pytest.mark.parametrize("seed", range(2))
def test_graphs_are_equal_if_some_renaming_makes_them_so(spark, seed):
    rng = random.Random(seed)
    a = made(rng, 4)
    names = blanks(a)
    order = names[:]
    rng.shuffle(order)
    same = renamed(a, {x: f"_:new{order.index(x)}" for x in names})
    found = canonical(spark, a)
    assert found == canonical(spark, same) and isomorphic(a, same)
    # What else a graph holds changes no label.
    extra = {("_:other", "p", "_:more", "bnode"), ("_:more", "w", "z", "literal"), ("name2", "has", "_:other", "bnode")}
    assert found <= canonical(spark, same | extra)
    for _ in range(2):
        b = made(rng, 4)
        assert (found == canonical(spark, b)) == isomorphic(a, b)


def test_two_loads_are_one_graph(spark):
    rows = observations(spark)
    one = to_triples(rows, STANDARD_CONTEXT)
    two = to_triples(rows.withColumn("load", rows["_id"]), STANDARD_CONTEXT, ["resultTime", "_id", "observedProperty"])
    nodes = lambda g: {r["s"] for r in g.where("s like '\\_:%'").collect()}
    assert nodes(one).isdisjoint(nodes(two))
    assert union_loads(one, two).count() == one.distinct().count()


def test_no_blank_nodes(spark):
    triples = {("a", "p", "b", "iri"), ("a", "v", "1", "literal")}
    assert canonical(spark, triples) == triples
    assert canonical_graph(table(spark, triples).where("false")).count() == 0


def test_nodes_without_links_are_settled_at_once(spark, monkeypatch):
    ddl = "s string, p string, o string, o_kind string, datatype string"
    rows = [(f"_:{i}", "p:v", str(i // 2), "literal", None) for i in range(6)]
    rows += [(f"n:{i}", "p:r", f"_:{i}", "bnode", None) for i in (0, 1, 4)]
    chain = [("_:x", "p:next", "_:y", "bnode", None), ("_:y", "p:v", "1", "literal", None)]
    written = []
    cut = colours.cut_lineage
    monkeypatch.setattr(colours, "cut_lineage", lambda df: written.append(df) or cut(df))
    alone = {r["node"]: r["label"] for r in canonical_labels(spark.createDataFrame(rows, ddl)).collect()}
    # The triples, those between blank nodes, and the links: no rounds.
    assert len(written) == 3
    assert set(alone) == {f"_:{i}" for i in range(6)} and len(set(alone.values())) == 6
    beside = canonical_labels(spark.createDataFrame(rows + chain, ddl)).collect()
    assert {r["node"]: r["label"] for r in beside if r["node"] in alone} == alone
    assert len({r["label"] for r in beside}) == 8
