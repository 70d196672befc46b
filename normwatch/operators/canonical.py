"""Blank nodes by what is said of them, so that graphs loaded twice are one graph.

The label of a blank node means nothing; loading a document again gives other labels.  Here a node
gets a colour from its triples, then again and again from those of its neighbours, until the colours
of its component tell no more nodes apart.  What is still alike is symmetric and numbered.  A label is
made from the colour, so equal components get equal labels whatever else the graphs hold.

Colours change only along links between blank nodes, so triples with names at the other end are read
once.  A component that has settled takes no further part, and a node without links is settled at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normwatch.operators.joins import spread_join
from normwatch.operators.triples import union_graphs
from normwatch.session import cut_lineage

_TRIPLE = ["s", "p", "o", "o_kind", "datatype"]


def _is_blank(name: str) -> Column:
    return F.startswith(name, F.lit("_:"))


def _line_hashes(*parts: Column) -> list[Column]:
    text = F.to_json(F.array(*[p.cast("string") for p in parts]))
    hashes = []
    for seed in (1, 2):
        hashed = F.xxhash64(F.lit(seed), text)
        hashes.append(F.when(text.isNotNull(), hashed.bitwiseAND(F.lit(0xFFFFFFFF))))
        hashes.append(F.shiftrightunsigned(hashed, 32))
    return hashes


def _line_sums(*parts: Column) -> list[Column]:
    """Sums that hardly ever agree for different sets of lines; combined before a shuffle."""
    sums = [F.sum(h) for h in _line_hashes(*parts)]
    return [F.coalesce(s, F.lit(0)).alias(f"sum{i}") for i, s in enumerate(sums)]


_SUMS = [f"sum{i}" for i in range(4)]


def _digest(*parts: Column | str) -> Column:
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.to_json(F.array(*[c.cast("string") for c in columns])).cast("binary"))


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp): the least node that is reached over links (node, other), by taking the least
    label around and then the label of the label."""
    current = cut_lineage(nodes.select("node", F.col("node").alias("comp")))
    while True:
        theirs = current.select(F.col("node").alias("t_node"), F.col("comp").alias("near"))
        met = spread_join(links.select("node", "other"), theirs, [("other", "t_node")])
        least = met.groupBy(F.col("node").alias("l_node")).agg(F.min("near").alias("least"))
        moved = spread_join(current, least, [("node", "l_node")], how="left")
        moved = cut_lineage(
            moved.select("node", F.col("comp").alias("was"), F.least("comp", "least").alias("comp"))
        )
        ahead = moved.select(F.col("node").alias("a_node"), F.col("comp").alias("further"))
        jumped = spread_join(moved, ahead, [("comp", "a_node")])
        jumped = cut_lineage(jumped.select("node", "was", F.least("comp", "further").alias("comp")))
        current = jumped.select("node", "comp")
        if jumped.where("was <> comp").isEmpty():
            return current


def _recoloured(state: DataFrame, links: DataFrame) -> DataFrame:
    """``state`` (comp, node, colour) with each colour made anew from those around."""
    theirs = state.select(F.col("node").alias("t_node"), F.col("colour").alias("seen"))
    met = spread_join(links, theirs, [("other", "t_node")])
    sums = met.groupBy(F.col("node").alias("m_node")).agg(
        *_line_sums(F.col("line"), F.col("seen")), F.count("*").alias("lines")
    )
    joined = spread_join(state, sums, [("node", "m_node")], how="left")
    return joined.select("comp", "node", _digest("colour", "lines", *_SUMS).alias("colour"))


def _counted(state: DataFrame) -> DataFrame:
    return state.groupBy(F.col("comp").alias("c_comp")).agg(
        F.countDistinct("colour").alias("colours"), F.count("*").alias("size")
    )


def _settled(state: DataFrame, links: DataFrame) -> DataFrame:
    """``state`` recoloured until no component tells more nodes apart; those that do not any more
    keep the colours they had."""
    active, done = state, []
    before = cut_lineage(_counted(active))
    while not before.isEmpty():
        mine = spread_join(links, active.select(F.col("node").alias("a_node")), [("node", "a_node")], "left_semi")
        fresh = cut_lineage(_recoloured(active, mine))
        after = _counted(fresh).select(F.col("c_comp").alias("d_comp"), F.col("colours").alias("now"), "size")
        both = spread_join(before.drop("size"), after, [("c_comp", "d_comp")])
        grown = cut_lineage(
            both.where("now > colours").select("c_comp", F.col("now").alias("colours"), "size")
        )
        kept = grown.select(F.col("c_comp").alias("k_comp"))
        done.append(cut_lineage(spread_join(active, kept, [("comp", "k_comp")], "left_anti")))
        # Nothing is left to tell apart where every node has its own colour.
        whole = grown.where("colours = size").select(F.col("c_comp").alias("w_comp"))
        done.append(cut_lineage(spread_join(fresh, whole, [("comp", "w_comp")], "left_semi")))
        before = cut_lineage(grown.where("colours < size"))
        open_ = before.select(F.col("c_comp").alias("o_comp"))
        active = cut_lineage(spread_join(fresh, open_, [("comp", "o_comp")], "left_semi"))
    return reduce(DataFrame.unionByName, done) if done else state


def _told_apart(alike: DataFrame, links: DataFrame) -> DataFrame:
    """``alike`` (nodes of components where some share a colour) with some of these told apart.

    Nodes with the very same neighbours are interchangeable and numbered at once.  Where there are
    none, one node of the least shared colour is marked; symmetry makes it no matter which.
    """
    mine = spread_join(links, alike.select(F.col("node").alias("a_node")), [("node", "a_node")], "left_semi")
    around = mine.groupBy(F.col("node").alias("x_node")).agg(*_line_sums(F.col("line"), F.col("other")))
    rows = spread_join(alike, around, [("node", "x_node")], how="left").drop("x_node")
    rows = rows.withColumn("around", _digest(*_SUMS)).drop(*_SUMS)
    twins = Window.partitionBy("comp", "colour", "around")
    shared = Window.partitionBy("comp", "colour")
    rows = rows.withColumns(
        {
            "twin": F.row_number().over(twins.orderBy("node")),
            "twins": F.count("*").over(twins),
            "sharing": F.count("*").over(shared),
        }
    )
    rows = cut_lineage(rows)
    some = rows.groupBy(F.col("comp").alias("s_comp")).agg(
        F.max("twins").alias("most_twins"),
        F.min(F.when(F.col("sharing") > 1, F.struct("colour", "node"))).alias("marked"),
    )
    joined = spread_join(rows, some, [("comp", "s_comp")])
    numbered = F.when(F.col("twins") > 1, _digest("colour", "twin")).otherwise(F.col("colour"))
    marked = F.when(F.col("node") == F.col("marked.node"), _digest("colour", F.lit("marked")))
    colour = F.when(F.col("most_twins") > 1, numbered).otherwise(F.coalesce(marked, F.col("colour")))
    return joined.select("comp", "node", colour.alias("colour"))


def canonical_labels(triples: DataFrame) -> DataFrame:
    """(node, label) for every blank node: equal graphs give equal labels, whatever the old ones.

    Components that are copies of each other are numbered, so they are not merged.  Components whose
    nodes colours cannot tell apart although they are not symmetric (regular ones, of eight nodes
    and more) keep labels that depend on the old ones.
    """
    graph, between = _written(triples)
    return _labels(graph, between)


def _written(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The triples, each once, and those of them that have blank nodes at both ends."""
    graph = cut_lineage(triples.select(*_TRIPLE).distinct())
    return graph, cut_lineage(graph.where(_is_blank("s") & (F.col("o_kind") == "bnode")))


def _labels(graph: DataFrame, between: DataFrame) -> DataFrame:
    subject, object_ = _is_blank("s"), F.col("o_kind") == "bnode"
    out = F.concat(F.lit("out "), F.col("p"))
    into = F.concat(F.lit("in "), F.col("p"))
    linked = between.where(F.col("s") != F.col("o"))
    links = linked.select(F.col("s").alias("node"), F.col("o").alias("other"), out.alias("line")).union(
        linked.select(F.col("o"), F.col("s"), into)
    )
    links = cut_lineage(links)

    # What is said with names at the other end, and of the node itself.
    fixed = graph.where(subject & ~object_).select(
        F.col("s").alias("node"), out.alias("line"), F.to_json(F.array("o", "o_kind", "datatype")).alias("value")
    )
    fixed = fixed.union(graph.where(~subject & object_).select("o", into, "s"))
    loops = between.where(F.col("s") == F.col("o"))
    fixed = fixed.union(loops.select("s", F.concat(F.lit("loop "), F.col("p")), F.lit("")))
    fixed = fixed.union(links.select("node", F.lit(None).cast("string"), F.lit(None).cast("string")))
    # Lines of links are counted when colours are; here they only name their node.
    # The joins below keep named nodes only; said here, all of them read one exchange.
    said = fixed.where("node is not null").groupBy("node").agg(*_line_sums(F.col("line"), F.col("value")))
    base = said.select("node", _digest(*_SUMS).alias("colour"))
    if links.isEmpty():
        return _labels_alone(base)
    base = cut_lineage(base)
    ends = links.select(F.col("node").alias("e_node"))
    alone = spread_join(base, ends, [("node", "e_node")], "left_anti")
    base = spread_join(base, ends, [("node", "e_node")], "left_semi")
    return _labels_linked(base, links).unionByName(_labels_alone(alone))


def _labels_alone(base: DataFrame) -> DataFrame:
    """Labels of nodes without links from their colours.  Few are copies; only those are numbered."""
    sums = [F.coalesce(h, F.lit(0)) for h in _line_hashes(F.col("colour"))]
    kinds = base.withColumn("kind", F.unhex(_digest(F.lit(1), *sums)))
    again = kinds.groupBy(F.col("kind").alias("a_kind")).agg(F.count("*").alias("n")).where("n > 1")
    copies = spread_join(kinds, again.drop("n"), [("kind", "a_kind")], "left_semi")
    number = F.row_number().over(Window.partitionBy("kind").orderBy("node"))
    copies = copies.select(F.col("node").alias("c_node"), number.alias("copy"))
    numbered = spread_join(kinds, copies, [("node", "c_node")], "left")
    kind, copy = F.lower(F.hex("kind")), F.coalesce("copy", F.lit(1))
    return numbered.select("node", F.concat(F.lit("_:c"), _digest(F.col("colour"), kind, copy)).alias("label"))


def _labels_linked(base: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of nodes that are linked with others."""
    comps = _components(base, links).select(F.col("node").alias("n_node"), "comp")
    state = spread_join(base, comps, [("node", "n_node")]).select("comp", "node", "colour")
    state = cut_lineage(_settled(cut_lineage(state), links))
    finished = []
    while True:
        counts = _counted(state).where("colours < size").select(F.col("c_comp").alias("u_comp"))
        counts = cut_lineage(counts)
        finished.append(spread_join(state, counts, [("comp", "u_comp")], "left_anti"))
        if counts.isEmpty():
            break
        alike = cut_lineage(spread_join(state, counts, [("comp", "u_comp")], "left_semi"))
        state = cut_lineage(_settled(cut_lineage(_told_apart(alike, links)), links))
    coloured = cut_lineage(reduce(DataFrame.unionByName, finished))

    # Components that are copies of each other.
    kinds = coloured.groupBy(F.col("comp").alias("k_comp")).agg(
        *_line_sums(F.col("colour")), F.count("*").alias("size")
    )
    kinds = kinds.select("k_comp", _digest("size", *_SUMS).alias("kind"))
    copy = F.row_number().over(Window.partitionBy("kind").orderBy("k_comp")).alias("copy")
    kinds = kinds.select("k_comp", "kind", copy)
    labelled = spread_join(coloured, kinds, [("comp", "k_comp")])
    label = F.concat(F.lit("_:c"), _digest("colour", "kind", "copy"))
    return labelled.select("node", label.alias("label"))


def canonical_graph(triples: DataFrame) -> DataFrame:
    """The triples, each once, with canonical labels of blank nodes."""
    graph, between = _written(triples)
    labels = _labels(graph, between).select(F.col("node").alias("b_node"), F.col("label").alias("b_label"))
    blank, object_ = _is_blank("s"), F.col("o_kind") == "bnode"
    # Only triples with blank nodes take part in joins, those with one of them in one.
    one = graph.where(blank != object_).withColumn("named", F.when(blank, F.col("s")).otherwise(F.col("o")))
    one = spread_join(one, labels, [("named", "b_node")])
    ends = {"s": F.when(blank, F.col("b_label")).otherwise(F.col("s"))}
    ends["o"] = F.when(blank, F.col("o")).otherwise(F.col("b_label"))
    rows = graph.where(~blank & ~object_).unionByName(one.withColumns(ends).select(*_TRIPLE))
    if between.isEmpty():
        return rows
    for name in ("s", "o"):
        between = spread_join(between, labels, [(name, "b_node")])
        between = between.withColumn(name, F.col("b_label")).select(*_TRIPLE)
    return rows.unionByName(between)


def union_loads(*graphs: DataFrame) -> DataFrame:
    """The union of graphs as sets, of which blank nodes that are described alike are the same."""
    return union_graphs(*[canonical_graph(graph) for graph in graphs])
