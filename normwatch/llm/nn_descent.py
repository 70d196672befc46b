"""Approximate nearest neighbours by largest inner product, on a graph made by NN-descent.

Vectors get one more component, so that all have the largest norm; then the largest inner product
is the nearest vector, and the graph is one of nearest neighbours.  It starts from blocks of a few
random-projection trees and is refined by rounds of Spark joins: every node gathers a sample of the
nodes it lists and of those that list it, fetches their vectors, and proposes its neighbours to one
another; each node keeps the nearest.

Queries search the graph greedily: from their entry nodes they follow the best nodes not yet
visited, all queries in step, one join of the open nodes with the graph for each step.  The best
candidates are scored again in double precision on the original vectors.

Equal vectors are one node, so copies neither crowd a neighbour list nor meet in one task; they are
expanded at the end, as far as a query can use them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import in_arrow, sorted_runs, stored, table

NEIGHBOURS = 32
TREES = 12
LEAF = 768
PER_LEAF = 16  # candidates that a node takes from one leaf
SAMPLE = 16  # listed nodes, and listing nodes, that meet at a node in one round
PROPOSALS = 8  # best new pairs of a node in one meeting
REVERSED = 8  # nodes that list a node, followed in a search beside those it lists
# Rounds go on until at most this share of the list entries is new.
FEW = 0.001
BEAM = 256
OPEN = 40  # nodes that a query follows in one step
PIVOTS = 32
# A task is given this many nodes before there are more tasks than cores.
NODES_PER_TASK = 4_000
RESCORED = 48


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    good = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def exact_score(left: Column, right: Column) -> Column:
    """Inner product in double precision, summed from the first component on."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


@dataclass
class Graph:
    """``nodes``: node, vector; ``members``: node, vec_id; ``adjacency``: node, ids, vecs."""

    nodes: DataFrame
    members: DataFrame
    state: DataFrame  # node, vec, ids, scores, fresh
    adjacency: DataFrame
    pivots: list[tuple[int, bytes]]
    tasks: int


def _matrix(blobs: list[bytes]) -> np.ndarray:
    if not blobs:
        return np.zeros((0, 0), np.float32)
    return np.frombuffer(b"".join(blobs), np.float16).reshape(len(blobs), -1).astype(np.float32)


def _top(scores: np.ndarray, most: int) -> np.ndarray:
    """Column numbers of the largest entries of each row, in no order."""
    most = min(most, scores.shape[1])
    return np.argpartition(-scores, most - 1, axis=1)[:, :most]


def _augmented(largest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            x = x / largest
            rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
            full = np.hstack([x, rest[:, None]]).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in full], pa.binary())],
                names=["node", "vec"],
            )

    return run


def _tree_rows(trees: int, bits: int, width: int):
    planes = np.random.default_rng(7).standard_normal((trees, width, bits + 1)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist())
            for tree in range(trees):
                sides = x @ planes[tree]
                code = (sides[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), tree, np.int32)),
                        pa.array(code.astype(np.int64)),
                        pa.array(sides[:, bits]),
                        batch.column(0),
                        batch.column(1),
                    ],
                    names=["tree", "code", "side", "node", "vec"],
                )

    return run


_LISTS = "node long, kind int, vec binary, ids binary, scores binary, fresh binary"


def _lists(node, kind, vec, ids, scores, fresh) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(node, pa.int64()),
            pa.array(np.full(len(node), kind, np.int32)),
            pa.array(vec, pa.binary()),
            pa.array(ids, pa.binary()),
            pa.array(scores, pa.binary()),
            pa.array(fresh, pa.binary()),
        ],
        names=["node", "kind", "vec", "ids", "scores", "fresh"],
    )


def _leaf_neighbours(leaf: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, code = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            node = batch.column(3).to_numpy()
            x = _matrix(batch.column(4).to_pylist())
            cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (code[1:] != code[:-1])) + 1
            for run_rows in np.split(np.arange(len(node)), cuts):
                for rows in np.array_split(run_rows, max(1, -(-len(run_rows) // leaf))):
                    if len(rows) < 2:
                        continue
                    scores = x[rows] @ x[rows].T
                    np.fill_diagonal(scores, -np.inf)
                    best = _top(scores, min(most, len(rows) - 1))
                    found = np.take_along_axis(scores, best, axis=1)
                    yield _lists(
                        node[rows],
                        1,
                        [None] * len(rows),
                        [node[rows[b]].tobytes() for b in best],
                        [s.tobytes() for s in found],
                        [None] * len(rows),
                    )

    return run


def _merge_lists(most: int):
    """Rows sorted by node, the node's own row (kind 0) first, then proposals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, rows in _groups(batches, "node"):
            kinds = rows.column("kind").to_numpy()
            vecs, ids = rows.column("vec").to_pylist(), rows.column("ids").to_pylist()
            scores = rows.column("scores").to_pylist()
            out: list[list] = [[], [], [], [], []]
            for begin, end in nodes:
                if kinds[begin] != 0:
                    continue
                node = rows.column("node")[int(begin)].as_py()
                who = np.frombuffer(b"".join(i or b"" for i in ids[begin:end]), np.int64)
                s = np.frombuffer(b"".join(x or b"" for x in scores[begin:end]), np.float32)
                old = len(ids[begin] or b"") // 8
                # The first of equal ids is the known one.
                who, first = np.unique(who, return_index=True)
                keep = who != node
                who, first = who[keep], first[keep]
                order = np.lexsort((who, -s[first]))[:most]
                out[0].append(node)
                out[1].append(vecs[begin])
                out[2].append(who[order].tobytes())
                out[3].append(s[first[order]].tobytes())
                out[4].append((first[order] >= old).astype(np.uint8).tobytes())
            if out[0]:
                yield _lists(np.array(out[0]), 0, *out[1:])

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str, most: int = 1 << 20):
    """(bounds of the groups, rows) for rows sorted by one key of bounded groups."""
    for _, rows in sorted_runs(batches, [key], most):
        keys = rows.column(key).to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        yield list(zip(starts[:-1], starts[1:])), rows


def _dealt(rows: DataFrame, tasks: int, keys: list[str], *order: str) -> DataFrame:
    """Rows with equal keys together and sorted, in no more tasks than their number is worth."""
    return rows.repartition(*keys).coalesce(tasks).sortWithinPartitions(*order)


def _refined(lists: DataFrame, most: int, tasks: int) -> DataFrame:
    return in_arrow(_dealt(lists, tasks, ["node"], "node", "kind"), _merge_lists(most), _LISTS)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every edge node -> other: a row at the node and, reversed, a row at the other end."""
    for batch in batches:
        node = batch.column("node").to_numpy()
        ids = batch.column("ids").to_pylist()
        fresh = batch.column("fresh").to_pylist()
        size = np.array([len(i) // 8 for i in ids])
        other = np.frombuffer(b"".join(ids), np.int64)
        new = np.frombuffer(b"".join(fresh), np.uint8)
        own = np.repeat(node, size)
        mixed = (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (
            other.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        )
        chance = ((mixed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(40)).astype(np.int32)
        for kind, a, b in ((0, own, other), (1, other, own)):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a),
                    pa.array(np.full(len(a), kind, np.int32)),
                    pa.array(1 - new.astype(np.int32)),
                    pa.array(chance),
                    pa.array(b),
                ],
                names=["node", "kind", "old", "chance", "other"],
            )


def _sampled(listed: int, listing: int):
    """The first nodes of each direction; rows sorted by node, kind, old, chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            place = np.arange(len(key)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(key)]])))
            if key[0] == last:
                place[key == last] += seen
            last, seen = key[-1], int(place[-1]) + 1
            most = np.where(batch.column(1).to_numpy() == 0, listed, listing)
            keep = batch.filter(pa.array(place < most))
            yield pa.RecordBatch.from_arrays(
                [keep.column(0), keep.column(4), keep.column(2)], names=["at", "other", "old"]
            )

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes gathered at one node propose one another; rows sorted by the meeting node."""
    for groups, rows in _groups(batches, "at"):
        other, old = rows.column("other").to_numpy(), rows.column("old").to_numpy()
        least = rows.column("least").to_numpy()
        x = _matrix(rows.column("vec").to_pylist())
        out: list[list] = [[], [], []]
        for begin, end in groups:
            who, first = np.unique(other[begin:end], return_index=True)
            if len(who) < 2:
                continue
            first = first + begin
            new = old[first] == 0
            scores = x[first] @ x[first].T
            scores[~(new[:, None] | new[None, :])] = -np.inf
            np.fill_diagonal(scores, -np.inf)
            best = _top(scores, PROPOSALS)
            found = np.take_along_axis(scores, best, axis=1)
            better = found > least[first][:, None]
            for row in np.flatnonzero(better.any(axis=1)):
                good = better[row]
                out[0].append(who[row])
                out[1].append(who[best[row, good]].tobytes())
                out[2].append(found[row, good].tobytes())
        if out[0]:
            empty = [None] * len(out[0])
            yield _lists(np.array(out[0]), 1, empty, out[1], out[2], empty)


def _with_least(most: int):
    """Adds to each node the score that a proposal must exceed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [np.frombuffer(b, np.float32) for b in batch.column(2).to_pylist()]
            least = [float(x[-1]) if len(x) >= most else -np.inf for x in s]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(least, pa.float32())],
                names=["node", "vec", "least"],
            )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node with the ids and vectors of its neighbours."""
    for groups, rows in _groups(batches, "at"):
        at = rows.column("at").to_numpy()
        other, vecs = rows.column("other").to_numpy(), rows.column("vec").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(at[b]) for b, _ in groups], pa.int64()),
                pa.array([other[b:e].tobytes() for b, e in groups], pa.binary()),
                pa.array([b"".join(vecs[b:e]) for b, e in groups], pa.binary()),
            ],
            names=["node", "ids", "vecs"],
        )


def _settled(state: DataFrame) -> bool:
    """Whether hardly any entry of the lists came in with the last round."""
    new = F.length(F.translate(F.hex("fresh"), "0", ""))
    found = state.agg(F.sum(new).alias("new"), F.sum(F.octet_length("fresh")).alias("entries")).first()
    return (found["new"] or 0) <= FEW * (found["entries"] or 0)


def build_graph(
    vectors: DataFrame, neighbours: int = NEIGHBOURS, trees: int = TREES, rounds: int | None = None
) -> Graph:
    """Graph over the usable rows of ``vectors`` (vec_id, embedding).

    Rounds are made until at most ``FEW`` of the list entries are new; ``rounds`` fixes their number.

    Vectors of another length than the most frequent one (the smaller at a tie) take no part, like
    unusable ones and null ids.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    )
    lengths = rows.groupBy(F.size("embedding").alias("w")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "w").first()
    width = common["w"] if common else 1
    rows = stored(rows.where(F.size("embedding") == width), "vectors")
    same = rows.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    nodes = stored(same, "nodes")
    copies = nodes.where("n > 1").select(F.col("embedding").alias("e"), "node")
    alone = nodes.where("n = 1").select("node", F.col("node").alias("vec_id"))
    members = rows.join(copies, F.col("embedding") == F.col("e")).select("node", "vec_id")
    members = stored(members.union(alone), "members")
    squares = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    size = nodes.agg(F.count("*").alias("n"), F.sqrt(F.max(squares)).alias("m")).first()
    largest = size["m"] or 1.0
    base = stored(
        in_arrow(nodes.select("node", "embedding"), _augmented(largest), "node long, vec binary"), "unit"
    )
    bits = max(0, int(np.ceil(np.log2(max(1, size["n"]) / LEAF))))
    planted = in_arrow(
        base, _tree_rows(trees, bits, width + 1), "tree int, code long, side float, node long, vec binary"
    )
    tasks = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-size["n"] // NODES_PER_TASK))
    leaves = _dealt(planted, tasks, ["tree", "code"], "tree", "code", "side")
    proposals = in_arrow(leaves, _leaf_neighbours(LEAF, PER_LEAF), _LISTS)
    none = F.lit(None).cast("binary")
    start = base.select("node", F.lit(0).alias("kind"), "vec", none.alias("ids"), none.alias("scores"), none.alias("fresh"))
    state = stored(_refined(start.union(proposals), neighbours, tasks), "graph")
    made = 0
    while made < rounds if rounds is not None else not _settled(state):
        made += 1
        asked = in_arrow(state, _listed, "node long, kind int, old int, chance int, other long")
        asked = _dealt(asked, tasks, ["node"], "node", "kind", "old", "chance")
        asked = in_arrow(asked, _sampled(SAMPLE, SAMPLE), "at long, other long, old int")
        known = in_arrow(
            state.select("node", "vec", "scores"), _with_least(neighbours), "node long, vec binary, least float"
        )
        met = asked.join(known, F.col("other") == F.col("node")).drop("node")
        met = _dealt(met, tasks, ["at"], "at", "other")
        proposals = in_arrow(met, _meet, _LISTS)
        state = stored(_refined(state.union(proposals), neighbours, tasks), "graph")
    # A few edges against their direction make nodes reachable that hardly any node lists.
    edges = in_arrow(state, _listed, "node long, kind int, old int, chance int, other long")
    edges = edges.groupBy("node", "other").agg(F.min("kind").alias("kind"), F.min("chance").alias("chance"))
    edges = edges.select("node", "kind", F.lit(0).alias("old"), "chance", "other")
    edges = _dealt(edges, tasks, ["node"], "node", "kind", "chance")
    edges = in_arrow(edges, _sampled(neighbours, REVERSED), "at long, other long, old int")
    packed = edges.join(base, F.col("other") == F.col("node")).select("at", "other", "vec")
    packed = _dealt(packed, tasks, ["at"], "at")
    adjacency = stored(in_arrow(packed, _packed, "node long, ids binary, vecs binary"), "adjacency")
    first = base.orderBy(F.xxhash64("node"), "node").limit(PIVOTS).collect()
    pivots = [(r["node"], bytes(r["vec"])) for r in first]
    return Graph(nodes, members, state, adjacency, pivots, tasks)


_BEAMS = "query long, kind int, vec binary, ids binary, scores binary, done binary"


def _beam_rows(query, kind, vec, ids, scores, done) -> pa.RecordBatch:
    return _lists(query, kind, vec, ids, scores, done).rename_columns(
        ["query", "kind", "vec", "ids", "scores", "done"]
    )


def _first_beams(pivots: list[tuple[int, bytes]], beam: int):
    """Beams that hold the pivots and, if the query is a node of the graph, that node."""
    ids = np.array([p for p, _ in pivots], np.int64)
    x = _matrix([v for _, v in pivots])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            q = q / np.sqrt((q * q).sum(axis=1))[:, None]
            q = np.hstack([q, np.zeros((len(q), 1))]).astype(np.float16)
            starts = batch.column(2).to_pylist()
            scores = q.astype(np.float32) @ x.T
            out: list[list] = [[], [], []]
            for own, s in zip(starts, scores):
                who = ids
                if own is not None:
                    # Larger than any score, so that the search starts there.
                    who = np.concatenate([[own], ids[ids != own]])
                    s = np.concatenate([np.array([2.0], np.float32), s[ids != own]])
                order = np.argsort(-s, kind="stable")[:beam]
                out[0].append(who[order].astype(np.int64).tobytes())
                out[1].append(s[order].astype(np.float32).tobytes())
                out[2].append(bytes(len(order)))
            query = batch.column(0).to_numpy()
            yield _beam_rows(query, 0, [v.tobytes() for v in q], *out)

    return run


def _open_places(done: np.ndarray, most: int) -> np.ndarray:
    return np.flatnonzero(done == 0)[:most]


def _opened(most: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            rows = zip(*[batch.column(c).to_pylist() for c in ("query", "vec", "ids", "scores", "done")])
            for query, vec, ids, scores, done in rows:
                at = _open_places(np.frombuffer(done, np.uint8), most)
                s = np.frombuffer(scores, np.float32)
                least = float(s[-1]) if len(s) >= beam else -np.inf
                out[0] += [query] * len(at)
                out[1] += [vec] * len(at)
                out[2] += np.frombuffer(ids, np.int64)[at].tolist()
                out[3] += [least] * len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.binary()),
                    pa.array(out[2], pa.int64()),
                    pa.array(out[3], pa.float32()),
                ],
                names=["query", "qvec", "open", "least"],
            )

    return run


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of the open nodes that may enter the beam of their query."""
    for batch in batches:
        query, least = batch.column("query").to_numpy(), batch.column("least").to_numpy()
        q = _matrix(batch.column("qvec").to_pylist()) if batch.num_rows else None
        out: list[list] = [[], [], []]
        for row, (ids, vecs) in enumerate(
            zip(batch.column("ids").to_pylist(), batch.column("vecs").to_pylist())
        ):
            who = np.frombuffer(ids, np.int64)
            s = np.frombuffer(vecs, np.float16).reshape(len(who), -1).astype(np.float32) @ q[row]
            good = s > least[row]
            if good.any():
                out[0].append(query[row])
                out[1].append(who[good].tobytes())
                out[2].append(s[good].tobytes())
        if out[0]:
            empty = [None] * len(out[0])
            yield _beam_rows(np.array(out[0]), 1, empty, out[1], out[2], empty)


def _next_beams(most: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, rows in _groups(batches, "query"):
            query = rows.column("query").to_numpy()
            vecs, ids = rows.column("vec").to_pylist(), rows.column("ids").to_pylist()
            scores, flags = rows.column("scores").to_pylist(), rows.column("done").to_pylist()
            out: list[list] = [[], [], [], [], []]
            for begin, end in groups:
                who = np.frombuffer(b"".join(ids[begin:end]), np.int64)
                s = np.frombuffer(b"".join(scores[begin:end]), np.float32)
                done = np.zeros(len(who), np.uint8)
                before = np.frombuffer(flags[begin], np.uint8)
                done[: len(before)] = before
                done[_open_places(before, most)] = 1
                who, first = np.unique(who, return_index=True)
                order = np.lexsort((who, -s[first]))[:beam]
                first = first[order]
                out[0].append(query[begin])
                out[1].append(vecs[begin])
                out[2].append(who[order].tobytes())
                out[3].append(s[first].tobytes())
                out[4].append(done[first].tobytes())
            yield _beam_rows(np.array(out[0]), 0, *out[1:])

    return run


def _candidates(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(i, np.int64)[:most] for i in batch.column(1).to_pylist()]
            size = [len(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), size)),
                    pa.array(np.concatenate([*ids, np.zeros(0, np.int64)])),
                ],
                names=["query", "node"],
            )

    return run


def search_graph(
    graph: Graph, queries: DataFrame, beam: int = BEAM, opened: int = OPEN, steps: int | None = None
) -> DataFrame:
    """(query, node, score) of the nodes found near each query, scores exact on original vectors.

    ``queries`` has query (distinct), embedding (usable, of the graph's width) and start, a node to
    start from or null.  A search ends when nothing in its beam is left to follow, or after
    ``steps`` steps if given.
    """
    spark = queries.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    asked = stored(queries.select("query", "embedding", "start"), "queries")
    beams = stored(in_arrow(asked, _first_beams(graph.pivots, beam), _BEAMS), "beams")
    around = graph.adjacency.repartition(parts, "node").persist()
    taken = 0
    while steps is None or taken < steps:
        taken += 1
        open_rows = in_arrow(
            beams, _opened(opened, beam), "query long, qvec binary, open long, least float"
        )
        if open_rows.isEmpty():
            break
        near = open_rows.repartition(parts, "open").join(around, F.col("open") == F.col("node"))
        near = near.select("query", "qvec", "least", "ids", "vecs").coalesce(graph.tasks)
        rows = beams.union(in_arrow(near, _reached, _BEAMS))
        rows = _dealt(rows, graph.tasks, ["query"], "query", "kind")
        beams = stored(in_arrow(rows, _next_beams(opened, beam), _BEAMS), "beams")
    around.unpersist()
    pairs = in_arrow(beams.select("query", "ids"), _candidates(RESCORED), "query long, node long")
    pairs = pairs.join(
        graph.nodes.select(F.col("node").alias("n"), F.col("embedding").alias("x")),
        F.col("node") == F.col("n"),
    )
    pairs = pairs.join(
        asked.select(F.col("query").alias("q"), F.col("embedding").alias("y")),
        F.col("query") == F.col("q"),
    )
    return pairs.select("query", "node", exact_score(F.col("y"), F.col("x")).alias("score"))


def nearest_of_rows(vectors: DataFrame, is_query: Column, count: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest other rows of each query row of ``vectors``.

    ``is_query`` is a condition on vec_id.  Ties go to the smaller vec_id.  Rows that take no part
    are neither queries nor candidates; a query with fewer candidates gets all of them that are found.
    Rows that repeat a vec_id are one query and one candidate: with equal vectors they count once, and
    of several vectors the pair that is nearest does.  Other columns are ignored.
    """
    graph = build_graph(vectors)
    members = graph.members.select("node", "vec_id").distinct()
    asking = members.where(is_query)
    wanted = asking.select("node").distinct().withColumnRenamed("node", "start")
    queries = graph.nodes.join(wanted, F.col("node") == F.col("start")).select(
        F.col("node").alias("query"), "embedding", "start"
    )
    found = stored(search_graph(graph, queries), "found")
    # Of equal vectors a query needs the smallest ids, and one more if it is among them itself.
    least = members.selectExpr(
        "node as m", "vec_id", "row_number() over (partition by node order by vec_id) as r"
    ).where(F.col("r") <= count + 1)
    options = found.join(least, F.col("node") == F.col("m"))
    options = options.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    options = options.selectExpr(
        "query as s", "vec_id", "score",
        "row_number() over (partition by query order by score desc, vec_id) as r",
    ).where(F.col("r") <= count + 1)
    each = asking.select(F.col("vec_id").alias("query_id"), F.col("node").alias("a")).join(
        options, F.col("a") == F.col("s")
    )
    each = each.where("query_id <> vec_id").groupBy("query_id", "vec_id")
    each = each.agg(F.max("score").alias("score"))
    return each.selectExpr(
        "query_id",
        "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank",
        "vec_id",
        "score",
    ).where(F.col("rank") <= count)


def op2_nn_descent(spark, sf_dir: str) -> DataFrame:
    """Every twentieth row of ``embeddings`` against all others."""
    return nearest_of_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
