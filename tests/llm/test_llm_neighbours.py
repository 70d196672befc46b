import numpy as np
import pytest
from pyspark.sql import functions as F

from normwatch.llm import nn_descent as nn


def table_of(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def brute_force(vectors, is_query, count=20):
    vectors = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors]
    out = {}
    for i, x in vectors:
        if is_query(i):
            others = sorted(((-float(np.sum(x * y)), j) for j, y in vectors if j != i))
            out[i] = [(j, -s) for s, j in others[:count]]
    return out


def test_whole_neighbourhoods_and_ties(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(6) * (1 + i % 3)) for i in range(60)]
    # A third of the rows are one vector.
    good += [(100 + i, np.array([1.0, 2, 3, 0, 0, 1])) for i in range(50)]
    bad = [(200, None), (220, []), (240, [0] * 6), (260, [1, None, 1, 1, 1, 1])]
    bad += [(280, [float("nan")] * 6), (300, [float("inf")] + [1] * 5), (320, [1, 2])]
    got = nn.nearest_of_rows(table_of(spark, good + bad), F.col("vec_id") % 20 == 0).collect()
    want = brute_force(good, lambda i: i % 20 == 0)
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(by[r["query_id"]])
    assert sorted(by) == sorted(want)
    for query, found in want.items():
        assert [i for i, _ in by[query]] == [i for i, _ in found]
        assert np.allclose([s for _, s in by[query]], [s for _, s in found])


def test_repeated_rows_and_ids_count_once(spark):
    rng = np.random.default_rng(3)
    plain = [(i, rng.standard_normal(5)) for i in range(60)]
    # Rows 20 and 33 twice, and two ids that have other vectors too.
    more = [plain[20], plain[33], (40, rng.standard_normal(5)), (7, rng.standard_normal(5))]
    table = table_of(spark, plain + more).withColumn("score", F.lit("own")).withColumn("node", F.lit(1))
    got = {}
    for r in nn.nearest_of_rows(table, F.col("vec_id") % 20 == 0, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    vectors = [(i, np.array(v, np.float32).astype(float)) for i, v in plain + more]
    for query in (0, 20, 40):
        best = {}
        for i, x in vectors:
            for j, y in vectors:
                if i == query and j != query:
                    best[j] = max(best.get(j, -np.inf), float(np.sum(x * y)))
        want = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:5]
        assert [(n, j) for n, j, _ in sorted(got[query])] == [(n + 1, j) for n, (j, _) in enumerate(want)]
        assert np.allclose([s for *_, s in sorted(got[query])], [s for _, s in want])
    assert sorted(got) == [0, 20, 40]


def test_few_and_no_rows(spark):
    one = table_of(spark, [(0, [1, 2]), (1, [2, 1])])
    rows = nn.nearest_of_rows(one, F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 4.0)]
    assert nn.nearest_of_rows(one.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert nn.nearest_of_rows(one.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_recall(spark, sf):
    got = nn.op2_nn_descent(spark, sf).toPandas()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    want = brute_force(list(zip(rows.vec_id, rows.embedding)), lambda i: i % 20 == 0)
    found = got.groupby("query_id").vec_id.apply(set)
    hits = sum(len(found[q] & {i for i, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert (got.groupby("query_id").size() == 20).all()


def test_a_search_goes_on_until_nothing_is_open(spark):
    turn = np.linspace(0, 3, 400)
    vectors = [(i, [np.cos(t), np.sin(t)]) for i, t in enumerate(turn)]
    graph = nn.build_graph(table_of(spark, vectors), neighbours=4)
    queries = graph.nodes.where("node % 40 = 20").selectExpr("node as query", "embedding", "cast(null as long) as start")
    want = {q: {j for j, _ in found} for q, found in brute_force(vectors, lambda i: i % 40 == 20, 30).items()}

    def missed(**limits):
        found = {}
        for r in nn.search_graph(graph, queries, beam=48, opened=1, **limits).collect():
            found.setdefault(r["query"], set()).add(r["node"])
        return sum(len(w - found[q]) for q, w in want.items())

    assert missed(steps=7) > 0
    assert missed() == 0
