import zlib

import numpy as np
import pandas as pd
from llm_cases import CLASHES, LONG, ROWS, edge_docs, no_docs

from normwatch.llm import quality as q


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_statistics_are_finite_for_all_texts():
    for text in (b"", b" ", b"\n\n", LONG.encode(), "ß 漢".encode(), b"a" * 100_000):
        stats = q.text_statistics(text)
        assert len(stats) == q.WIDTH and np.isfinite(stats).all()


def test_model_equals_the_plain_formula(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, q.WIDTH)) + np.arange(200)[:, None] % 2
    stats = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(x)], "doc_id long, stats array<double>"
    ).repartition(4)
    marks = [(i, i % 2, 0) for i in range(200)] + [(1, None, 0), (None, 1, 0), (3, 7, 0)]
    model = q.fit(stats, labels(spark, marks))
    own = [x[np.arange(200) % 2 == k] for k in (0, 1)]
    covs = [np.cov(o.T) for o in own]
    common = sum((len(o) - 1) * c for o, c in zip(own, covs)) / 198
    logs = []
    for o, c in zip(own, covs):
        c = (1 - q.POOLED) * c + q.POOLED * common
        c = (1 - q.IDENTITY) * c + q.IDENTITY * np.trace(c) / q.WIDTH * np.eye(q.WIDTH)
        d = x - o.mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)
        logs.append(np.log(len(o) / 200) - 0.5 * (distance + np.linalg.slogdet(c)[1]))
    want = 1 / (1 + np.exp(-(logs[1] - logs[0]) / np.sqrt(q.WIDTH)))
    assert np.allclose(model.scores(x), want)
    got = {r["doc_id"]: r["score"] for r in q.score(stats, model).collect()}
    assert np.allclose([got[i] for i in range(200)], want)


def test_without_one_class_all_scores_are_its_share(spark):
    stats = q.document_statistics(edge_docs(spark))
    model = q.fit(stats, labels(spark, [(1, 1, 0), (2, 1, 0)]))
    rows = q.score(stats, model).collect()
    assert len(rows) == len(ROWS) and {r["score"] for r in rows} == {0.75}
    assert q.fit(stats, labels(spark, [])).fallback == 0.5


def test_accepted_rows_keep_their_columns(spark):
    docs = edge_docs(spark)
    marks = [(1, 1, 0), (2, 1, 0), (7, 1, 0), (4, 0, 0), (6, 0, 0), (8, 0, 0), (3, 1, 0), (11, 0, 0)]
    kept = q.accepted(docs, labels(spark, marks))
    assert kept.columns == docs.columns and set(CLASHES) < set(kept.columns)
    rows = kept.collect()
    assert 0 < len(rows) < len(ROWS) and all(r["row"] == "own row" for r in rows)
    assert q.accepted(no_docs(spark), labels(spark, marks)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = q.op1_quality(spark, sf).toPandas()
    marks = pd.read_parquet(f"{sf}/labels.parquet")
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all()
    held = rows[rows.held_out].merge(marks, on="doc_id")
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() > 0.97
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all()
