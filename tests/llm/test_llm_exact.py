import hashlib
import re

import numpy as np
import pytest
from llm_cases import ROWS, edge_docs, no_docs
from pyspark.sql import functions as F

from normwatch.llm import exact_dedup as ed
from normwatch.llm.common import stored
from normwatch.llm.fuse import FuseFilter


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 20_000])
def test_filter_holds_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n).astype(np.uint64)
    made = FuseFilter.from_bytes(FuseFilter.build(keys).to_bytes())
    assert made.contains(keys).all()
    others = rng.integers(0, 2**63, 20_000).astype(np.uint64) + np.uint64(2**63)
    assert made.contains(others).mean() < 0.01
    if n == 20_000:
        assert len(made.slots) < 1.4 * n


def brute_force(rows):
    groups = {}
    for at, (i, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((at, i, text or ""))
    out = []
    for plain, members in groups.items():
        best = min(members, key=lambda m: (-len(m[2]), m[1] is None, m[1] or 0, m[0]))
        digest = hashlib.sha256(plain.encode()).hexdigest()
        out += [(m[1] or -1, best[1] or -1, len(members), m[0] == best[0], digest) for m in members]
    return sorted(out)


def result(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))
    return sorted((r[0] or -1, r[1] or -1, *r[2:]) for r in rows.collect())


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_edge_rows_in_any_number_of_batches(spark, batches):
    want = brute_force([(i, t) for i, t, _ in ROWS])
    assert result(ed.dedup(edge_docs(spark), batches, bucket_digests=3)) == want
    if batches == 2:
        assert ed.dedup(no_docs(spark), batches).count() == 0


def test_many_copies_over_batches(spark):
    rows = [(i, "hot text " if i % 3 == 0 else f"text {i % 50}" + " " * (i % 4)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(ed.dedup(df, 4, bucket_digests=10)) == brute_force(rows)


def test_positives_are_compared_byte_by_byte(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "ab "), (3, "abc")], "doc_id long, text string")
    digests = ed.digest_rows(docs)
    of = {r["doc_id"]: r["digest"] for r in digests.collect()}
    # The second pair claims a digest that its other text does not have.
    claimed = [(of[1], 1, 1, 2, 0), (of[1], 1, 1, 3, 0)]
    pairs = spark.createDataFrame(
        claimed, "digest binary, batch int, doc_id long, other_id long, root int"
    )
    assert ed._equal_bytes(pairs, docs).count() == 1
    entries = stored(digests.where("doc_id <> 3"), "entries")
    snapshot = ed.make_snapshot(entries, 2)
    found = ed.screen(digests.select("digest"), [snapshot], 2).collect()
    assert {bytes(r["digest"]) for r in found} >= {bytes(of[1])}


def test_kept_rows_have_all_columns(spark):
    docs = edge_docs(spark)
    kept = ed.drop_duplicates(docs)
    assert kept.columns == docs.columns
    want = [r for r in brute_force([(i, t) for i, t, _ in ROWS]) if r[3]]
    rows = kept.collect()
    assert sorted(r["doc_id"] or -1 for r in rows) == sorted(r[0] for r in want)
    assert all(r["digest"] == "own digest" for r in rows)
    assert ed.drop_duplicates(no_docs(spark)).count() == 0
