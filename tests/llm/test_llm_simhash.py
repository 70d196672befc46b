import random
import re

import numpy as np
import pytest
import xxhash
from llm_cases import ROWS, edge_docs, no_docs, texts_of

from normwatch.llm import simhash as sh


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints(monkeypatch):
    texts = [t for _, t in texts_of()] + ["a B  c", "a b", "É b\x0cC d", "x\x1cy z w v"]
    for text in texts:
        assert sh.fingerprint(text.encode()) == plain_fingerprint(text)
    whole = sh.fingerprint(texts[6].encode())
    monkeypatch.setattr(sh, "_CHUNK", 1000)
    assert sh.fingerprint(texts[6].encode()) == whole


def cloud(seed, centres, each, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        bits = rng.sample(range(64), flips)
        for _ in range(each):
            out.add(centre ^ sum(1 << b for b in rng.sample(bits, rng.randint(0, flips // 2))))
    return sorted(out | {rng.getrandbits(64) for _ in range(40)})


@pytest.mark.parametrize("bucket", [512, 3])
@pytest.mark.parametrize("most", [3, 2])
def test_links_connect_what_is_close(spark, monkeypatch, bucket, most):
    monkeypatch.setattr(sh, "BUCKET", bucket)
    prints = cloud(bucket + most, 4, 40, 12)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    roots = sh.connected_components(sh.fingerprint_links(df, most)).collect()
    want = plain_components(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= most)
    got = {r["node"]: r["root"] for r in roots}
    assert {n: got.get(n, n) for n in signed} == want


def test_edge_rows(spark):
    rows = sh.near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    prints = {t: plain_fingerprint(t) for _, t in texts_of()}
    of = plain_components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, t in texts_of():
        if i is not None:
            least[of[prints[t]]] = min(i, least.get(of[prints[t]], i))
    want = sorted((i or -1, prints[t], least[of[prints[t]]]) for i, t in texts_of())
    got = sorted((r["doc_id"] or -1, r["fp"] & (2**64 - 1), r["component_id"]) for r in rows)
    assert got == want
    assert sh.near_duplicates(no_docs(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    docs = edge_docs(spark)
    kept = sh.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = sh.near_duplicates(docs).collect()
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in found})
    nulls = docs.where("doc_id is null")
    # Two texts that are not alike, both without an id.
    assert sh.drop_near_duplicates(nulls).count() == 2
    assert sh.drop_near_duplicates(no_docs(spark)).count() == 0


def test_every_component_keeps_a_row_whatever_its_ids(spark):
    from llm_cases import prose

    one, two, three = prose(21, 90), prose(22, 120), prose(23, 60)
    docs = [(None, one), (None, two), (None, two), (1, three), (1, one + " x y"), (2, three)]
    kept = sh.drop_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    found = sh.near_duplicates(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id long, text string"))
    of = {r["doc_id"]: r["component_id"] for r in found.collect()}
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    # One row of each component: its smallest id, or null where it has no other.
    assert sorted(of[docs.index(r)] for r in rows) == sorted(set(of.values()))
    assert (None, two) in rows and (1, three) in rows
    nulls = spark.createDataFrame([(None, one), (None, two)], "doc_id long, text string")
    assert sh.drop_near_duplicates(nulls).count() == 2
