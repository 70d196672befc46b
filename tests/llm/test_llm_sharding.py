import heapq
import random
import zlib

from llm_cases import ROWS, edge_docs, no_docs

from normwatch.llm import sharding as s


def one_by_one(classes, shards):
    heap = [(0.0, i) for i in range(shards)]
    loads = []
    for n, total in classes:
        for _ in range(n):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + total / n, shard))
    loads = sorted(x for x, _ in heap)
    return loads


def test_bulk_steps_give_the_loads_of_the_heap():
    rng = random.Random(3)
    for trial in range(60):
        shards = rng.choice([1, 2, 5, 16])
        sizes = sorted((rng.randint(1, 4000) for _ in range(rng.randint(1, 12))), reverse=True)
        if trial % 3 == 0:
            sizes = [100_000, *sizes]
        classes = [(n, n * size) for size in sizes for n in [rng.choice([1, 2, 17, 200])]]
        plan = s.lpt_counts(classes, shards)
        loads = [0.0] * shards
        for (n, total), row in zip(classes, plan):
            assert sum(row) == n and min(row) >= 0
            loads = [x + c * total / n for x, c in zip(loads, row)]
        want = one_by_one(classes, shards)
        assert max(abs(a - b) for a, b in zip(sorted(loads), want)) < 1e-6 * max(want)


def check(rows, shards):
    size = {k: 0 for k in range(shards)}
    slots, of = {}, {}
    for r in rows:
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert of.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return size


def test_edge_rows(spark):
    rows = s.lpt_shards(edge_docs(spark)).collect()
    assert len(rows) == len(ROWS)
    check(rows, 16)
    want = sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in rows) == want
    assert s.lpt_shards(no_docs(spark)).count() == 0


def test_hot_group_and_even_rest(spark):
    docs = [(i, "copy of one text" if i % 3 == 0 else "x" * (i % 40) + str(i)) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    size = check(s.lpt_shards(df, shards=4, spread=3).collect(), 4)
    hot = 1000 * 17
    assert max(size.values()) - min(size.values()) <= 60 or max(size.values()) == hot


def test_slots_with_many_parts(spark):
    rows = spark.range(500).selectExpr("id % 7 as doc_id", "cast(id % 3 as int) as shard")
    found = s.with_slots(rows, slot_rows=40).collect()
    by = {}
    for r in found:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(found) == 500
