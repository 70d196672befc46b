import hashlib
import random
import re

import pytest
from llm_cases import edge_docs, no_docs, texts_of
from pyspark.sql import functions as F

from normwatch.llm import decontamination as de

BREAK = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return [w for w in BREAK.split((text or "").translate(UPPER)) if w]


def brute(docs, items, length=10):
    """(doc_id, n_words, n_hit, n_items, digest, contaminated) by comparing all windows."""
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(length, len(own))
        for s in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[s : s + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    rows = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for s in range(len(own) - size + 1):
                of = windows.get(tuple(own[s : s + size]))
                if of:
                    hit.update(range(s, s + size))
                    found |= of
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        rows.append((doc or -1, len(own), len(hit), len(ids), digest, bool(hit)))
    return sorted(rows)


def found(spark, docs, items, length=10):
    rows = de.contamination(docs, items, length)
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    rows = rows.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated").collect()
    return sorted((r[0] or -1, *r[1:]) for r in rows)


def item_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit("own"))


def made(seed, n_docs, n_words, vocabulary="abcd"):
    rng = random.Random(seed)
    return [
        (i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, n_words))))
        for i in range(n_docs)
    ]


@pytest.mark.parametrize("length", [1, 3, 10])
def test_random_rows_against_all_windows(spark, length):
    docs, items = made(1, 60, 60, "ab"), made(2, 25, 14, "ab")
    docs += [(100, "x " + items[3][1].upper() + ". y"), (100, items[4][1]), (None, items[5][1])]
    items += [(None, "b b b b b b b b b b b"), (3, items[3][1]), (90, "É ß 漢字 é"), (91, None), (92, " .")]
    docs += [(101, "…É ß 漢字,É ß 漢字 é"), (None, None), (None, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert found(spark, table, item_table(spark, items), length) == brute(docs, items, length)


def test_edge_rows_and_empty_tables(spark):
    rows = texts_of()
    items = [(1, " ".join(words(rows[0][1])[5:40])), (2, "one"), (3, " ".join(words(rows[6][1])[59_000:59_030]))]
    items = item_table(spark, items)
    want = brute(rows, [tuple(r)[:2] for r in items.collect()])
    assert found(spark, edge_docs(spark), items) == want
    assert any(r[5] for r in want)
    assert found(spark, no_docs(spark), items) == []
    clean = found(spark, edge_docs(spark), items.where("false"))
    assert len(clean) == len(rows) and not any(r[5] for r in clean)


def test_many_candidates_are_met_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(de, "_DOCUMENTS_LIMIT", 0)
    monkeypatch.setattr(de, "_ROW_BYTES", 1 << 40)
    docs, items = made(3, 40, 50, "abc"), made(4, 20, 13, "abc")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(spark, table, item_table(spark, items), 4) == brute(docs, items, 4)


def test_words_near_each_other(spark):
    docs, items = made(5, 30, 60, "abcdefgh"), made(6, 12, 4, "abcdefgh") + [(50, "a zz")]
    index = de.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    phrases = de.phrase_words(item_table(spark, items))
    ids = {r["row"]: r["doc_id"] for r in de.documents_of(index).collect()}
    for within in (1, 3, 6):
        got = de.proximity_matches(index, phrases, within).collect()
        want = set()
        for text in {" ".join(words(t)) for _, t in items} - {""}:
            asked = set(text.split())
            for doc, body in docs:
                own = words(body)
                for at, word in enumerate(own):
                    if word in asked and asked <= set(own[at : at + within]):
                        want.add((hashlib.sha256(text.encode()).hexdigest(), doc, at))
        assert sorted((r["phrase"], ids[r["row"]], r["begin"]) for r in got) == sorted(want)
    with pytest.raises(ValueError):
        de.proximity_matches(index, phrases, 0)
    with pytest.raises(ValueError):
        de.phrase_matches(index, phrases, 0)
