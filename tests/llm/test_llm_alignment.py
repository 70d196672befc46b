import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from llm_cases import ROWS, edge_docs, no_docs
from pyspark.sql import functions as F

from normwatch.llm import alignment as al

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
LETTERS = "ab eE'stx 1\n\t \r\x00\x0b\x0c\x1c\x1f\x85\xa0　éß漢🙂.,!?-_​́٣Ⅷ²▁<s>"
ODD = ["", " ", "  ", " a", "a ", "a  ", "\n ", " \n", "a \n b", "▁", "a▁b c", "<s> </s> <unk> <0x41>",
       "<|endoftext|> x", "a" * 3000, " " * 300 + "x", "x" + " " * 300, "aaab" * 500, "it's  'll", "\x00", "﻿a"]


@pytest.fixture(scope="module")
def pair():
    return al.TokenizerPair(A, B)


def made(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def walk(pair, text):
    """Ids, groups and links of a text by encoding it whole and walking along its bytes."""
    if not text:
        return [], [], [], []
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    spelled = (" " + text).encode()
    if b"".join(pair.a_bytes[t] for t in a) != spelled or b"".join(pair.b_bytes[t] for t in b) != spelled:
        return [], [], [], []
    at_a = [k for k, t in enumerate(a) for _ in pair.a_bytes[t]]
    at_b = [k for k, t in enumerate(b) for _ in pair.b_bytes[t]]
    met = sorted(set(zip(at_a, at_b)))
    groups, begin = [], (0, 0)
    for k in range(len(at_a)):
        if k + 1 == len(at_a) or (at_a[k] != at_a[k + 1] and at_b[k] != at_b[k + 1]):
            end = (at_a[k] + 1, at_b[k] + 1)
            groups.append((a[begin[0] : end[0]], b[begin[1] : end[1]]))
            begin = end
    return a, b, groups, [(a[x], b[y]) for x, y in met]


def brute(pair, rows):
    walked = [(i, *walk(pair, t or "")) for i, t in rows]
    counts = Counter(link for *_, links in walked for link in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    result = []
    for i, a, b, groups, links in walked:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        top = sum(counts[x] == best[x[0]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        total = sum(counts[x] for x in links)
        result.append((-1 if i is None else i, len(a), len(b), len(groups), len(links), top, total, digest))
    return sorted(result)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(docs):
    rows = al.document_alignments(docs, A, B).select(COLUMNS).collect()
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows)


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_merge_alike(work):
    rng = np.random.default_rng(work)
    for size in (1, 2, 30, 300):
        total = int(size * 3)
        cut = [np.append(np.sort(rng.choice(total, size - 1, False)), total) if size > 1 else np.array([total]) for _ in "ab"]
        a, b = (np.unique(c[c > 0]) for c in cut)
        ends, at_a, at_b, common = al.overlaps(a, b, work)
        union = np.union1d(a, b)
        assert ends.tolist() == union.tolist()
        assert at_a.tolist() == np.searchsorted(a, union, "left").tolist()
        assert at_b.tolist() == np.searchsorted(b, union, "left").tolist()
        assert common.tolist() == np.isin(union, np.intersect1d(a, b)).tolist()
        low, across = al.merge_cuts(a, b, work)
        assert set(np.diff(low + across)[:-1]) <= {work}
    none = np.zeros(0, np.int64)
    assert [len(x) for x in al.overlaps(none, none, work)] == [0, 0, 0, 0]


def test_words_give_what_whole_texts_give(pair):
    words = al.WordTable(pair)
    texts = made(11, 3000) + ODD + [t for _, t, _ in ROWS if t]
    for text, numbers in zip(texts, words.text_words(texts)):
        a, b, groups, links = walk(pair, text)
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert b";".join(words.spelled[k] for k in numbers).decode() == want, repr(text)
        assert words.counts[numbers].sum(0).tolist() == [len(a), len(b), len(groups)]
        flat = words.links.gather(numbers)[0].tolist()
        assert [(k >> 32, k & 0xFFFFFFFF) for k in flat] == links


@pytest.mark.parametrize("block", [1, 200, 1 << 20])
def test_documents_against_a_walk_along_the_bytes(spark, pair, block, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_BYTES", block)
    texts = made(12, 150) + ODD
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[4]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs) == brute(pair, rows)


def test_edge_rows_and_empty_tables(spark, pair):
    rows = [(i, t) for i, t, _ in ROWS]
    assert found(edge_docs(spark)) == brute(pair, rows)
    assert found(no_docs(spark)) == []
    blank = spark.createDataFrame([(1, ""), (2, None), (3, "▁")], "doc_id long, text string")
    assert found(blank) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_forgetting_words_changes_nothing(pair, monkeypatch):
    monkeypatch.setattr(al, "REMEMBERED_WORDS", 3)
    words = al.WordTable(pair)
    for text in made(13, 60):
        numbers = words.text_words([text])[0]
        assert words.counts[numbers].sum(0).tolist()[0] == len(walk(pair, text)[0])
        words.tidy()
        assert len(words.numbers) <= 3


def test_groups_with_their_bytes(spark, pair):
    rows = al.aligned_groups(edge_docs(spark), A, B).collect()
    assert len(rows) == len(ROWS)
    texts = defaultdict(list)
    for i, text, _ in ROWS:
        texts[i].append(text or "")
    for row in rows:
        wanted = [walk(pair, t)[2] for t in texts[row["doc_id"]]]
        assert [(g["a"], g["b"]) for g in row["groups"]] in wanted
        begin = 0
        for g in row["groups"]:
            assert g["begin"] == begin and g["end"] - begin == sum(len(pair.b_bytes[t]) for t in g["b"])
            begin = g["end"]


def test_pair_counts(spark, pair):
    rows = list(enumerate(made(14, 40)))
    blocks = al.aligned_blocks(spark.createDataFrame(rows, "doc_id long, text string"), A, B)
    got = {(r["a"], r["b"]): r["n"] for r in al.link_counts(blocks).collect()}
    assert got == Counter(link for _, t in rows for link in set(walk(pair, t)[3]))
    tops = al.link_counts(blocks).where(F.col("top")).groupBy("a").agg(F.countDistinct("n").alias("k"))
    assert {r["k"] for r in tops.collect()} == {1}
