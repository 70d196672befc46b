import random

import numpy as np
import pytest
import xxhash
from llm_cases import edge_docs, no_docs

from normwatch.llm import substrings as sub


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def edited(rng, passage, every):
    out = []
    for n, w in enumerate(passage):
        if n % every == every // 2:
            kind = rng.randrange(3)
            if kind == 0:
                continue
            out.append(f"x{rng.randrange(10**6)}")
            if kind == 1:
                out.append(w)
        else:
            out.append(w)
    return out


def plain_chain_score(x, y):
    order = sorted(range(len(x)), key=lambda i: (x[i], -y[i]))
    best = {}
    for i in order:
        value = sub.SEED_WORDS
        for j in best:
            if x[j] < x[i] and y[j] < y[i]:
                cost = sub.GAP_COST * (x[i] - x[j] + y[i] - y[j])
                value = max(value, sub.SEED_WORDS + best[j] - cost)
        best[i] = value
    return best


def test_chains_score_as_the_plain_recursion(monkeypatch):
    monkeypatch.setattr(sub, "MOST_GAP", 10**9)
    for seed in range(40):
        rng = random.Random(seed)
        n = rng.randrange(2, 40)
        x = np.array([rng.randrange(60) for _ in range(n)])
        y = np.array([rng.randrange(60) for _ in range(n)])
        chains = sub.chain_matches(x, y)
        used = np.concatenate(chains) if chains else np.zeros(0, int)
        assert len(set(used.tolist())) == len(used)
        for c in chains:
            assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
        score = plain_chain_score(x.tolist(), y.tolist())
        top = max(score.values())
        if top > sub.SEED_WORDS + 1e-9:
            c = chains[0]
            gaps = sub.GAP_COST * (np.diff(x[c]) + np.diff(y[c])).sum()
            assert abs(len(c) * sub.SEED_WORDS - gaps - top) < 1e-6


def test_a_passage_after_a_long_one_is_chained():
    # 100 words shared, 60 not, 60 shared: the second passage must not vanish behind the first.
    x = np.array([*range(0, 96, 4), *range(160, 216, 4)])
    chains = sub.chain_matches(x, x + 7)
    assert sorted(x[c].tolist() for c in chains) == [x[:24].tolist(), x[24:].tolist()]


def test_two_passages_of_one_pair_sixty_words_apart(spark):
    rng = random.Random(5)
    one, two = words(rng, 100), words(rng, 200)
    docs = [(i, " ".join(words(rng, 20) + one + words(rng, 60) + two)) for i in (1, 2)]
    rows = sub.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["begin_word"], r["end_word"]) for r in rows) == [(20, 120), (180, 380)]


@pytest.mark.parametrize("twice", [1, 2])
def test_a_passage_twice_in_one_document_and_once_in_another(spark, twice):
    rng = random.Random(6)
    passage = words(rng, 60)
    docs = []
    for i in (1, 2):
        text = words(rng, 30) + passage + words(rng, 80)
        docs.append((i, " ".join(text + passage if i == twice else text)))
    rows = sub.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    span = ("begin_word", "end_word") if twice == 2 else ("other_begin", "other_end")
    assert {(r[span[0]], r[span[1]]) for r in rows} == {(30, 90), (170, 230)}


def test_alignment_across_insertions_and_deletions():
    rng = random.Random(2)
    for every in (7, 12, 100):
        a = words(rng, 90)
        b = words(rng, 10) + edited(rng, a, every) + words(rng, 10)
        ha = (sub.word_hashes(" ".join(a).encode()) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        hb = (sub.word_hashes(" ".join(b).encode()) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        where = {w: i for i, w in enumerate(b)}
        anchors = [
            (i, where[w]) for i, w in enumerate(a[:-4]) if a[i : i + 5] == b[where.get(w, -9) : where.get(w, -9) + 5]
        ]
        x, y = np.array(anchors[::3]).T
        found = sub.align_chain(ha, hb, x.astype(np.int64), y.astype(np.int64), 0, 0)
        assert len(found) == 1
        begin, end, o_begin, o_end, same = found[0]
        assert end - begin >= 75 and same >= sub.IDENTITY
        assert o_begin >= 8 and o_end <= len(b) - 8


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(11)
    exact, fuzzy, short = words(rng, 60), words(rng, 80), words(rng, 40)
    docs = []
    for i in range(60):
        text = words(rng, 100 + rng.randrange(200))
        at = rng.randrange(len(text))
        # A third of the documents hold one passage.
        if i % 3 == 0:
            text[at:at] = exact
        elif i % 10 == 1:
            text[at:at] = edited(rng, fuzzy, 25)
        elif i % 10 == 2:
            text[at:at] = short
        docs.append((i, " ".join(text)))
    docs += [(100, "same again " * 300), (101, "same again " * 200), (102, "one " * 400), (103, "one " * 90)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    return docs, sub.repeated_passages(df).collect()


def test_planted_passages_are_found_and_others_are_not(planted):
    docs, rows = planted
    text = {i: t.split() for i, t in docs}
    found = {r["doc_id"] for r in rows} | {r["other_doc_id"] for r in rows}
    want = {i for i in range(60) if i % 3 == 0 or i % 10 == 1} | {100, 101, 102, 103}
    assert found == want
    for r in rows:
        a = text[r["doc_id"]][r["begin_word"] : r["end_word"]]
        b = text[r["other_doc_id"]][r["other_begin"] : r["other_end"]]
        assert len(a) >= 50 and len(b) >= 50 and r["identity"] >= 0.8
        assert r["other_doc_id"] < r["doc_id"]
        if r["doc_id"] < 60 and r["doc_id"] % 3 == 0 and r["other_doc_id"] % 3 == 0:
            assert a == b and len(a) == 60


def test_edge_rows(spark):
    rows = sub.repeated_passages(edge_docs(spark)).collect()
    assert {(r["doc_id"], r["other_doc_id"]) for r in rows} == {(2, 1), (3, 1), (12, 1)}
    assert sub.repeated_passages(no_docs(spark)).count() == 0


def replaced(rng, passage, at):
    return [f"x{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(passage)]


def test_halves_that_stand_in_earlier_documents_do_not_hide_a_passage(spark):
    docs = []
    for t in range(30):
        rng = random.Random(t)
        passage = words(rng, 60)
        for i, part in enumerate((passage[:35], passage[25:], passage, passage)):
            docs.append((10 * t + i, " ".join(words(rng, 50) + part + words(rng, 50))))
    found = sub.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(8))
    links = {(r["doc_id"], r["other_doc_id"]) for r in found.collect()}
    assert all((10 * t + 3, 10 * t + 2) in links for t in range(30))


@pytest.mark.parametrize("parts", [1, 8])
@pytest.mark.parametrize("held", [30, 45])
def test_exact_passages_of_fifty_words_behind_earlier_parts(spark, held, parts):
    docs = []
    for t in range(40):
        rng = random.Random(100 + t)
        passage = words(rng, 50 + t % 10)
        for i, part in enumerate((passage[:held], passage[-held:], passage, passage, passage)):
            docs.append((10 * t + i, " ".join(words(rng, 50) + part + words(rng, 50))))
    found = sub.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts))
    links = {(r["doc_id"], r["other_doc_id"]) for r in found.collect()}
    assert all((10 * t + 3, 10 * t + 2) in links for t in range(40))
    assert all((10 * t + 4) in {d for d, _ in links} for t in range(40))
    assert all(d % 10 >= 3 and o % 10 >= 2 for d, o in links)


def test_equal_runs_and_those_that_differ():
    a = np.arange(200, dtype=np.uint32)
    b = np.concatenate([np.arange(900, 910, dtype=np.uint32), a[20:120], np.arange(950, 1000, dtype=np.uint32)])
    # The seed at 24 has four equal words before it, the one at 100 is none.
    found, mine, theirs = sub.equal_runs(a, b, np.array([24, 100]), np.array([14, 90]))
    assert found == [(20, 120, 10)]
    assert mine.tolist() == [14, 15, 16, 17, 18, 19] and theirs.tolist() == [4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("length", [60, 100, 200])
@pytest.mark.parametrize("every", [6, 7, 10])
def test_recall_of_edited_passages(spark, length, every):
    docs = []
    for t in range(100):
        rng = random.Random(1000 * length + 10 * every + t)
        passage = words(rng, length)
        # Every second pair has its edits at equal distances, the others anywhere.
        at = range(every // 2, length, every) if t % 2 else rng.sample(range(length), length // every)
        for i, part in enumerate((passage, replaced(rng, passage, set(at)))):
            docs.append((2 * t + i, " ".join(words(rng, 60) + part + words(rng, 60))))
    found = sub.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(8))
    assert len({r["doc_id"] for r in found.collect() if r["other_doc_id"] == r["doc_id"] - 1}) >= 90


def longest_run(a, b):
    """Words of the longest run that both lists share."""
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                now[j + 1] = before[j] + 1
        best, before = max(best, *now), now
    return best


def common_words(a, b):
    """Words of the longest common subsequence."""
    before = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(before[j] + 1 if x == y else max(now[j], before[j + 1]))
        before = now
    return before[-1]


@pytest.mark.parametrize("seed", range(3))
def test_links_connect_what_brute_force_finds(spark, seed):
    rng = random.Random(seed)
    pool = [words(rng, 120) for _ in range(2)]
    docs = []
    for i in range(40):
        text = words(rng, rng.randrange(10, 40))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(pool)
            begin = rng.randrange(60)
            text += passage[begin : begin + rng.randrange(30, 90)] + words(rng, rng.randrange(10, 40))
        docs.append((i, text))
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    found = sub.repeated_passages(rows.repartition(5)).collect()
    root = list(range(40))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in found:
        a = docs[r["doc_id"]][1][r["begin_word"] : r["end_word"]]
        b = docs[r["other_doc_id"]][1][r["other_begin"] : r["other_end"]]
        assert min(len(a), len(b)) >= sub.MIN_WORDS
        assert common_words(a, b) >= sub.IDENTITY * min(len(a), len(b))
        root[top(r["doc_id"])] = top(r["other_doc_id"])
    linked = [(i, j) for i in range(40) for j in range(i) if longest_run(docs[i][1], docs[j][1]) >= 60]
    assert len(linked) > 20
    for i, j in linked:
        assert top(i) == top(j)


def test_long_seeds_are_equal_where_the_words_are():
    rng = random.Random(3)
    a = sub.word_hashes(" ".join(words(rng, 400)).encode())
    b = np.concatenate([a[300:], a[100:200], a[:50]])
    seeds, marks = sub.seeds_of(a)
    other, places = sub.seeds_of(b)
    at = dict(zip(other.tolist(), places.tolist()))
    pairs = [(m >> 1, at[s] >> 1) for s, m in zip(seeds.tolist(), marks.tolist()) if m & 1 and s in at]
    assert pairs and all((a[x : x + 50] == b[y : y + 50]).all() for x, y in pairs)
    # Every run of sixty words begins a long seed within its first eleven.
    where = np.sort(marks[marks % 2 == 1] >> 1)
    assert where[0] < 11 and np.diff(where).max() <= 11


@pytest.mark.parametrize("text", ["a " * 500, "a b " * 300, "long" * 40_000, "a b c d e f g h i j k l m n o " * 80])
def test_seeds_of_text_that_repeats_itself(text):
    hashes = sub.word_hashes(text.encode())
    seeds, marks = sub.seeds_of(hashes)
    assert len(set(zip(seeds.tolist(), marks.tolist()))) == len(seeds)
    if len(hashes) > 50:
        assert {0, 1} == set((marks & 1).tolist())
    assert all(len(w) <= sub._WORD_BYTES for w in sub._HASHES)


def test_short_passages_with_edits_near_their_ends():
    a = np.arange(55, dtype=np.uint32)
    b = a.copy()
    b[[2, 51]] = 999, 998
    anchors = np.array([10, 30])
    assert sub.align_chain(a, b, anchors, anchors, 0, 0) == [(0, 55, 0, 55, 53 / 55)]
    # Forty equal words are none, whatever follows them.
    b = np.concatenate([a[:40], np.arange(900, 960, dtype=np.uint32)])
    assert sub.align_chain(a, b, anchors, anchors, 0, 0) == []


def test_words_are_hashed_without_being_remembered():
    text = " One two  ONE\tthrÉe\x0b\x1ftwo ".encode()
    want = [xxhash.xxh3_64_intdigest(w) for w in (b"one", b"two", b"one", "thrÉe".encode(), b"\x1ftwo")]
    assert sub.word_hashes(text).tolist() == want
    assert sub.word_hashes(b" \n").tolist() == []
    assert len(sub._HASHES) == 0


def test_alignments_that_cannot_hold_a_passage_are_not_scored(monkeypatch):
    def refused(hit):
        raise AssertionError("scored")

    a, b = np.arange(200, dtype=np.uint32), np.arange(1000, 1200, dtype=np.uint32)
    anchors = np.array([92, 110])
    b[90:130] = a[90:130]
    # Forty matches may be four fifths of fifty words, 39 are not.
    with monkeypatch.context() as patched:
        patched.setattr(sub, "_reach", refused)
        with pytest.raises(AssertionError, match="scored"):
            sub.align_chain(a, b, anchors, anchors, 0, 0)
        b[129] = 1
        assert sub.align_chain(a, b, anchors, anchors, 0, 0) == []
    b[80:90] = a[80:90]
    assert sub.align_chain(a, b, anchors, anchors, 0, 0) == []
    b[130:140] = a[130:140]
    assert sub.align_chain(a, b, anchors, anchors, 0, 0) == [(80, 140, 80, 140, 59 / 60)]


def test_passages_on_one_diagonal_have_the_identity_of_their_words():
    for seed in range(50):
        rng = np.random.default_rng(seed)
        a = rng.integers(0, 1 << 32, 300, dtype=np.uint32)
        b = np.where(rng.random(300) < 0.12, np.uint32(0), a)
        x = np.flatnonzero(np.convolve(a == b, np.ones(sub.SEED_WORDS, int), "valid") == sub.SEED_WORDS)[::3]
        pad = int(rng.integers(0, 30))
        found = sub.align_chain(a, np.concatenate([b[:pad] + np.uint32(1), b]), x + 7, x + pad + 9, 7, 9)
        assert found
        for begin, end, o_begin, o_end, same in found:
            assert begin - 7 == o_begin - pad - 9 and end - begin == o_end - o_begin >= sub.MIN_WORDS
            assert same == (a[begin - 7 : end - 7] == b[begin - 7 : end - 7]).mean() >= sub.IDENTITY


def test_hashes_are_ordered_by_all_their_bits_and_then_by_place():
    rng = np.random.default_rng(4)
    few = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    for hashes in (
        np.zeros(0, np.uint64),
        np.array([7], np.uint64),
        np.array([2**64 - 1, 0, 2**64 - 1], np.uint64),
        rng.integers(0, 1 << 64, 5000, dtype=np.uint64),
        rng.choice(few, 5000),
        # Different hashes with equal leading bits.
        rng.choice(few, 5000) ^ rng.integers(0, 4, 5000, dtype=np.uint64),
    ):
        assert sub._order(hashes).tolist() == np.argsort(hashes, kind="stable").tolist()


@pytest.mark.parametrize("copies, parts", [(2, 1), (2, 8), (4, 8)])
def test_edited_passages_behind_earlier_parts(spark, copies, parts):
    docs = []
    for t in range(30):
        rng = random.Random(500 + t)
        passage = words(rng, 90)
        held = [passage[:30], passage[30:60], passage[60:]]
        # No two copies share a run of fifty words.
        held += [replaced(rng, passage, set(range(2 * n, 90, 12))) for n in range(copies)]
        docs += [(10 * t + i, " ".join(words(rng, 50) + p + words(rng, 50))) for i, p in enumerate(held)]
    found = sub.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts))
    links = {(r["doc_id"], r["other_doc_id"]) for r in found.collect()}
    assert all(d // 10 == o // 10 and o % 10 >= 3 for d, o in links)
    linked = {d for link in links for d in link}
    assert sum(10 * t + 3 + n in linked for t in range(30) for n in range(copies)) >= 29 * copies


def test_a_line_that_all_documents_have_makes_no_seeds_of_two(spark):
    rng = random.Random(3)
    line = words(rng, 30)
    docs = [(i, " ".join(words(rng, 80) + line + words(rng, 80))) for i in range(60)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = rows.selectExpr("doc_id", "cast(text as binary) as text")
    first = sub.stored(sub._aligned(sub._matches(sub.in_arrow(rows, sub._collect_seeds, sub._SEEDS)), rows), "a")
    assert first.where("seed is null").count() == 0
    assert first.where("seed is not null").select("doc_id").distinct().count() == 60
    assert sub._left_over(first).count() == 0
