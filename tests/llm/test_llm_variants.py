import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import edge_docs, no_docs, texts_of
from pyspark.sql import functions as F

from normwatch.llm import variants as va


def counted(docs, damaged=199, least=5):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % damaged == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= least}


def near(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=5):
    form, rows = {}, []
    beside = {w: [v for v in words if near(w, v)] for w in words}
    for w, found in beside.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, n, len(beside[w]), form.get(w), words.get(form.get(w)), root))
    return sorted(rows)


def collected(found):
    return sorted(map(tuple, found.select("word", "n", "n_near", "form", "form_n", "root").collect()))


@pytest.mark.parametrize("symbols", [None, 4, 26])
def test_random_words_against_all_pairs(spark, symbols):
    rng = random.Random(7)
    words = {"".join(rng.choice("abÿq") for _ in range(rng.randint(5, 8))): 0 for _ in range(500)}
    words = {w: 5 ** rng.randint(0, 5) + rng.randint(0, 1) for w in words}
    table = spark.createDataFrame(list(words.items()), "word string, n long").withColumn("code", F.lit("own"))
    want = brute(words)
    assert collected(va.spelling_variants(table, symbols=symbols)) == want
    # Forms of forms of forms are followed.
    forms = {r[0]: r[3] for r in want}
    assert any(forms.get(forms.get(forms[w])) for w in forms if forms[w])


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdez": 25, "abcdeé": 25, "bcdef": 24, "zzzzzz": 9}
    found = collected(va.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert found == brute(words)
    assert found[0] == ("abcdef", 5, 4, "abcdeg", 25, "abcdeg")


def test_counted_words(spark):
    docs = [(i, "Wörter ÄPFEL×÷Bäume appleſ Strasse STRASSE strassen") for i in range(400)]
    docs += [(None, "Strasse strassen"), (None, None), (401, ""), (401, "strassen " * 3000)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("own"))
    for damaged in (199, 3):
        got = {r["word"]: r["n"] for r in va.word_counts(table, damaged).collect()}
        assert got == counted(docs, damaged)


def test_edge_rows_and_empty_tables(spark):
    words = counted(texts_of(), least=5)
    # texts_of writes null texts as empty; null ids stay.
    assert collected(va.spelling_variants(va.word_counts(edge_docs(spark)))) == brute(words)
    assert va.spelling_variants(va.word_counts(no_docs(spark))).count() == 0


def test_alphabet_grows_with_the_vocabulary():
    assert [va.alphabet_size(n) for n in (0, 1, 10**5, 10**8, 10**30)] == [4, 4, 5, 10, 26]
