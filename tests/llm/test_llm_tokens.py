import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken
from llm_cases import ROWS, edge_docs, no_docs
from tokenizers import Tokenizer

from normwatch.llm import bpe, pretokens
from normwatch.llm import token_counts as tc

RANKS = public.path("byte_bpe_multi_50k.tiktoken")
MERGES = public.path("byte_bpe_50k.json")
LETTERS = "ab eE'stx 1\n\t \r\x0b\x0c\x1c\x1f\x85\xa0　éß漢🙂.,!?-_​́٣Ⅷ²"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    odd = ["", " ", "  ", "\n ", " \n", "a" * 3000, " " * 300 + "x", "aaab" * 500, "it's  'll"]
    return made + odd + [t for _, t, _ in ROWS if t]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(RANKS))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def test_hash_is_perfect_and_minimal(vocabulary):
    tokens = vocabulary.tokens
    assert sorted(vocabulary.perfect.place(tokens)) == list(range(len(tokens)))
    assert vocabulary.whole([b"the", b"no such token", b""]) == [vocabulary.ranks[b"the"], -1, -1]
    for few in ([], [b"a"], [b"a", b"b", b"ab"]):
        own = bpe.Vocabulary({t: i for i, t in enumerate(few)})
        assert own.whole(few) == list(range(len(few)))


def test_ids_equal_the_library(vocabulary, library, texts):
    table = pretokens.PieceTable(public.PATTERN, vocabulary.encode_tokens)
    ids = list(table.values([table.numbers(t) for t in texts]))
    for text, found in zip(texts, ids):
        assert found.tolist() == library.encode_ordinary(text)
        assert vocabulary.decode(found.tolist()) == text.encode()


def test_counts_equal_the_library(texts):
    merges = tc.MergeTable.read(MERGES)
    table = pretokens.PieceTable(public.PATTERN, lambda t: merges.counts(t).reshape(-1, 1).tolist())
    counts = [int(v.sum()) for v in table.values([table.numbers(t) for t in texts])]
    library = Tokenizer.from_file(MERGES)
    assert counts == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_encoded_rows(spark, library):
    docs = edge_docs(spark)
    rows = bpe.encoded_digests(docs, RANKS, public.PATTERN).collect()
    want = []
    for i, text, _ in ROWS:
        ids = library.encode_ordinary(text or "")
        joined = ",".join(map(str, ids)).encode()
        want.append(
            (
                i or -1,
                len(ids),
                hashlib.sha256(joined).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    assert sorted((r[0] or -1, *r[1:]) for r in rows) == sorted(want)
    encoded = bpe.encode(docs, RANKS, public.PATTERN)
    back = bpe.decode(encoded, RANKS).select("doc_id", "decoded").collect()
    assert sorted((r[0] or -1, bytes(r[1])) for r in back) == sorted(
        (i or -1, (t or "").encode()) for i, t, _ in ROWS
    )
    assert bpe.encode(no_docs(spark), RANKS, public.PATTERN).count() == 0


def test_counted_rows_with_special_strings(spark):
    texts = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", None, "x " * 1024, "x " * 1025]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.unionByName(edge_docs(spark).select("doc_id", "text"))
    rows = tc.token_counts(docs, MERGES, public.PATTERN).collect()
    library = Tokenizer.from_file(MERGES)
    want = []
    for i, text in [*enumerate(texts), *((i, t) for i, t, _ in ROWS)]:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((-1 if i is None else i, len((text or "").encode()), n, n > 1024))
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows) == sorted(want)
    assert tc.token_counts(no_docs(spark), MERGES, public.PATTERN).count() == 0


def test_forgetting_pieces_changes_nothing(vocabulary, library, texts, monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 10)
    table = pretokens.PieceTable(public.PATTERN, vocabulary.encode_tokens)
    for text in texts[:200]:
        found = list(table.values([table.numbers(text)]))
        assert found[0].tolist() == library.encode_ordinary(text)
        table.tidy()


def test_pieces_are_bounded_by_their_letters(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED_LETTERS", 100_000)
    table = pretokens.PieceTable(public.PATTERN, vocabulary.encode_tokens)
    rng = random.Random(4)
    for _ in range(40):
        text = "".join(rng.choice("abcdé漢") for _ in range(20_000))
        found = list(table.values([table.numbers(text)]))
        assert found[0].tolist() == library.encode_ordinary(text)
        table.tidy()
        assert sum(map(len, [*table.led, *table.bare])) <= 100_000
