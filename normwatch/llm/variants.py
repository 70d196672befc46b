"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols.  Words one edit apart have reduced words that are equal or one
edit apart, so the full one-edit neighbourhood of each reduced word, joined with the reduced words
that exist, finds all candidates by equality.  Candidates are verified on the words themselves.
Neighbourhoods are generated once for each reduced word, and not for each word.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.llm.common import stored, table

RUN_BREAKS = r"[^A-Za-zÀ-ÿ]+"
MIN_LETTERS = 6
MIN_COUNT = 5
# One run in so many loses a letter.
DAMAGED = 199
# A word is a form of another if it is so many times as frequent.
RATIO = 5
# Symbols of the reduced alphabet: the vocabulary to this power, so that few words share a reduced one.
ALPHABET_POWER = 1 / 8
_LETTERS = string.ascii_lowercase + "".join(map(chr, range(0xC0, 0x100)))
_SYMBOLS = string.ascii_uppercase


def word_counts(
    docs: DataFrame, damaged: int = DAMAGED, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """word and n: the words of at least ``min_letters`` letters that occur ``min_count`` times.

    A word is a maximal run of letters with A-Z lower-cased.  With h the CRC-32 of
    ``<doc_id>:<run>``, runs whose h ``damaged`` divides lose their letter at h modulo their length.
    A null doc_id is written as nothing.  Null and empty texts have no words; texts are used whole.
    """
    runs = F.filter(
        F.split(F.col("text").cast("string"), RUN_BREAKS), lambda w: F.length(w) >= min_letters
    )
    doc = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    lowered = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    found = docs.select(doc.alias("doc"), F.explode(runs).alias("run"))
    found = found.select("doc", lowered.alias("run"))
    found = found.withColumn("h", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(
        F.substring(F.col("run"), F.lit(1), at),
        F.substring(F.col("run"), at + 2, F.length("run")),
    )
    word = F.when(F.col("h") % damaged == 0, shorter).otherwise(F.col("run"))
    words = found.select(word.alias("word")).where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def alphabet_size(vocabulary: int) -> int:
    """How many symbols letters are hashed to: more for larger vocabularies, 4 to 26."""
    return min(26, max(4, math.ceil(vocabulary**ALPHABET_POWER)))


def reduced(word: Column, symbols: int) -> Column:
    """The word with each letter replaced by its symbol, its code point modulo ``symbols``."""
    return F.translate(word, _LETTERS, "".join(_SYMBOLS[ord(c) % symbols] for c in _LETTERS))


def one_edit_neighbours(word: Column, symbols: int) -> Column:
    """The word itself and all words one inserted, deleted or replaced symbol away, as a set."""
    letters = F.array(*[F.lit(s) for s in _SYMBOLS[:symbols]])
    size = F.length(word)

    def head(i: Column) -> Column:
        return F.substring(word, F.lit(1), i)

    def tail(i: Column) -> Column:
        return F.substring(word, i + 1, size)

    places = F.sequence(F.lit(0), size)
    inner = F.sequence(F.lit(0), size - 1)
    deleted = F.transform(inner, lambda i: F.concat(head(i), tail(i + 1)))
    replaced = F.flatten(
        F.transform(inner, lambda i: F.transform(letters, lambda s: F.concat(head(i), s, tail(i + 1))))
    )
    inserted = F.flatten(
        F.transform(places, lambda i: F.transform(letters, lambda s: F.concat(head(i), s, tail(i))))
    )
    return F.array_distinct(F.concat(F.array(word), deleted, replaced, inserted))


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """word, n, near, near_n for all ordered pairs of distinct words that are exactly one edit apart.

    ``words`` has word (each once, letters of a-z and U+00C0 to U+00FF) and n.
    """
    if symbols is None:
        symbols = alphabet_size(words.count())
    coded = stored(words.select(reduced(F.col("word"), symbols).alias("code"), "word", "n"), "coded")
    codes = stored(coded.select("code").distinct(), "codes")
    around = codes.select(
        F.col("code").alias("a"), F.explode(one_edit_neighbours(F.col("code"), symbols)).alias("b")
    )
    # Both of two neighbours find each other; the one that is first in order is enough.  Neighbours
    # that no word reduces to go before anything is joined to words.
    one_way = around.where("a <= b").join(codes.select(F.col("code").alias("b")).hint("merge"), "b")
    one_way = stored(one_way.select("a", "b"), "neighbours")
    turned = one_way.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))
    pairs = one_way.union(turned).select(F.col("a").alias("code"), F.col("b").alias("other"))
    mine = pairs.join(coded, "code").select("other", "word", "n")
    theirs = coded.select(
        F.col("code").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    met = mine.join(theirs, "other").where(F.levenshtein("word", "near", 1) == 1)
    return met.select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word and root for the words of ``forms`` (word, form): forms followed to the last.

    Each round follows twice as far; forms grow in count by ``RATIO`` each step, so there is an end.
    """
    current = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = current.join(ahead, "root", "left")
        moved = stored(moved.select("word", "root", "next"), "moved")
        if moved.where("next is not null").isEmpty():
            return current
        current = moved.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, symbols: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n and root for every word of ``words`` (word, n).

    n_near counts the words exactly one edit away.  form is the most frequent of them (ties: the
    first in code-point order) if it is at least ``ratio`` times as frequent, else null.  root is
    where following forms ends, the word itself if it has none.  An empty table gives no rows.
    """
    words = stored(words.select("word", "n"), "words")
    # The least of these is the most frequent word, the first in code-point order among equals.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    each = near_words(words, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best)
    named = stored(words.join(each, "word", "left"), "named")
    form_n = -F.col("best.less")
    follows = form_n >= ratio * F.col("n")
    named = named.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(follows, F.col("best.near")).alias("form"),
        F.when(follows, form_n).cast("long").alias("form_n"),
    )
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """The words of all rows of ``documents``."""
    words = word_counts(table(spark, sf_dir, "documents"))
    found = spelling_variants(words)
    return found.select("word", "n", "n_near", "form", "form_n", "root")
