"""Benchmark passages in documents, found through a distributed positional inverted index.

The index is a written table of postings, one row for each word of each document, sorted within its
files by a hash of the word.  A phrase is found from its rarest words: the postings of the rarest
one, shifted by its place in the phrase, are candidate places; they are intersected with the shifted
postings of the second rarest, and what is left with those of all other words.  Everything is joins
and aggregates of built-in functions.  Words of phrases are sent to the index if they are few;
candidates, which grow with the documents, meet it in a merge join at every size.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normwatch.llm.common import bounded_side, stored, table

WINDOW = 10
# What ends a word; all other characters are part of one.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Begins the entry that ends a document, of which the rest is its id; it is in no word.
END = "\0"
# Generous bytes in memory of a row of the small tables that are sent to the index.
_ROW_BYTES = 160
# Rows (documents) that are sent to the index take up to this; more are met by a shuffle.
_DOCUMENT_BYTES = 32
_DOCUMENTS_LIMIT = 64 * 1024 * 1024


def words(text: Column) -> Column:
    """The words of a text as array; A-Z are lower-cased.  Null and empty texts have none."""
    lowered = F.translate(
        F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.array_remove(F.split(lowered, BREAKS), "")


def build_index(docs: DataFrame) -> DataFrame:
    """Write the postings of ``docs`` (doc_id, text) and return them.

    Columns: row (a number for every row of ``docs``, repeated and null ids included), term, pos from
    0.  Each document ends with an entry that is no word: ``END`` and the doc_id, if it has one, at
    the position after the last word; so those without words are known too.  Whole texts are
    indexed, whatever their length; other columns are ignored.
    """
    end = F.concat(F.lit(END), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")))
    named = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.concat(words(F.col("text")), F.array(end)).alias("words"),
    )
    postings = named.select("row", F.posexplode("words").alias("pos", "term"))
    return stored(postings.sortWithinPartitions(F.xxhash64("term")), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    """row, doc_id and n_words of every indexed row."""
    ends = index.where(F.col("term").startswith(END))
    doc = F.nullif(F.substring("term", 2, 20), F.lit("")).cast("long")
    return ends.select("row", doc.alias("doc_id"), F.col("pos").cast("long").alias("n_words"))


def postings_of(index: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of the written ``terms`` (term, ...)."""
    own = stored(terms.select("term").distinct(), "terms")
    return index.join(bounded_side(own, _ROW_BYTES), "term", "left_semi")


def phrase_words(items: DataFrame) -> DataFrame:
    """phrase, offset, term and size (its number of words) for every distinct sequence of words of
    ``items`` (text); phrase is a digest of the sequence.  Texts without words have no rows."""
    found = items.select(words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    return found.select(
        phrase_digest(F.col("words")).alias("phrase"),
        F.size("words").alias("size"),
        F.posexplode("words").alias("offset", "term"),
    )


def phrase_digest(sequence: Column) -> Column:
    """The digest of a sequence of words (which hold no spaces)."""
    return F.sha2(F.array_join(sequence, " "), 256)


def _counted_terms(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrases with n, the number of postings of their term.  Absent terms have no rows."""
    counts = postings_of(index, phrases).groupBy("term").agg(F.count("*").alias("n"))
    return phrases.join(counts, "term")


def _window_pairs(counted: DataFrame, length: int) -> DataFrame:
    """phrase, start, size and the places first and second of the two rarest words of each window.

    Windows with a word that the index lacks are left out: they occur nowhere.
    """
    starts = F.sequence(
        F.greatest(F.lit(0), F.col("offset") - F.lit(length - 1)),
        F.least(F.col("offset"), F.greatest(F.lit(0), F.col("size") - F.lit(length))),
    )
    placed = counted.select("phrase", "size", "offset", "n", F.explode(starts).alias("start"))
    rarest = F.sort_array(F.collect_list(F.struct("n", "offset"))).alias("rarest")
    windows = placed.groupBy("phrase", "start", "size").agg(rarest)
    whole = windows.where(F.size("rarest") == F.least(F.lit(length), F.col("size")))
    return whole.select(
        "phrase",
        "start",
        "size",
        F.col("rarest")[0]["offset"].alias("first"),
        F.coalesce(F.get("rarest", F.lit(1))["offset"], F.col("rarest")[0]["offset"]).alias("second"),
    )


def _present(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (row, pos, term, ...) whose posting exists.

    A place of a document has one posting, so the join neither repeats rows nor has hot keys.
    """
    return postings.join(wanted.hint("merge"), ["row", "pos", "term"])


def phrase_matches(index: DataFrame, phrases: DataFrame, length: int = WINDOW) -> DataFrame:
    """Where windows of ``length`` consecutive words of the phrases occur in the index.

    ``phrases`` as ``phrase_words`` gives it.  A phrase of fewer words is one window.  Returns
    phrase, row, begin and end: runs of document words (end included) of which every
    window is one of the phrase, the longest such runs.  Each is returned once.
    """
    if length < 1:
        raise ValueError("a window has at least one word")
    counted = stored(_counted_terms(index, phrases), "counted")
    windows = stored(_window_pairs(counted, length), "windows")
    spelled = counted.select("phrase", "offset", "term")

    # The rarest word of each window: its postings, shifted, are the candidates.
    firsts = windows.select("phrase", F.col("first").alias("offset")).distinct()
    anchors = stored(firsts.join(spelled, ["phrase", "offset"]), "anchors")
    rare = postings_of(index, anchors).join(bounded_side(anchors, _ROW_BYTES), "term")
    shifted = (F.col("pos") - F.col("offset")).alias("diagonal")
    candidates = rare.select("phrase", F.col("offset").alias("first"), "row", shifted).distinct()

    # Intersected with the second rarest.
    pairs = windows.select("phrase", "first", "second").distinct()
    seconds = pairs.join(spelled.withColumnRenamed("offset", "second"), ["phrase", "second"])
    seconds = stored(seconds, "seconds")
    wanted = candidates.join(bounded_side(seconds, _ROW_BYTES), ["phrase", "first"]).withColumn(
        "pos", F.col("diagonal") + F.col("second")
    )
    both = _present(postings_of(index, seconds), wanted)
    both = stored(both.select("phrase", "first", "second", "row", "diagonal"), "both")

    # What is left with all other words of the windows.
    offsets = F.sequence("start", F.col("start") + F.least(F.lit(length), F.col("size")) - 1)
    covered = windows.select(
        "phrase", "first", "second", "size", F.explode(offsets).alias("offset")
    ).distinct()
    covered = stored(covered.join(spelled, ["phrase", "offset"]), "covered")
    keys = ["phrase", "first", "second"]
    places = both.join(bounded_side(covered, _ROW_BYTES), keys).select(
        "phrase", "size", "row", "diagonal", "offset", "term",
        (F.col("diagonal") + F.col("offset")).alias("pos"),
    )
    places = stored(places.distinct(), "places")
    # Documents with candidates are few, or met by the shuffle of the join that follows.
    rows = stored(both.select("row").distinct(), "rows")
    if rows.count() * _DOCUMENT_BYTES <= _DOCUMENTS_LIMIT:
        index = index.join(F.broadcast(rows), "row", "left_semi")
    found = _present(index, places)

    # Unbroken runs of found words along one diagonal.
    line = Window.partitionBy("phrase", "size", "row", "diagonal").orderBy("offset")
    runs = found.withColumn("run", F.col("offset") - F.row_number().over(line))
    runs = runs.groupBy("phrase", "size", "row", "diagonal", "run").agg(
        F.min("pos").alias("begin"), F.max("pos").alias("end")
    )
    full = runs.where(F.col("end") - F.col("begin") + 1 >= F.least(F.lit(length), F.col("size")))
    return full.select("phrase", "row", "begin", "end")


def proximity_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """Where all distinct words of a phrase occur, in any order, among ``within`` consecutive words.

    Returns phrase, row, begin: every document word from which on the next
    ``within`` words hold them all and that is one of them.  Candidates are the places around the
    rarest word of each phrase.
    """
    if within < 1:
        raise ValueError("at least one word")
    counted = stored(_counted_terms(index, phrases), "counted")
    needed = phrases.groupBy("phrase").agg(F.countDistinct("term").alias("n_terms"))
    own = counted.select("phrase", "term", "n").distinct()
    ranked = own.withColumn(
        "rank", F.row_number().over(Window.partitionBy("phrase").orderBy("n", "term"))
    )
    ranked = ranked.withColumn("known", F.count("*").over(Window.partitionBy("phrase")))
    ranked = ranked.join(needed, "phrase").where(F.col("known") == F.col("n_terms"))
    ranked = stored(ranked.select("phrase", "term", "rank", "n_terms"), "ranked")
    rarest = bounded_side(ranked.where("rank = 1"), _ROW_BYTES)
    # Windows begin at most within - 1 words before the rarest word; blocks make that an equality.
    centre = postings_of(index, ranked.where("rank = 1")).join(rarest, "term").select("phrase", "row", "pos")
    block = F.floor(F.col("pos") / within)
    around = centre.select(
        "phrase", "row", F.explode(F.array(block - 1, block, block + 1)).alias("block")
    ).distinct()
    postings = postings_of(index, ranked).join(bounded_side(ranked, _ROW_BYTES), "term")
    postings = postings.select("phrase", "rank", "n_terms", "row", "pos", block.alias("block"))
    close = postings.join(around, ["phrase", "row", "block"], "left_semi")
    ahead = Window.partitionBy("phrase", "row").orderBy("pos").rangeBetween(0, within - 1)
    held = close.withColumn("held", F.size(F.collect_set("rank").over(ahead)))
    return held.where(F.col("held") == F.col("n_terms")).select(
        "phrase", "row", F.col("pos").alias("begin")
    )


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids, contaminated.

    ``items`` has item_id and text.  A word is hit if it lies in an occurrence of a window of
    ``length`` consecutive words of an item; an item of fewer words, but not none, is one window.
    item_ids are the distinct ids, as text and sorted, of items with such windows.  Null and empty
    texts have no words; an item with a null id hits words but is not listed.  Items of equal words
    are all listed; rows and items that repeat change nothing but the number of rows returned.
    Very long texts are used whole, extra columns are ignored, and empty tables give no hits.
    """
    index = build_index(docs)
    phrases = stored(phrase_words(items), "phrases")
    matches = stored(phrase_matches(index, phrases, length), "matches")
    hit = matches.select("row", F.explode(F.sequence("begin", "end")).alias("pos")).distinct()
    hit = hit.groupBy("row").agg(F.count("*").alias("n_hit"))
    named = items.select(
        phrase_digest(words(F.col("text"))).alias("phrase"),
        F.col("item_id").cast("string").alias("item"),
    ).distinct()
    listed = matches.select("phrase", "row").distinct().join(named, "phrase")
    listed = listed.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    none = F.array().cast("array<string>")
    found = documents_of(index).join(hit.join(listed, "row"), "row", "left")
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("item_ids", none)).cast("long").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    """All rows of ``documents`` against all of ``benchmark``."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


# A window is compared as text; words hold no spaces.
OP11_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), item AS (
  SELECT item_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM item WHERE len(w) > 0)
), doc_window AS (
  SELECT r, s, size, array_to_string(w[s:s + size - 1], ' ') AS phrase
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM doc, (SELECT DISTINCT size FROM item_window))
), match AS (
  SELECT r, s, d.size, item_id FROM doc_window d JOIN item_window i ON d.phrase = i.phrase AND d.size = i.size
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(s, s + size)) AS p FROM match) GROUP BY r
), listed AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT cast(item_id AS VARCHAR), ',' ORDER BY cast(item_id AS VARCHAR)) AS ids
  FROM match GROUP BY r
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       cast(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""
