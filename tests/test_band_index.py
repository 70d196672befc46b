"""Bands found by the index against comparing each with each."""

import math
import random

import pytest
from pyspark.sql import functions as F

from normwatch.operators import band_index
from normwatch.operators.alarms import match_bands

OBSERVED = (
    "_id string, hasFeatureOfInterest string, observedProperty string, "
    "result struct<numerieke_waarde: double>, resultTime string"
)
BAND = "lzsid string, parameter string, bbid string, minValue double, maxValue double"


def inside(v, low, high):
    if v is None:
        return low is None and high is None
    # NaN is above all numbers.
    key = lambda x: (1, 0) if math.isnan(x) else (0, x)
    return (low is None or key(v) > key(low)) and (high is None or key(v) < key(high))


def found(spark, rows, bands, many):
    observed = [(i, s, p, (v,), "t") for i, s, p, v in rows]
    table = spark.createDataFrame(observed, OBSERVED).repartition(3)
    joined = match_bands(table, spark.createDataFrame(bands, BAND), many=many)
    return sorted((r["_id"], r["bbid"]) for r in joined.select("_id", "bbid").collect())


def brute(rows, bands):
    return sorted(
        (i, b)
        for i, s, p, v in rows
        for system, parameter, b, low, high in bands
        if s is not None and p is not None and (s, p) == (system, parameter) and inside(v, low, high)
    )


@pytest.mark.parametrize("seed,chunk", [(0, 256), (1, 4), (2, 1), (3, 7)])
def test_random_bands(spark, seed, chunk, monkeypatch):
    monkeypatch.setattr(band_index, "CHUNK", chunk)
    rng = random.Random(seed)
    numbers = [-1e300, -2.5, -0.0, 0.0, 1.0, 2.0, 2.5, 3.0, 7.0, 1e300, math.nan]

    def bound():
        return rng.choice([None, rng.choice(numbers), round(rng.uniform(-5, 9), 1)])

    keys = [("s1", "p1"), ("s1", "p2"), ("s2", "p1"), (None, "p1"), ("s1", None)]
    weights = [10, 2, 1, 1, 1]
    bands = [(*rng.choices(keys, weights)[0], f"b{i:03}", bound(), bound()) for i in range(150)]
    rows = []
    for i in range(200):
        value = rng.choice([None, rng.choice(numbers), round(rng.uniform(-6, 10), 1)])
        rows.append((f"o{i:03}", *rng.choices(keys, weights)[0], value))
    want = brute(rows, bands)
    assert want
    for many in (1, 20, 10_000):
        assert found(spark, rows, bands, many) == want


def test_nothing_to_match(spark):
    rows = [("o1", "s1", "p1", 1.0)]
    assert found(spark, rows, [], 1) == []
    assert found(spark, [], [("s1", "p1", "b", 0.0, 2.0)], 1) == []
    assert found(spark, rows, [("s1", "p1", "b", None, None)], 1) == [("o1", "b")]


def test_ten_thousand_bands_of_one_key(spark):
    """The last join gives matches only, and probes grow with the logarithm of the bands."""
    n = 10_000
    bands = spark.range(n).select(
        F.lit("s").alias("lzsid"), F.lit("p").alias("parameter"), F.concat(F.lit("b"), "id").alias("bbid"),
        F.col("id").cast("double").alias("minValue"), (F.col("id") + 3).cast("double").alias("maxValue"),
    )
    rows = spark.range(20_000).select(
        F.concat(F.lit("o"), "id").alias("_id"), F.lit("s").alias("hasFeatureOfInterest"),
        F.lit("p").alias("observedProperty"), F.struct((F.col("id") / 2).alias("numerieke_waarde")).alias("result"),
        F.lit("t").alias("resultTime"),
    )
    index = band_index.BandIndex(bands, ["lzsid", "parameter"])
    assert index.levels == 5
    # A band covers the slots of two bounds and three gaps, each a block at most.
    assert index.blocks.count() <= 5 * n
    joined = match_bands(rows, bands, many=64)
    # Half of the values are bounds: those lie in two bands, the others in three.
    # The first two of each have fewer below them.
    assert joined.count() == (2 * n - 3) + (3 * n - 3)
    assert joined.where("result.numerieke_waarde <= minValue or result.numerieke_waarde >= maxValue").isEmpty()


def test_rows_of_a_full_block_are_dealt_over_salts(spark):
    bands = [("k", f"b{i}", float(i % 7), None if i % 3 == 0 else float(i % 7 + 20)) for i in range(40)]
    rows = [("k", i, i * 0.5) for i in range(60)] + [("k", 59, 29.5), ("other", 1, 5.0)]
    table = spark.createDataFrame(bands, "key string, band string, minValue double, maxValue double")
    index = band_index.BandIndex(table, ["key"], full_block=4)
    given = spark.createDataFrame(rows, "of string, no int, v double")
    found = index.matches(given, ["of"], F.col("v"), block_matches=50)
    assert sorted((r["no"], r["band"]) for r in found.collect()) == sorted(
        (no, band)
        for of, no, v in rows
        for key, band, low, high in bands
        if of == key and v > low and (high is None or v < high)
    )
    met = spark.createDataFrame([("k", 0, 0, 100)], "of string, l_ int, n_ long, n_slot long")
    full = spark.createDataFrame([("k", 0, 0, 20)], "f_key string, f_level int, f_block long, n_bands long")
    index.full = full
    assert index._spread(met, [("of", "key")], 50).first()["salts"] == 40
