"""Writing again to what is there."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from normwatch.sinks.late import add_late, bloom_words, new_rows, replace_dates, screened

SCHEMA = "_id string, datum date, v int"
ONE, TWO = dt.date(2025, 4, 5), dt.date(2025, 4, 6)


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def read(spark, path, format_="parquet"):
    found = spark.read.schema(SCHEMA).format(format_).load(str(path)).collect()
    return sorted(((r["_id"], r["datum"], r["v"]) for r in found), key=str)


def files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("part-*")}


@pytest.mark.parametrize("format_", ["parquet", "json"])
def test_late_rows_are_added_once(spark, tmp_path, format_):
    path = tmp_path / "out"
    first = rows(spark, ("a", ONE, 1), ("b", TWO, 2), ("n", None, 3))
    assert add_late(first, str(path), format_=format_).count() == 3
    before = files(path)
    # a and n are there, c comes twice, b comes with another date.
    late = rows(spark, ("a", ONE, 9), ("c", ONE, 4), ("c", ONE, 4), ("b", ONE, 5), ("n", None, 9))
    assert sorted(r["_id"] for r in add_late(late, str(path), format_=format_).collect()) == ["b", "c"]
    assert add_late(late, str(path), format_=format_).count() == 0
    want = [("a", ONE, 1), ("b", ONE, 5), ("b", TWO, 2), ("c", ONE, 4), ("n", None, 3)]
    assert read(spark, path, format_) == sorted(want, key=str)
    # Nothing that was there was written again.
    assert before.items() <= files(path).items()


def test_rows_without_an_id_are_always_new(spark, tmp_path):
    path = str(tmp_path / "out")
    some = rows(spark, (None, ONE, 1), (None, ONE, 1))
    for n in (2, 4):
        add_late(some, path)
        assert len(read(spark, path)) == n
    assert add_late(some.where("false"), path).count() == 0
    assert new_rows(rows(spark, ("a", ONE, 1)), str(tmp_path / "nowhere")).count() == 1


def test_one_date_is_replaced(spark, tmp_path):
    path = tmp_path / "out"
    replace_dates(rows(spark, ("a", ONE, 1), ("b", ONE, 1), ("c", TWO, 1)), str(path))
    kept = {p: t for p, t in files(path).items() if f"datum={TWO}" in str(p)}
    replace_dates(rows(spark, ("a", ONE, 2)), str(path))
    assert read(spark, path) == [("a", ONE, 2), ("c", TWO, 1)]
    assert kept.items() <= files(path).items()
    replace_dates(rows(spark).where("false"), str(path))
    assert len(read(spark, path)) == 2


@pytest.mark.parametrize("words", [1, 64, 1 << 12])
def test_the_filter_holds_all_it_was_given(spark, words):
    ids = spark.range(500).select(F.concat(F.lit("id"), "id").alias("k"))
    others = spark.range(500, 5500).select(F.concat(F.lit("id"), "id").alias("k"))
    filter_ = bloom_words(ids, "k", words)
    assert filter_.count() <= words
    assert screened(ids, "k", filter_, words).count() == 500
    through = screened(others, "k", filter_, words).count()
    # An overfull filter lets all through, a sparse one hardly any.
    assert through <= {1: 5000, 64: 5000, 1 << 12: 50}[words]
