"""Every catalogued query against the same question asked in SQL of another engine."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from normwatch.plans.catalog import QUERIES
from normwatch.plans.oracle import ORACLES

SF_DIR = os.environ.get("NORMWATCH_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def check(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in df.collect()]
    assert rows, "an empty result checks nothing"
    if name not in ORACLES:
        return
    relation = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, rows) == rows_of(relation.columns, relation.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize(
    "name",
    [
        "q15_bands_with_operating",
        "q20_alarm_report",
        "q27_constraint_report",
        "q28_constructed_alarms_joined",
        "q32_path_values",
        "q34_framed_observations",
        "q35_framed_alarms_json",
        "q39_inferred_types",
        "q40_price_report",
    ],
)
def test_query_matches_sql_when_nothing_can_be_broadcast(spark, duck, name, monkeypatch):
    """The way the joins go on large tables with hot keys."""
    from normwatch.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(spark, duck, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_random_results_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"q24_alarms_uuid"}
    assert set(ORACLES) <= set(QUERIES)
