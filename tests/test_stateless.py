"""Matching and validation keep no state, so they accept a stream of observations as it is."""

from collections import Counter

from samples import ALARMS, bands, observations, systems
from test_rules import RULES

from normwatch.operators.alarms import match_bands
from normwatch.operators.bands import resolve_bands
from normwatch.operators.rules import validate


def drain(df, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def test_streamed_observations(spark, tmp_path):
    path = str(tmp_path / "observations")
    observations(spark).write.parquet(path)
    stream = spark.readStream.schema(observations(spark).schema).parquet(path)
    absolute = resolve_bands(systems(spark), bands(spark))
    matched = match_bands(stream, absolute).select("resultTime", "bbid", "result.numerieke_waarde")
    assert Counter(map(tuple, drain(matched, "matched").collect())) == Counter(ALARMS)
    assert drain(validate(stream, RULES), "report").count() == 1
