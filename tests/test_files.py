import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import ALARMS, OBSERVATIONS, bands, observations, systems

from normwatch import schemas, session
from normwatch.functions import date_as_written
from normwatch.plans.band_alarms import run_band_alarms
from normwatch.sinks import register_view, round_trip_parquet, write_json, write_parquet
from normwatch.sources import (
    from_json_text,
    read_json,
    read_observations,
    read_parquet,
    unwrap_envelope,
)

NOW = "2025-08-08 13:35:09"


def bag(df):
    return Counter(map(str, df.collect()))


def test_multiline_json_and_text_numbers(spark, tmp_path):
    rows = [dict(o) for o in OBSERVATIONS]
    rows[0] = dict(rows[0], result=dict(rows[0]["result"], numerieke_waarde="3.7"))
    (tmp_path / "observations.json").write_text(json.dumps(rows, indent=2))
    read = read_observations(spark, str(tmp_path / "observations.json"))
    assert bag(read) == bag(observations(spark))
    assert read.schema["result"].dataType["numerieke_waarde"].dataType.typeName() == "double"


def test_json_and_parquet_round_trips(spark, tmp_path):
    rows = observations(spark)
    write_json(rows, str(tmp_path / "json"))
    assert bag(read_observations(spark, str(tmp_path / "json"), multiline=False)) == bag(rows)
    again = round_trip_parquet(rows, str(tmp_path / "parquet"))
    assert again.exceptAll(rows).count() == 0 and rows.exceptAll(again).count() == 0
    assert bag(read_parquet(spark, str(tmp_path / "parquet"))) == bag(rows)


def test_envelope(spark, tmp_path):
    document = {"@context": None, "@graph": [{"_id": "1", "_type": None}, {"_id": "2"}]}
    (tmp_path / "doc.json").write_text(json.dumps(document, indent=1))
    record = schemas.T.StructType.fromDDL("_id string, _type string")
    documents = read_json(spark, str(tmp_path / "doc.json"), schemas.envelope(record))
    assert unwrap_envelope(documents).collect() == [("1", None), ("2", None)]
    texts = spark.createDataFrame([('{"_id": "1"}',), ("no json",)], "text string")
    assert from_json_text(texts, "text", record).collect() == [("1", None), (None, None)]


def test_alarm_job_partitions_by_date(spark, tmp_path):
    out = str(tmp_path / "out")
    written = run_band_alarms(systems(spark), bands(spark), observations(spark), out, as_of=NOW)
    assert written.count() == len(ALARMS)
    days = {p.name for p in (tmp_path / "out" / "json").glob("datum=*")}
    assert days == {"datum=2025-04-05", "datum=2025-04-06"}
    one_day = spark.read.parquet(f"{out}/parquet").where("datum = date '2025-04-06'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(datum" in plan
    assert one_day.count() == 5
    from_json = spark.read.json(f"{out}/json").select("_id", "result.value")
    assert bag(from_json) == bag(written.select("_id", "result.value"))


def test_random_ids_are_the_same_in_both_forms(spark, tmp_path):
    out = str(tmp_path / "out")
    run_band_alarms(systems(spark), bands(spark), observations(spark), out, id_mode="uuid")
    ids = spark.read.parquet(f"{out}/parquet").select("_id", "result._id")
    assert bag(ids) == bag(spark.read.json(f"{out}/json").select("_id", "result._id"))


def test_single_file_is_obeyed(spark, tmp_path):
    rows = spark.range(1000).repartition(4).withColumn("day", F.col("id") % 2)
    write_parquet(rows, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    write_parquet(rows, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 4
    write_parquet(rows, str(tmp_path / "days"), partition_by=["day"])
    assert spark.read.parquet(str(tmp_path / "days")).count() == 1000


def test_corrupt_texts_and_arrays(spark):
    record = schemas.T.StructType.fromDDL("k long, s string")
    texts = [('{"k": 1, "s": "a"}',), ("{bad",), ('[{"k": 2}, {"k": 3}]',), (None,), ("[]",)]
    rows = from_json_text(spark.createDataFrame(texts, "text string"), "text", record, "lost")
    got = sorted(map(tuple, rows.collect()), key=str)
    want = [(1, "a", None), (2, None, None), (3, None, None), (None, None, "{bad"), (None, None, None)]
    assert got == sorted(want, key=str)


def test_far_dates_are_read_as_written(spark):
    row = spark.sql("select '12025-04-06T01:02:03Z' as t").select(date_as_written(F.col("t")).cast("string"))
    assert row.first()[0] == "+12025-04-06"


def test_views(spark):
    register_view(observations(spark), "sample_observations")
    assert spark.sql("SELECT count(*) AS n FROM sample_observations").first()["n"] == 21


def test_shared_folder_comes_from_the_session(spark):
    first = session.shared_dir(spark)
    assert session.shared_dir(spark) == first
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_a_cluster_must_name_its_folder():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
