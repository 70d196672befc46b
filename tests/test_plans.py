"""What the plans must look like: pruned scans, pushed filters, no needless shuffles."""

import os

import pytest
from samples import bands, observations, systems
from test_rules import RULES

from normwatch.operators.alarms import alarm_observations, alarm_report
from normwatch.operators.bands import resolve_bands
from normwatch.operators.rules import construct_alarms, validate
from normwatch.operators.triples import to_triples
from normwatch.plans import testviews as tv
from normwatch.plans.catalog import QUERIES
from normwatch.sources import STANDARD_CONTEXT


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(plan):
    return [line for line in plan.splitlines() if "FileScan parquet" in line]


def shuffles(plan):
    return plan.replace("BroadcastExchange", "").count("Exchange ")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    # Scans are shown in full.
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    frames = {}
    for name, df in (("o", observations(spark)), ("s", systems(spark)), ("b", bands(spark))):
        df.write.parquet(str(root / name))
        frames[name] = spark.read.parquet(str(root / name))
    yield frames
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_report_reads_one_number_and_shuffles_nothing(stored):
    absolute = resolve_bands(stored["s"], stored["b"], unique_ids=True)
    plan = plan_of(alarm_report(stored["o"], absolute))
    assert shuffles(plan) == 0
    observed = next(line for line in scan_of(plan) if "observedProperty" in line)
    assert "result:struct<numerieke_waarde:double>" in observed
    assert "_type" not in observed.split("ReadSchema")[1]
    assert "IsNotNull(observedProperty)" in observed
    system = next(line for line in scan_of(plan) if "hasOperatingRange" in line)
    assert "label" not in system and "asWKT" not in system


def test_alarm_records_read_the_unit_too(stored):
    absolute = resolve_bands(stored["s"], stored["b"], unique_ids=True)
    plan = plan_of(alarm_observations(stored["o"], absolute))
    observed = next(line for line in scan_of(plan) if "observedProperty" in line)
    assert "result:struct<eenheid:string,numerieke_waarde:double>" in observed


def test_rules_filter_in_the_scan_and_need_one_pass(stored):
    alarms = construct_alarms(validate(stored["o"], RULES))
    plan = plan_of(alarms)
    assert len(scan_of(plan)) == 1
    assert shuffles(plan) == 0
    assert "In(observedProperty, [prop:irrigation,prop:ph])" in plan


def test_triples_are_made_in_place(stored):
    plan = plan_of(to_triples(stored["o"], STANDARD_CONTEXT))
    assert shuffles(plan) == 0 and "Join" not in plan
    only_values = to_triples(stored["o"], STANDARD_CONTEXT, ["_id"], ["rdf:value"])
    scan = scan_of(plan_of(only_values))[0]
    assert "hasFeatureOfInterest" not in scan and "eenheid" not in scan


@pytest.mark.parametrize(
    "name",
    [
        "q20_alarm_report",
        "q28_constructed_alarms_joined",
        "q32_path_values",
        "q37_property_chain",
        "q38_class_members",
    ],
)
def test_building_a_plan_starts_no_job(spark, name):
    sf_dir = os.environ.get("NORMWATCH_SF_DIR", "/root/testdata/sf0.001")
    context = spark.sparkContext
    # Reading the schema of a Parquet file is a job of its own, so each table is read once before.
    schemas = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").schema for t in ("events", "customer")}
    real = tv.table
    tv.table = lambda session, sf, t: session.read.schema(schemas[t]).parquet(f"{sf}/{t}.parquet")
    context.setJobGroup(f"plan-{name}", name)
    try:
        QUERIES[name](spark, sf_dir)
        assert list(context.statusTracker().getJobIdsForGroup(f"plan-{name}")) == []
    finally:
        tv.table = real
        context.setLocalProperty("spark.jobGroup.id", None)
