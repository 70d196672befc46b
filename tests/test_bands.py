from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import ABSOLUTE, ALARMS, DAY1, OBSERVATIONS, SYSTEMS, bands, observations, systems

from normwatch import schemas
from normwatch.operators import bands as bands_module
from normwatch.operators.alarms import alarm_observations, alarm_report, match_bands
from normwatch.operators.bands import resolve_bands, resolve_bands_nested
from normwatch.plans.band_alarms import absolute_bands_sql, alarm_report_sql
from normwatch.sources import bands_from_alt, systems_from_alt

NOW = "2025-08-08 13:35:09"


def bag(df, *columns):
    return Counter(tuple(row) for row in df.select(*(columns or df.columns)).collect())


def limits(df):
    return bag(df, "lzsid", "bbid", "referentiewaarde", "minValue", "maxValue")


@pytest.mark.parametrize("unique", [False, True])
def test_known_absolute_bands(spark, unique):
    resolved = resolve_bands(systems(spark), bands(spark), unique_ids=unique)
    assert limits(resolved) == Counter(ABSOLUTE)


def test_sql_form_agrees(spark):
    by_sql = absolute_bands_sql(spark, systems(spark), bands(spark))
    by_columns = resolve_bands(systems(spark), bands(spark))
    assert by_sql.columns == by_columns.columns
    assert bag(by_sql) == bag(by_columns)
    report = alarm_report(observations(spark), by_columns, NOW)
    report_sql = alarm_report_sql(spark, observations(spark), by_sql, NOW)
    assert report.schema.names == report_sql.schema.names
    assert bag(report) == bag(report_sql)


def test_known_alarms(spark):
    absolute = resolve_bands(systems(spark), bands(spark))
    matched = match_bands(observations(spark), absolute)
    got = bag(matched, "resultTime", "bbid", "result.numerieke_waarde")
    assert got == Counter(ALARMS)


def test_unresolved_band_alarms_on_everything_or_is_skipped(spark):
    ph = dict(OBSERVATIONS[0], hasFeatureOfInterest="system:2")
    ph["result"] = {"numerieke_waarde": None}
    rows = spark.createDataFrame([ph], schemas.OBSERVATION)
    kept = resolve_bands(systems(spark), bands(spark))
    assert bag(match_bands(rows, kept), "bbid") == Counter([("band:8",)])
    skipped = resolve_bands(systems(spark), bands(spark), unresolved="skip")
    assert limits(skipped) == Counter(row for row in ABSOLUTE if row[1] != "band:8")


def test_unknown_operation(spark):
    odd = bands(spark).where("id = 'band:3'").withColumn("operatie", F.lit("macht"))
    odd = odd.withColumn("minValue", F.lit(5.0))
    open_ = resolve_bands(systems(spark), odd)
    assert limits(open_) == Counter([("system:1", "band:3", 40.0, None, None)])
    as_is = resolve_bands(systems(spark), odd, unknown_op="absolute")
    assert limits(as_is) == Counter([("system:1", "band:3", 40.0, 5.0, None)])
    with pytest.raises(ValueError):
        resolve_bands(systems(spark), odd, unknown_op="guess")


def test_several_operating_properties_fan_out(spark):
    double = dict(SYSTEMS[0])
    limits_ = SYSTEMS[0]["hasOperatingRange"]["hasOperatingProperty"]
    more = [*limits_, dict(limits_[0], maxValue=30.0)]
    double["hasOperatingRange"] = {"hasOperatingProperty": more}
    rows = spark.createDataFrame([double], schemas.SYSTEM)
    for unique in (False, True):
        resolved = resolve_bands(rows, bands(spark), unique_ids=unique).where("bbid = 'band:3'")
        assert sorted(row.minValue for row in resolved.collect()) == [30.0, 40.0]


def test_sql_takes_system_ids_for_keys(spark):
    twice = systems(spark).unionByName(systems(spark))
    by_sql = absolute_bands_sql(spark, twice, bands(spark))
    assert bag(resolve_bands(twice, bands(spark), unique_ids=True)) == bag(by_sql)


def test_system_without_operating_range(spark):
    bare = spark.createDataFrame([{"_id": "system:3", "type": "class:s1"}], schemas.SYSTEM)
    for unique in (False, True):
        resolved = resolve_bands(bare, bands(spark), unique_ids=unique)
        assert resolved.count() == 7
        assert resolved.where("referentiewaarde IS NOT NULL").count() == 0


@pytest.mark.parametrize("unique", [False, True])
def test_large_tables_shuffle_and_spread_the_hot_class(spark, monkeypatch, unique):
    from normwatch.operators import joins

    expected = limits(resolve_bands(systems(spark), bands(spark)))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 1)
    resolved = resolve_bands(systems(spark), bands(spark), unique_ids=unique)
    assert limits(resolved) == expected
    matched = match_bands(observations(spark), resolved)
    assert bag(matched, "resultTime", "bbid", "result.numerieke_waarde") == Counter(ALARMS)


def test_nested_and_alternative_layouts(spark):
    nested_systems = spark.createDataFrame(
        [
            {
                "_id": s["_id"],
                "type": s["type"],
                "parameterconditie": [
                    {**{k: v for k, v in p.items() if k != "forProperty"},
                     "parameter": p["forProperty"]}
                    for p in s["hasOperatingRange"]["hasOperatingProperty"]
                ],
            }
            for s in SYSTEMS
        ],
        schemas.SYSTEM_NESTED,
    )
    flat = bands(spark)
    band = F.struct(
        "minValue", "maxValue", "operatie", F.col("prefLabel").alias("label"),
        F.col("dc_type").alias("type"), F.col("scopeNote").alias("note"),
    )
    norms = flat.groupBy(
        F.col("subject").alias("klasse"), F.col("forProperty").alias("parameter")
    ).agg(F.collect_list(band).alias("bandbreedtes"))
    want = bag(
        resolve_bands(systems(spark), flat), "lzsid", "label", "referentiewaarde", "minValue",
        "maxValue",
    )
    got = resolve_bands_nested(nested_systems, norms)
    assert bag(got, "lzsid", "label", "referentiewaarde", "minValue", "maxValue") == want

    alt_systems = spark.createDataFrame(
        [
            {
                "_id": s["_id"],
                "type": s["type"],
                "hasOperatingRange": {
                    "hasOperatingProperty": [
                        {"parameter": p["forProperty"], "value": p["value"],
                         "minValue": p["minValue"], "maxValue": p["maxValue"]}
                        for p in s["hasOperatingRange"]["hasOperatingProperty"]
                    ]
                },
            }
            for s in SYSTEMS
        ],
        schemas.SYSTEM_ALT,
    )
    alt_bands = flat.select(
        F.col("id").alias("_id"), F.col("subject").alias("klasse"),
        F.col("forProperty").alias("parameter"), F.col("prefLabel").alias("label"),
        F.col("dc_type").alias("type"), "actie", "value", "minValue", "maxValue", "operatie",
        F.col("scopeNote").alias("note"),
    )
    resolved = resolve_bands(systems_from_alt(alt_systems), bands_from_alt(alt_bands))
    assert limits(resolved) == Counter(ABSOLUTE)


def test_alarm_shapes(spark):
    absolute = resolve_bands(systems(spark), bands(spark))
    compact = alarm_observations(observations(spark), absolute, as_of=NOW)
    extended = alarm_observations(observations(spark), absolute, "extended", as_of=NOW)
    row = compact.where("result.value = 'band:1'").orderBy("phenomenonTime").first()
    assert row["_type"] == "sosa:Observation"
    assert row["wasInformedBy"] == "observation:24"
    assert row["phenomenonTime"] == DAY1
    assert str(row["datum"]) == "2025-04-05"
    assert row["result"]["_type"] == "sosa:Result"
    assert row["result"]["parametervalue"] == 3.7
    assert row["result"]["parameterunit"] == "unit:PH"
    wide = extended.where("result.value = 'band:1'").orderBy("phenomenonTime").first()
    assert wide["result"]["_type"] == ["sosa:Result", "qb:Observation"]
    assert wide["result"]["refPeriod"] == DAY1
    assert wide["result"]["lzsDimensie"] == "system:1"
    assert wide["_id"] == row["_id"]
    with pytest.raises(ValueError):
        alarm_observations(observations(spark), absolute, "wide")


def test_ids_repeat_whatever_the_partitioning(spark):
    absolute = resolve_bands(systems(spark), bands(spark))
    one = alarm_observations(observations(spark).repartition(1), absolute, as_of=NOW)
    many = alarm_observations(observations(spark).repartition(7), absolute, as_of=NOW)
    assert bag(one, "_id", "wasInformedBy") == bag(many, "_id", "wasInformedBy")
    assert one.select("_id").distinct().count() == len(ALARMS)
    random = alarm_observations(observations(spark), absolute, id_mode="uuid")
    assert random.where("_id RLIKE '^observation:[0-9a-f-]{36}$'").count() == len(ALARMS)


def test_bounds_are_strict(spark):
    at_bound = dict(OBSERVATIONS[0], result={"numerieke_waarde": 6.0})
    rows = spark.createDataFrame([at_bound], schemas.OBSERVATION)
    absolute = resolve_bands(systems(spark), bands(spark))
    assert match_bands(rows, absolute).count() == 0


def test_operating_properties_are_exploded(spark):
    assert bands_module.operating_properties(systems(spark)).count() == 8
