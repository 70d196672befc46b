"""The query catalogue: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normwatch import schemas
from normwatch.functions import instant
from normwatch.functions.identity import alarm_key
from normwatch.functions.times import date_as_written
from normwatch.operators import classes as cls
from normwatch.operators.alarms import (
    alarm_observations,
    alarm_report,
    alarm_report_nested,
)
from normwatch.operators.bands import (
    bands_of_systems,
    operating_properties,
    resolve_bands,
    resolve_bands_nested,
    with_operating_property,
)
from normwatch.operators.canonical import union_loads
from normwatch.operators.codelists import (
    band_concepts,
    classes_for_concept,
    code_list_schemes,
    concepts_for_class,
    leaf_concepts,
    typed_concepts,
)
from normwatch.operators.frames import OBSERVATION_FRAME, Frame, alarm_frame, frame
from normwatch.operators.hierarchy import label_hierarchy, members_below, superclasses
from normwatch.operators.rules import (
    construct_alarms,
    merge_alarms,
    rule_targets,
    validate,
)
from normwatch.operators.shapes import FIELD_PATHS, shapes_of, validate_graph
from normwatch.operators.triples import (
    expand_iris,
    ntriples_lines,
    path_values,
    subjects_of,
    to_triples,
    union_graphs,
)
from normwatch.plans import testviews as tv
from normwatch.plans.band_alarms import absolute_bands_sql, alarm_report_sql, run_band_alarms
from normwatch.plans.code_lists import run_code_lists
from normwatch.plans.rule_alarms import alarm_triples, run_rule_alarms
from normwatch.session import literal_table, scratch_path, written_once
from normwatch.sinks import replace_dates, round_trip_parquet, write_json
from normwatch.sources import (
    from_json_inferred,
    from_json_text,
    infer_schema,
    read_json,
    read_json_array,
    read_json_inferred,
    read_observations,
    typed_observations,
    unwrap_envelope,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def flat_observations(rows: DataFrame) -> DataFrame:
    return rows.select(
        "_id",
        "hasFeatureOfInterest",
        "observedProperty",
        F.col("result.eenheid").alias("eenheid"),
        F.col("result.kwalitatieve_waarde").alias("kwalitatieve_waarde"),
        F.col("result.numerieke_waarde").alias("numerieke_waarde"),
        "resultTime",
    )


def absolute_bands(spark: SparkSession, sf: str) -> DataFrame:
    # c_custkey is the key of its table.
    return resolve_bands(tv.systems(spark, sf), tv.bands(spark), unique_ids=True)


def without_numbers(bands: DataFrame) -> DataFrame:
    return bands.drop("operating_no")


def observation_triples(spark: SparkSession, sf: str, *predicates: str) -> DataFrame:
    return to_triples(tv.observations(spark, sf), tv.CONTEXT, tv.NODE_KEY, predicates or None)


def text_of(array: str) -> F.Column:
    return F.array_join(F.array_sort(array), ",").alias(array)


# Sources and sinks


@query
def q01_json_declared_schema(spark, sf):
    path = scratch_path(spark, "observations")
    write_json(tv.observations(spark, sf), path)
    return flat_observations(read_observations(spark, path, multiline=False))


def _array_files(spark, sf) -> str:
    # One file per document, each an array over several lines.
    rows = tv.observations(spark, sf)
    block = F.floor(F.substring_index("_id", ":", -1).cast("long") / 500)
    documents = rows.groupBy(block.alias("block")).agg(F.collect_list(F.struct(*rows.columns)).alias("r"))
    text = F.replace(F.to_json("r"), F.lit("},{"), F.lit("},\n{"))
    path = scratch_path(spark, "documents")
    documents.select(text).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query
def q01_multiline_json(spark, sf):
    return flat_observations(read_observations(spark, _array_files(spark, sf), multiline=True))


@query
def q01_array_in_ranges(spark, sf):
    """The same files read in ranges of 16 KB, each file by several tasks."""
    rows = read_json_array(spark, _array_files(spark, sf), schemas.OBSERVATION_AS_TEXT, 1 << 14)
    return flat_observations(typed_observations(rows))


@query
def q02_parquet_round_trip(spark, sf):
    return round_trip_parquet(tv.table(spark, sf, "lineitem"), scratch_path(spark, "lineitem"))


@query
def q03_json_text_records(spark, sf):
    schema = schemas.T.StructType([schemas.T.StructField("k", schemas.T.LongType())])
    return from_json_text(tv.table(spark, sf, "events"), "props", schema)


@query
def q03_inferred_records(spark, sf):
    """Observations written as JSON lines, read without a schema."""
    path = scratch_path(spark, "lines")
    tv.observations(spark, sf).select(F.to_json(F.struct("*"))).write.text(path)
    return flat_observations(read_json_inferred(spark, path))


@query
def q03_inferred_schema(spark, sf):
    """The schema that is found for systems and observations in one table of texts."""
    systems = tv.systems(spark, sf).select(F.to_json(F.struct("*")).alias("text"))
    observed = tv.observations(spark, sf).select(F.to_json(F.array(F.struct("*"))).alias("text"))
    props = tv.table(spark, sf, "events").select(F.col("props").alias("text"))
    found = infer_schema(systems.union(observed).union(props), "text")
    rows = [(f.name, f.dataType.simpleString()) for f in found]
    return literal_table(spark, rows, "field string, kind string")


def _documents(spark, sf):
    # One JSON document per event, holding an observation and the system it is about.
    nothing = F.lit(None).cast("string")
    observation = F.struct("_id", "_type")
    system = F.struct(
        F.col("hasFeatureOfInterest").alias("_id"), F.lit("ssn:System").alias("_type")
    )
    document = F.struct(nothing.alias("@context"), F.array(observation, system).alias("@graph"))
    return tv.observations(spark, sf).select(F.to_json(document).alias("text"))


@query
def q04_envelope_unwrap(spark, sf):
    texts = _documents(spark, sf)
    record = schemas.T.StructType(
        [schemas.T.StructField(name, schemas.T.StringType()) for name in ("_id", "_type")]
    )
    return unwrap_envelope(from_json_text(texts, "text", schemas.envelope(record)))


@query
def q04_inferred_envelope(spark, sf):
    return unwrap_envelope(from_json_inferred(_documents(spark, sf), "text"))


def _written_alarms(spark, sf, shape):
    return run_band_alarms(
        tv.systems(spark, sf),
        tv.bands(spark),
        tv.observations(spark, sf),
        scratch_path(spark, "alarms"),
        shape=shape,
        as_of=tv.AS_OF,
        unique_ids=True,
    )


@query
def q05_parquet_by_date(spark, sf):
    return _flat_alarms(_written_alarms(spark, sf, "compact"))


@query
def q05_late_alarms(spark, sf):
    """Alarms of most observations, then of one day with its late ones, then twice of all."""
    out = scratch_path(spark, "late")
    rows = tv.observations(spark, sf)
    on_time = F.substring_index("_id", ":", -1).cast("long") % 10 != 0
    of_day = F.startswith("resultTime", F.lit(tv.DAY))
    for some in (rows.where(on_time), rows.where(of_day), rows, rows):
        alarms = run_band_alarms(
            tv.systems(spark, sf), tv.bands(spark), some, out, as_of=tv.AS_OF, late=True, unique_ids=True
        )
    return _flat_alarms(alarms)


@query
def q06_late_json(spark, sf):
    """The JSON beside such alarms."""
    out = scratch_path(spark, "late")
    rows = tv.observations(spark, sf)
    for some in (rows.where(F.startswith("resultTime", F.lit(tv.DAY))), rows):
        alarms = run_band_alarms(
            tv.systems(spark, sf), tv.bands(spark), some, out, as_of=tv.AS_OF, late=True, unique_ids=True
        )
    return _flat_alarms(read_json(spark, f"{out}/json", alarms.schema, multiline=False))


@query
def q05_replaced_day(spark, sf):
    """A day is derived again later; the alarms of other days stay as they are."""
    path = scratch_path(spark, "replaced")
    rows, bands = tv.observations(spark, sf), absolute_bands(spark, sf)
    replace_dates(alarm_observations(rows, bands, as_of=tv.AS_OF), path)
    of_day = rows.where(F.startswith("resultTime", F.lit(tv.DAY)))
    again = alarm_observations(of_day, bands, as_of=tv.LATER)
    replace_dates(again, path)
    return _flat_alarms(spark.read.schema(again.schema).parquet(path))


@query
def q06_json_by_date(spark, sf):
    path = scratch_path(spark, "report")
    report = alarm_report(tv.observations(spark, sf), absolute_bands(spark, sf), tv.AS_OF)
    write_json(report, path, partition_by=["datum"])
    return read_json(spark, path, report.schema, multiline=False)


@query
def q05_single_file(spark, sf):
    """What is read back of a report written as one JSON file, and the number of its files."""
    path = scratch_path(spark, "single")
    report = alarm_report(tv.observations(spark, sf), absolute_bands(spark, sf), tv.AS_OF)
    write_json(report, path, single_file=True)
    read = read_json(spark, path, report.schema, multiline=False)
    file = F.input_file_name().alias("file")
    return read.select(file, "_id").agg(
        F.count("*").alias("alarms"),
        F.countDistinct("_id").alias("ids"),
        F.countDistinct("file").alias("files"),
    )


# Projections, generators, filters


@query
def q07_nested_select(spark, sf):
    return flat_observations(tv.observations(spark, sf))


@query
def q08_concept_schemes(spark, sf):
    codes = tv.codes(spark, sf)
    return code_list_schemes(codes.where(F.col("inScheme") == "scheme:ECONOMY"), "Brand#1")


@query
def q09_leaf_concepts(spark, sf):
    leaves = leaf_concepts(tv.codes(spark, sf), "scheme:SMALL")
    return leaves.withColumn("type", F.array_join("type", ","))


@query
def q10_operating_properties(spark, sf):
    return operating_properties(tv.systems(spark, sf)).select("operating_of", "operating.*")


@query
def q11_typed_concepts(spark, sf):
    rows = typed_concepts(tv.codes(spark, sf), "scheme:PROMO", "Brand#7")
    return rows.withColumn("dct_type", F.array_join("dct_type", ","))


@query
def q12_band_concepts(spark, sf):
    return band_concepts(tv.codes(spark, sf), "scheme:LARGE", ignore_types=["LARGE", "Brand#3"])


@query
def q12_code_list_job(spark, sf):
    """All slices of the code list as the whole job writes them, the list cached for its passes."""
    paths = run_code_lists(
        tv.codes(spark, sf),
        scratch_path(spark, "codes"),
        class_scheme="scheme:SMALL",
        property_scheme="scheme:PROMO",
        band_scheme="scheme:LARGE",
        property_type="Brand#7",
        scheme_type="Brand#1",
        cache=True,
    )
    parts = [
        spark.read.parquet(path).select(F.lit(name).alias("slice"), "id")
        for name, path in sorted(paths.items())
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def q12_reused_concepts(spark, sf):
    """Concepts by type, derived and written by the first of two jobs and read by the second."""
    for _ in range(2):
        some = typed_concepts(tv.codes(spark, sf), "scheme:PROMO", "Brand#7")
        concepts = written_once(some, "promo-concepts")
    return concepts.withColumn("dct_type", F.array_join("dct_type", ","))


@query
def q13_with_column(spark, sf):
    rows = tv.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag"
    )
    discounted = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    returned = F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept")
    return rows.withColumn("l_extendedprice", discounted).withColumn("l_returnflag", returned)


# Bands


@query
def q14_bands_of_systems(spark, sf):
    return bands_of_systems(tv.systems(spark, sf), tv.bands(spark)).select(
        "lzsid", "system_class", "bbid", "parameter"
    )


@query
def q15_bands_with_operating(spark, sf):
    systems = tv.systems(spark, sf)
    joined = with_operating_property(bands_of_systems(systems, tv.bands(spark)), systems)
    return joined.select(
        "lzsid",
        "bbid",
        F.col("operating.forProperty").alias("forProperty"),
        F.col("operating.value").alias("value"),
        F.col("operating.minValue").alias("minValue"),
        F.col("operating.maxValue").alias("maxValue"),
    )


@query
def q16_absolute_bands(spark, sf):
    return without_numbers(absolute_bands(spark, sf))


@query
def q16_absolute_bands_sql(spark, sf):
    return without_numbers(absolute_bands_sql(spark, tv.systems(spark, sf), tv.bands(spark)))


@query
def q16_absolute_bands_resolved(spark, sf):
    rows = resolve_bands(
        tv.systems(spark, sf), tv.bands(spark), unresolved="skip", unknown_op="absolute"
    )
    return without_numbers(rows)


@query
def q17_absolute_bands_nested(spark, sf):
    rows = resolve_bands_nested(tv.systems_nested(spark, sf), tv.norms_nested(spark))
    return without_numbers(rows).drop("bbid")


@query
def q18_concepts_for_class(spark, sf):
    return concepts_for_class(tv.codes(spark, sf), "BUILDING")


@query
def q18_classes_for_concept(spark, sf):
    return classes_for_concept(tv.codes(spark, sf))


@query
def q18_classes_of_one_concept(spark, sf):
    return classes_for_concept(tv.codes(spark, sf), "code:5", separator=", ")


@query
def q19_times(spark, sf):
    written = F.col("resultTime")
    return tv.observations(spark, sf).select(
        "_id",
        date_as_written(written).alias("datum"),
        F.unix_micros(instant(written)).alias("micros"),
    )


# Alarms on bands


@query
def q20_alarm_report(spark, sf):
    return alarm_report(tv.observations(spark, sf), absolute_bands(spark, sf), tv.AS_OF)


@query
def q20_alarm_report_sql(spark, sf):
    return alarm_report_sql(
        spark, tv.observations(spark, sf), absolute_bands(spark, sf), tv.AS_OF
    )


@query
def q20_indexed(spark, sf):
    """The same report with every band found by the index."""
    rows = tv.observations(spark, sf)
    return alarm_report(rows, absolute_bands(spark, sf), tv.AS_OF, many=1)


@query
def q20_indexed_tiers(spark, sf):
    """Order totals against price tiers: one key with as many bands as there are parts."""
    return alarm_report(tv.order_observations(spark, sf), tv.price_tiers(spark, sf), tv.AS_OF, many=64)


@query
def q20_indexed_gaps(spark, sf):
    rows = tv.observations_with_gaps(spark, sf)
    return alarm_report(rows, _bands_with_gaps(spark, sf), tv.AS_OF, many=2)


def _bands_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_bands(tv.systems(spark, sf), tv.bands_with_gaps(spark), unique_ids=True)


@query
def q20_gaps(spark, sf):
    """Observations and bands without a property, system, class or number."""
    rows = tv.observations_with_gaps(spark, sf)
    return alarm_report(rows, _bands_with_gaps(spark, sf), tv.AS_OF)


@query
def q20_gaps_sql(spark, sf):
    rows = tv.observations_with_gaps(spark, sf)
    return alarm_report_sql(spark, rows, _bands_with_gaps(spark, sf), tv.AS_OF)


@query
def q20_alarm_report_nested(spark, sf):
    bands = resolve_bands_nested(
        tv.systems_nested(spark, sf), tv.norms_nested(spark), unique_ids=True
    )
    return alarm_report_nested(tv.observations(spark, sf), bands, tv.AS_OF)


def _counted(form: str, alarms: DataFrame) -> DataFrame:
    ids = F.countDistinct("_id").alias("ids")
    return alarms.agg(F.count("*").alias("alarms"), ids).select(F.lit(form).alias("form"), "*")


@query
def q20_distinct_ids(spark, sf):
    """As many ids as alarms, with two operating properties for a parameter and without labels."""
    rows = tv.observations(spark, sf)
    flat = resolve_bands(tv.systems_with_two_limits(spark, sf), tv.bands(spark))
    bare = resolve_bands_nested(
        tv.systems_nested(spark, sf), tv.norms_without_labels(spark), unique_ids=True
    )
    return _counted("flat", alarm_report(rows, flat, tv.AS_OF)).unionByName(
        _counted("nested", alarm_report_nested(rows, bare, tv.AS_OF))
    )


def _flat_alarms(alarms: DataFrame) -> DataFrame:
    outer = [c for c in alarms.columns if c not in ("result", "resultTime")]
    inner = []
    for field in alarms.schema["result"].dataType:
        value = F.col(f"result.{field.name}")
        if field.dataType.typeName() == "array":
            value = F.array_join(value, ",")
        inner.append(value.alias(f"result_{field.name}"))
    return alarms.select(*outer, F.col("resultTime").cast("string").alias("resultTime"), *inner)


@query
def q21_alarms_compact(spark, sf):
    bands = absolute_bands(spark, sf)
    return _flat_alarms(alarm_observations(tv.observations(spark, sf), bands, as_of=tv.AS_OF))


@query
def q22_alarms_extended(spark, sf):
    rows = alarm_observations(
        tv.observations(spark, sf), absolute_bands(spark, sf), "extended", as_of=tv.AS_OF
    )
    return _flat_alarms(rows)


@query
def q23_hashed_ids(spark, sf):
    nothing = F.lit(None).cast("int")
    key = alarm_key(F.col("_id"), F.col("resultTime"), F.col("observedProperty"), nothing)
    return tv.observations(spark, sf).select("_id", key.alias("key"))


@query
def q24_alarms_uuid(spark, sf):
    rows = alarm_observations(
        tv.observations(spark, sf), absolute_bands(spark, sf), id_mode="uuid"
    )
    return _flat_alarms(rows)


@query
def q24_uuid_facts(spark, sf):
    """Of alarms with random ids and the clock: are the ids well formed and distinct, is the clock
    that of the run?"""
    begun = datetime.now(timezone.utc)
    rows = run_band_alarms(
        tv.systems(spark, sf),
        tv.bands(spark),
        tv.observations(spark, sf),
        scratch_path(spark, "uuids"),
        id_mode="uuid",
        unique_ids=True,
    )
    form = "^(observation|result):[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    good = F.rlike("_id", F.lit(form)) & F.rlike("result._id", F.lit(form))
    ended = datetime.now(timezone.utc)
    in_run = F.col("resultTime").between(F.lit(begun), F.lit(ended))
    return rows.agg(
        F.count("*").alias("alarms"),
        F.bool_and(good).alias("well_formed"),
        (F.countDistinct("_id") == F.count("*")).alias("all_distinct"),
        F.bool_and(in_run).alias("clock_of_run"),
    )


# Rules


@query
def q25_rule_targets(spark, sf):
    triples = observation_triples(spark, sf, "sosa:observedProperty")
    having = subjects_of(triples, "sosa:observedProperty").select(
        F.lit("having").alias("target"), F.col("s").alias("focusNode")
    )
    equal = rule_targets(tv.observations(spark, sf), "prop:click").select(
        F.lit("equal").alias("target"), "focusNode"
    )
    return having.unionByName(equal)


@query
def q26_rule_report(spark, sf):
    return validate(tv.observations(spark, sf), tv.RULES)


@query
def q26_extreme_numbers(spark, sf):
    return validate(tv.observations_with_extremes(spark, sf), tv.EXTREME_RULES)


@query
def q27_constraint_report(spark, sf):
    rows = tv.observations_with_ceiling(spark, sf)
    return validate(rows, tv.CONSTRAINTS, tv.RULE_FIELDS)


@query
def q27_graph_report(spark, sf):
    """The same rules on the triples of the same observations."""
    rows = tv.observations_with_ceiling(spark, sf)
    graph = to_triples(rows, tv.CEILING_CONTEXT, tv.NODE_KEY)
    shapes = shapes_of(tv.CONSTRAINTS, {**FIELD_PATHS, "ceiling": ("ex:ceiling",)})
    return validate_graph(graph, shapes).drop("value")


@query
def q27_shapes_for_all(spark, sf):
    """Shapes about subjects with no value or several: customers, their orders and the lines."""
    return validate_graph(tv.order_graph(spark, sf), tv.ORDER_SHAPES, {"segment": ("ex:segment",)})


def _flat_rule_alarms(alarms: DataFrame) -> DataFrame:
    return alarms.select(
        "_id",
        text_of("_type"),
        "hasFeatureOfInterest",
        "observedProperty",
        "phenomenonTime",
        "wasInformedBy",
        F.col("resultTime").cast("string").alias("resultTime"),
        F.col("result._id").alias("result_id"),
        F.col("result.message").alias("message"),
    )


@query
def q28_constructed_alarms(spark, sf):
    report = validate(tv.observations(spark, sf), tv.RULES)
    return _flat_rule_alarms(construct_alarms(report, prefixes=tv.PREFIXES, as_of=tv.AS_OF))


@query
def q28_constructed_alarms_joined(spark, sf):
    rows = tv.observations(spark, sf)
    report = validate(rows, tv.RULES).select(
        "focusNode", "resultSeverity", "resultMessage", "resultTime"
    )
    alarms = construct_alarms(report, rows, prefixes=tv.PREFIXES, as_of=tv.AS_OF)
    return _flat_rule_alarms(alarms)


def _merged(spark, sf):
    report = validate(tv.observations(spark, sf), tv.RULES)
    alarms = construct_alarms(report, prefixes=tv.PREFIXES, as_of=tv.AS_OF)
    return merge_alarms(alarms)


def _flat_merged(merged: DataFrame) -> DataFrame:
    return merged.select(
        "_id",
        text_of("_type"),
        "hasFeatureOfInterest",
        "observedProperty",
        "phenomenonTime",
        "wasInformedBy",
        F.col("resultTime").cast("string").alias("resultTime"),
        F.array_join(F.array_sort("result.message"), ",").alias("messages"),
    )


@query
def q29_merged_alarms(spark, sf):
    return _flat_merged(_merged(spark, sf))


# Triples


@query
def q30_to_triples(spark, sf):
    return observation_triples(spark, sf)


@query
def q31_expanded_triples(spark, sf):
    return expand_iris(observation_triples(spark, sf), tv.CONTEXT.prefixes)


@query
def q32_path_values(spark, sf):
    triples = observation_triples(
        spark, sf, "sosa:observedProperty", "sosa:hasResult", "rdf:value"
    )
    about = subjects_of(triples, "sosa:observedProperty", "prop:click")
    clicks = triples.join(about, "s", "left_semi")
    onward = triples.where(F.col("p") == "rdf:value")
    graph = clicks.where(F.col("p") == "sosa:hasResult").unionByName(onward)
    return path_values(graph, ["sosa:hasResult", "rdf:value"])


@query
def q33_union_of_graphs(spark, sf):
    # The same systems and properties are named by many observations.
    named = observation_triples(
        spark, sf, "sosa:hasFeatureOfInterest", "sosa:observedProperty"
    )
    kinds = named.select(
        F.col("o").alias("s"),
        F.lit("rdf:type").alias("p"),
        F.concat(F.lit("kind:"), F.col("p")).alias("o"),
        "o_kind",
        "datatype",
    )
    return union_graphs(kinds, named, named)


@query
def q33_union_of_loads(spark, sf):
    """What is reached through blank nodes, each once, of a graph that was loaded twice."""
    wanted = ("sosa:hasResult", "rdf:value")
    rows = tv.observations(spark, sf)
    loads = [
        to_triples(rows, tv.CONTEXT, key, wanted)
        for key in (tv.NODE_KEY, ("observedProperty", "resultTime", "_id"))
    ]
    return path_values(union_loads(*loads), wanted)


@query
def q34_framed_observations(spark, sf):
    framed = frame(observation_triples(spark, sf), OBSERVATION_FRAME)
    return flat_observations(framed)


@query
def q35_framed_alarms_json(spark, sf):
    framed = frame(alarm_triples(_merged(spark, sf), tv.CONTEXT), alarm_frame("sh:Violation"))
    messages = F.array_sort("result.message")
    shown = framed.select(
        "_id",
        "_type",
        "hasFeatureOfInterest",
        "observedProperty",
        "phenomenonTime",
        "wasInformedBy",
        "resultTime",
        messages.alias("messages"),
    )
    return shown.select(F.to_json(F.struct("*")).alias("record"))


@query
def q34_framed_at_two_times(spark, sf):
    rows = tv.observations_at_two_times(spark, sf)
    fields = ("hasFeatureOfInterest", "observedProperty", "resultTime")
    spec = Frame({name: OBSERVATION_FRAME.fields[name] for name in fields}, "sosa:Observation")
    framed = frame(to_triples(rows, tv.CONTEXT, tv.NODE_KEY), spec)
    return framed.select("_id", *fields, F.array_join("_several", ",").alias("several"))


def _rule_job(spark, sf):
    out = scratch_path(spark, "rules")
    run_rule_alarms(
        tv.observations(spark, sf), tv.RULES, out, tv.PREFIXES, tv.CONTEXT, as_of=tv.AS_OF
    )
    return out


@query
def q35_rule_job_json(spark, sf):
    """The nested JSON of the whole rule job, read back."""
    schema = (
        "_id string, _type array<string>, hasFeatureOfInterest string, observedProperty string, "
        "phenomenonTime string, wasInformedBy string, resultTime string, "
        "result array<struct<message string>>"
    )
    rows = spark.read.schema(schema).json(f"{_rule_job(spark, sf)}/json")
    messages = F.array_sort("result.message").alias("messages")
    kept = [c for c in rows.columns if c != "result"]
    return rows.select(*kept, messages).select(F.to_json(F.struct("*")).alias("record"))


@query
def q36_rule_job_ntriples(spark, sf):
    """The N-Triples of the whole rule job, read back: statements that link alarms and sources."""
    lines = spark.read.text(f"{_rule_job(spark, sf)}/ntriples")
    return lines.where(F.contains("value", F.lit("#wasInformedBy> ")))


@query
def q36_ntriples(spark, sf):
    rows = tv.observations(spark, sf)
    triples = to_triples(rows, tv.CONTEXT, tv.NODE_KEY, full_terms=True)
    return ntriples_lines(expand_iris(triples, tv.CONTEXT.prefixes, columns=("s", "o")))


# Classes


@query
def q37_property_chain(spark, sf):
    predicate, path = next(iter(tv.CHAIN.items()))
    return cls.property_chain(observation_triples(spark, sf, *path), predicate, path)


@query
def q38_class_members(spark, sf):
    triples = observation_triples(spark, sf, *tv.CLASS_PREDICATES)
    return cls.class_members(triples, tv.CLASSES, tv.CHAIN)


@query
def q38_filled_classes(spark, sf):
    """Classes defined by classes, one of them by itself."""
    triples = observation_triples(spark, sf, *tv.CLASS_PREDICATES)
    graph = triples.unionByName(tv.previous_triples(spark, sf))
    edges = literal_table(spark, tv.FILLED_SUBCLASSES, "class string, super string")
    return cls.class_members(graph, tv.FILLED_CLASSES, subclasses=edges)


@query
def q39_inferred_types(spark, sf):
    data = observation_triples(spark, sf, "rdf:type", *tv.CLASS_PREDICATES)
    graphs = [data, tv.subclass_triples(spark)]
    return cls.infer_types(graphs, tv.CLASSES, tv.CHAIN)


@query
def q39_labelled_superclasses(spark, sf):
    """All superclasses of every order, from interval labels."""
    edges = tv.nested_classes(spark, sf)
    orders = edges.where(F.startswith("class", F.lit("order:")))
    return superclasses(label_hierarchy(edges), orders)


@query
def q39_labelled_members(spark, sf):
    """Line items below some classes, without writing out their other superclasses."""
    hierarchy = label_hierarchy(tv.nested_classes(spark, sf))
    asked = literal_table(spark, tv.ASKED_CLASSES, "class string")
    return members_below(tv.ordered_lines(spark, sf), hierarchy, asked)


# Scale


@query
def q40_price_report(spark, sf):
    bands = resolve_bands(tv.price_systems(spark, sf), tv.price_bands(spark), unique_ids=True)
    return alarm_report(tv.price_observations(spark, sf), bands, tv.AS_OF)
