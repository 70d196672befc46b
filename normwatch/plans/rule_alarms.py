"""Job: observations and rules to alarms as files of triples, nested JSON and Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from normwatch.operators.frames import alarm_frame, frame
from normwatch.operators.rules import Rule, construct_alarms, merge_alarms, validate
from normwatch.operators.triples import expand_iris, to_triples, union_graphs
from normwatch.sinks import write_nested_json, write_ntriples, write_parquet
from normwatch.sources.context import STANDARD_CONTEXT, Context


def alarm_triples(
    alarms: DataFrame, context: Context = STANDARD_CONTEXT, full_terms: bool = False
) -> DataFrame:
    """The triples of constructed alarms."""
    timed = alarms.withColumn("resultTime", alarms["resultTime"].cast("string"))
    return to_triples(timed, context, full_terms=full_terms)


def run_rule_alarms(
    observations: DataFrame,
    rules: Sequence[Rule],
    out: str,
    prefixes: Mapping[str, str] | None = None,
    context: Context = STANDARD_CONTEXT,
    severity: str | None = "sh:Violation",
    as_of: str | None = None,
    single_file: bool = False,
) -> DataFrame:
    """Write all alarms as N-Triples, and those of one severity as nested JSON and Parquet.

    The alarms are written first and everything else is derived from the written copy, so all
    outputs agree on the clock.
    """
    spark = observations.sparkSession
    names = {**context.prefixes, **(prefixes or {})}
    report = validate(observations, rules)
    alarms = construct_alarms(report, prefixes=names, as_of=as_of)
    merged = merge_alarms(alarms)
    write_parquet(merged, f"{out}/all")
    written = spark.read.schema(merged.schema).parquet(f"{out}/all")

    graph = union_graphs(alarm_triples(written, context, full_terms=True))
    write_ntriples(expand_iris(graph, names, columns=("s", "o")), f"{out}/ntriples")
    framed = frame(alarm_triples(written, context), alarm_frame(severity))
    write_parquet(framed, f"{out}/parquet", single_file=single_file)
    stored = spark.read.schema(framed.schema).parquet(f"{out}/parquet")
    write_nested_json(stored, f"{out}/json")
    return stored
