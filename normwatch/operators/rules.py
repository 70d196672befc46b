"""Rules over observations: which observation violates what, and the alarms that follow.

A rule says which observations it looks at (``target``: one observed property, or all that have
one), what it looks at (``field``) and what it reports.  Rules become a table with one row per
rule that is joined to the observations on the property, so one pass serves any number of rules.

Kinds:

``match``         reports a number between ``lo`` and ``hi``; NULL is open; each end is strict
                  unless marked inclusive
``has_value``     reports unless the field equals ``operand``
``decimal``       reports text that is not written as a number
``min_exclusive`` reports unless the number is above ``lo``
``less_than``     reports unless the field is less than ``other`` (numbers, else moments)
``none``          a severity level without a check; reports nothing
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from normwatch.functions import (
    compared,
    expand_iri,
    instant,
    is_number,
    now_or,
    rule_alarm_key,
    to_number,
)
from normwatch.operators.joins import driver_bytes, spread_join
from normwatch.session import literal_table

KINDS = ("match", "has_value", "decimal", "min_exclusive", "less_than", "none")
ANY_PROPERTY = "*"

# What a rule may look at in an observation record.
FIELDS: Mapping[str, str] = {
    "value": "result.numerieke_waarde",
    "status": "result.kwalitatieve_waarde",
    "unit": "result.eenheid",
    "system": "hasFeatureOfInterest",
    "property": "observedProperty",
    "time": "resultTime",
}


@dataclass(frozen=True)
class Rule:
    rule_id: str
    severity: str
    message: str
    kind: str = "none"
    target: str | None = None
    field: str = "value"
    lo: Decimal | str | None = None
    hi: Decimal | str | None = None
    lo_inclusive: bool = False
    hi_inclusive: bool = False
    operand: str | None = None
    other: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind of rule {self.kind}")
        for limit in ("lo", "hi"):
            if getattr(self, limit) is not None:
                object.__setattr__(self, limit, Decimal(getattr(self, limit)))


_RULE_COLUMNS = (
    "rule_id string, severity string, message string, kind string, target string, field string, "
    "lo string, hi string, lo_inclusive boolean, hi_inclusive boolean, "
    "operand string, other string"
)


def rule_row(rule: Rule) -> tuple:
    """A rule as a row of the table of rules; limits keep the digits they were given with."""
    plain = [f"{v:f}" if isinstance(v, Decimal) else v for v in astuple(rule)]
    plain[4] = rule.target or ANY_PROPERTY
    return tuple(plain)


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule that checks something; rules for every property have target ``*``."""
    rows = [rule_row(rule) for rule in rules if rule.kind != "none"]
    return literal_table(spark, rows, _RULE_COLUMNS)


def rule_targets(observations: DataFrame, observed_property: str | None = None) -> DataFrame:
    """The distinct observations a rule looks at: all with a property, or with the given one."""
    wanted = F.col("observedProperty").isNotNull()
    if observed_property is not None:
        wanted = F.col("observedProperty") == observed_property
    return observations.where(wanted).select(F.col("_id").alias("focusNode")).distinct()


def _pick(choice: Column, names: Sequence[str], value_of) -> Column:
    """The value of whichever of ``names`` the row of the rule chose."""
    picks = [F.when(choice == name, value_of(name)) for name in names]
    return picks[0] if len(picks) == 1 else F.coalesce(*picks)


def violation_of(
    rules: Sequence[Rule], fields: Mapping[str, str], numbers: Mapping[str, str] | None = None
) -> Column:
    """Condition over a joined observation and rule; only branches that occur are built.

    ``numbers`` names columns that hold the fields as numbers; ``lo_number`` and ``hi_number`` hold the
    limits then.
    """
    names = sorted({r.field for r in rules})
    others = sorted({r.other for r in rules if r.other})

    def text(name: str) -> Column:
        return F.col(fields[name]).cast("string")

    def number(name: str) -> Column:
        return F.col(numbers[name]) if numbers else to_number(F.col(fields[name]))

    def moment(name: str) -> Column:
        return instant(text(name))

    lo, hi = (F.col(f"{n}_number") if numbers else to_number(F.col(n)) for n in ("lo", "hi"))

    def matches() -> Column:
        value = _pick(F.col("field"), names, number)
        at_lo = F.col("lo_inclusive") & compared(value, lo, Column.__eq__)
        at_hi = F.col("hi_inclusive") & compared(value, hi, Column.__eq__)
        above = F.col("lo").isNull() | compared(value, lo, Column.__gt__) | at_lo
        below = F.col("hi").isNull() | compared(value, hi, Column.__lt__) | at_hi
        return value.isNotNull() & above & below

    def differs() -> Column:
        return ~_pick(F.col("field"), names, text).eqNullSafe(F.col("operand"))

    def not_decimal() -> Column:
        value = _pick(F.col("field"), names, text)
        return value.isNotNull() & ~is_number(value)

    def not_above() -> Column:
        present = _pick(F.col("field"), names, text).isNotNull()
        above = compared(_pick(F.col("field"), names, number), lo, Column.__gt__)
        return present & ~F.coalesce(above, F.lit(False))

    def not_less() -> Column:
        a = [_pick(F.col("field"), names, of) for of in (text, number, moment)]
        b = [_pick(F.col("other"), others, of) for of in (text, number, moment)]
        less = F.coalesce(compared(a[1], b[1], Column.__lt__), a[2] < b[2], F.lit(False))
        return a[0].isNotNull() & b[0].isNotNull() & ~less

    tests = {
        "match": matches,
        "has_value": differs,
        "decimal": not_decimal,
        "min_exclusive": not_above,
        "less_than": not_less,
    }
    kinds = sorted({r.kind for r in rules if r.kind != "none"})
    each = [(F.col("kind") == kind) & tests[kind]() for kind in kinds]
    return reduce(Column.__or__, each)


def validate(
    observations: DataFrame, rules: Sequence[Rule], fields: Mapping[str, str] = FIELDS
) -> DataFrame:
    """Report rows, one per observation and rule it violates.

    The report carries what :func:`construct_alarms` needs of the observation, so the observations
    are read once.
    """
    spark = observations.sparkSession
    checked = [r for r in rules if r.kind != "none"]
    used = {r.field for r in checked} | {r.other for r in checked if r.other}
    unknown = used - set(fields)
    if unknown:
        raise ValueError(f"rules name unknown fields {sorted(unknown)}")

    key = F.col("observedProperty")
    targets = {r.target for r in checked}
    if None in targets:
        seen = observations.where(key.isNotNull())
        rows = seen.withColumn("rule_key", F.explode(F.array(key, F.lit(ANY_PROPERTY))))
    else:
        # Rows no rule looks at are dropped by the scan.
        seen = observations.where(key.isin(sorted(targets))) if targets else observations
        rows = seen.withColumn("rule_key", key)
    condition = violation_of(checked, fields) if checked else F.lit(False)
    joined = spread_join(
        rows,
        rule_table(spark, checked),
        [("rule_key", "target")],
        where=condition,
        right_bytes=driver_bytes(astuple(rule) for rule in checked),
    )
    return joined.select(
        F.col("_id").alias("focusNode"),
        F.col("severity").alias("resultSeverity"),
        F.col("message").alias("resultMessage"),
        F.col("rule_id").alias("rule"),
        "hasFeatureOfInterest",
        "observedProperty",
        "resultTime",
    )


def join_report(report: DataFrame, observations: DataFrame) -> DataFrame:
    """A bare report joined to the observations it is about, by id and time as written.

    One id may occur at several times, so a report without ``resultTime`` cannot be matched.
    """
    if "resultTime" not in report.columns:
        raise ValueError("the report needs resultTime beside focusNode")
    report = report.select(
        "focusNode", "resultSeverity", "resultMessage", F.col("resultTime").alias("focusTime")
    )
    wanted = observations.select(
        F.col("_id").alias("source_id"),
        F.col("resultTime").alias("source_time"),
        F.col("hasFeatureOfInterest").alias("source_system"),
        F.col("observedProperty").alias("source_property"),
    )
    on = [("source_id", "focusNode"), ("source_time", "focusTime")]
    joined = spread_join(wanted, report, on)
    return joined.select(
        "focusNode",
        "resultSeverity",
        "resultMessage",
        F.col("source_system").alias("hasFeatureOfInterest"),
        F.col("source_property").alias("observedProperty"),
        F.col("source_time").alias("resultTime"),
    )


def construct_alarms(
    report: DataFrame,
    observations: DataFrame | None = None,
    prefixes: Mapping[str, str] | None = None,
    as_of: str | None = None,
    id_base: str = "observation:",
) -> DataFrame:
    """A derived observation per report row, with provenance and the severity as second type.

    Its id hashes the full IRI of the observation and the time as written.  ``prefixes`` expand
    compact ids for that.  Without ``observations`` the report has to carry the columns of
    :func:`validate`.
    """
    rows = report if observations is None else join_report(report, observations)
    key = rule_alarm_key(expand_iri(F.col("focusNode"), prefixes), F.col("resultTime"))
    message_key = F.md5(F.concat_ws("-", key, F.col("resultMessage")).cast("binary"))
    result = F.struct(
        F.concat(F.lit("_:"), message_key).alias("_id"),
        F.lit("sosa:Result").alias("_type"),
        F.col("resultMessage").alias("message"),
    )
    return rows.select(
        F.concat(F.lit(id_base), key).alias("_id"),
        F.array(F.col("resultSeverity"), F.lit("sosa:Observation")).alias("_type"),
        "hasFeatureOfInterest",
        "observedProperty",
        F.col("resultTime").alias("phenomenonTime"),
        F.col("focusNode").alias("wasInformedBy"),
        now_or(as_of).alias("resultTime"),
        result.alias("result"),
    )


def merge_alarms(alarms: DataFrame) -> DataFrame:
    """Violations of one observation share an id: one row per id, types and results as sets.

    Sets are combined before the shuffle and hold at most one entry per rule.
    """
    same = [
        "_id",
        "hasFeatureOfInterest",
        "observedProperty",
        "phenomenonTime",
        "wasInformedBy",
        "resultTime",
    ]
    types = F.array_sort(F.array_distinct(F.flatten(F.collect_set("_type"))))
    merged = alarms.groupBy(*same).agg(
        types.alias("_type"), F.array_sort(F.collect_set("result")).alias("result")
    )
    return merged.select(
        "_id", "_type", *same[1:-1], "resultTime", "result"
    )
