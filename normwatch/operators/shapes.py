"""Validation of a graph: rules about what is reached from a subject along paths of predicates.

``validate`` in :mod:`normwatch.operators.rules` reads records with one value in each column.  Here
a subject may have no value along a path, or many, and a rule holds for all of them:

``match``, ``decimal``, ``min_exclusive``  report every value that offends
``less_than``   reports every value that is not below all values of the other path
``has_value``   reports a subject none of whose values is the operand
``count``       reports a subject with fewer than ``lo`` or more than ``hi`` distinct values
``instance``    reports every value that is not stated to be of the class ``operand``

Paths of all rules are compiled into moves that share their beginnings, so each step of all rules
together is one join.  What single values offend is found where they are.  What concerns all values
of a subject is combined before the shuffle into fixed-size facts, never gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normwatch.functions import compared, instant, to_number
from normwatch.operators.classes import path_numbers, reached_values
from normwatch.operators.joins import driver_bytes, spread_join
from normwatch.operators.rules import Rule, rule_row, violation_of
from normwatch.operators.triples import RDF_TYPE
from normwatch.session import cut_lineage, literal_table

Path = tuple[str, ...]
# Kinds that are decided by one value alone.
_OF_VALUE = ("match", "decimal", "min_exclusive")
KINDS = (*_OF_VALUE, "less_than", "has_value", "count", "instance", "none")

# What the fields of observation rules are in their triples.
FIELD_PATHS: Mapping[str, Path] = {
    "value": ("sosa:hasResult", "rdf:value"),
    "status": ("sosa:hasResult", "rdf:value"),
    "unit": ("sosa:hasResult", "http://qudt.org/schema/qudt/unit"),
    "system": ("sosa:hasFeatureOfInterest",),
    "property": ("sosa:observedProperty",),
    "time": ("sosa:resultTime",),
}
# What alarms are constructed from, beside the report itself.
CARRIED: Mapping[str, Path] = {
    "hasFeatureOfInterest": ("sosa:hasFeatureOfInterest",),
    "observedProperty": ("sosa:observedProperty",),
    "resultTime": ("sosa:resultTime",),
}


@dataclass(frozen=True)
class Shape:
    """A rule about the values along ``path`` of its target subjects.

    Targets are the subjects that have ``target_predicate``, with the value ``target`` if given.
    Limits are numbers as text, read as in ``Rule``.
    """

    rule_id: str
    severity: str
    message: str
    kind: str
    path: Path
    target_predicate: str
    target: str | None = None
    lo: str | None = None
    hi: str | None = None
    lo_inclusive: bool = False
    hi_inclusive: bool = False
    operand: str | None = None
    other: Path | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind of shape {self.kind}")
        if not self.path or (self.kind == "less_than" and not self.other):
            raise ValueError("a path names at least one predicate")


def shapes_of(
    rules: Sequence[Rule],
    paths: Mapping[str, Path] = FIELD_PATHS,
    target_predicate: str = "sosa:observedProperty",
) -> list[Shape]:
    """Rules about columns as shapes about the paths of those columns."""
    unknown = {n for r in rules for n in (r.field, r.other) if n and n not in paths}
    if unknown:
        raise ValueError(f"rules name unknown fields {sorted(unknown)}")
    limit = lambda v: None if v is None else f"{v:f}"
    return [
        Shape(
            r.rule_id, r.severity, r.message, r.kind, paths[r.field], target_predicate, r.target,
            limit(r.lo), limit(r.hi), r.lo_inclusive, r.hi_inclusive, r.operand,
            paths[r.other] if r.other else None,
        )
        for r in rules
    ]


def _as_rule(shape: Shape) -> Rule:
    """The shape as a rule about the single column ``o``."""
    return Rule(
        shape.rule_id, shape.severity, shape.message, shape.kind, None, "value",
        shape.lo, shape.hi, shape.lo_inclusive, shape.hi_inclusive,
    )


class _Compiled:
    """Tables of what is looked for at the end of which path."""

    def __init__(self, triples: DataFrame, shapes: Sequence[Shape], carried: Mapping[str, Path]):
        self.spark = triples.sparkSession
        self.shapes = [s for s in shapes if s.kind != "none"]
        paths = {s.path for s in self.shapes} | {s.other for s in self.shapes if s.other}
        paths |= {(s.target_predicate,) for s in self.shapes} | set(carried.values())
        number = path_numbers(sorted(paths))
        self.at = {path: number[path] for path in paths}
        reached = reached_values(triples, number, self.at.values())
        # Numbers are read from their text once, where a shape compares them with a limit.
        numbers = {self.at[s.path] for s in self.shapes if s.kind in ("match", "min_exclusive")}
        # Read several times below; a subject reaches a value once, however many ways lead there.
        self.reached = cut_lineage(
            reached.withColumn("number", F.when(F.col("at").isin(sorted(numbers)), to_number(F.col("o"))))
        )

    def of(self, kinds: Sequence[str]) -> list[tuple[int, Shape]]:
        return [(i, s) for i, s in enumerate(self.shapes) if s.kind in kinds]

    def at_ends(self, rows: list[tuple], ddl: str, numbers: Sequence[str] = ()) -> DataFrame:
        """Reached values with the rows (path number first) of the table for their path; some of
        its columns also as numbers."""
        table = literal_table(self.spark, rows, f"end int, {ddl}")
        table = table.withColumns({f"{n}_number": to_number(F.col(n)) for n in numbers})
        values = self.reached.where(F.col("at").isin(sorted({row[0] for row in rows})))
        return spread_join(values, table, [("at", "end")], right_bytes=driver_bytes(rows))

    def focus(self, shapes: Sequence[tuple[int, Shape]]) -> DataFrame:
        """``(focus, shape)`` for the targets of some shapes, each once."""
        rows = [(self.at[(s.target_predicate,)], i, s.target) for i, s in shapes]
        hits = self.at_ends(rows, "shape int, wanted string")
        hits = hits.where(F.col("wanted").isNull() | (F.col("wanted") == F.col("o")))
        return hits.select(F.col("s").alias("focus"), "shape").distinct()


def _offending(compiled: _Compiled) -> DataFrame:
    """``(s, shape, o)`` of values that offend by themselves."""
    some = compiled.of(_OF_VALUE)
    rules = [replace(_as_rule(s), rule_id=str(i)) for i, s in some]
    rows = [
        (compiled.at[s.path], i, s.kind, "value", *rule_row(r)[6:10])
        for (i, s), r in zip(some, rules)
    ]
    ddl = "shape int, kind string, field string, lo string, hi string, lo_inclusive boolean, hi_inclusive boolean"
    hits = compiled.at_ends(rows, ddl, ["lo", "hi"])
    hits = hits.where(violation_of(rules, {"value": "o"}, {"value": "number"}))
    return hits.select("s", "shape", "o")


def _not_instances(compiled: _Compiled, triples: DataFrame) -> DataFrame:
    """``(s, shape, o)`` of values that are not of the class of their shape."""
    some = compiled.of(["instance"])
    rows = [(compiled.at[s.path], i, s.operand) for i, s in some]
    values = compiled.at_ends(rows, "shape int, class string").select("s", "shape", "o", "o_kind", "class")
    names = sorted({s.operand for _, s in some if s.operand})
    types = triples.where((F.col("p") == RDF_TYPE) & F.col("o").isin(names))
    types = types.select(F.col("s").alias("member"), F.col("o").alias("member_class"))
    # A literal is of no class, though its text may be the name of a node.
    node = F.when(F.col("o_kind") != "literal", F.col("o"))
    values = values.withColumn("node", node)
    on = [("node", "member"), ("class", "member_class")]
    return spread_join(values, types, on, how="left_anti").select("s", "shape", "o")


def _not_less(compiled: _Compiled) -> DataFrame:
    """``(s, shape, o)`` of values that are not below all values of the other path.

    The other values of a subject are combined into their least number and least moment, so no pair
    of values is formed.  Numbers compare as numbers, all else as moments.
    """
    some = compiled.of(["less_than"])
    focus = compiled.focus(some).withColumnRenamed("shape", "of_shape")

    def of_targets(ends: list[tuple]) -> DataFrame:
        """Values of targets only; their numbers and moments are read once, after the others are gone."""
        rows = compiled.at_ends(ends, "shape int").select("s", "shape", "o")
        rows = spread_join(rows, focus, [("s", "focus"), ("shape", "of_shape")], how="left_semi")
        return rows.withColumns({"number": to_number(F.col("o")), "moment": instant(F.col("o"))})

    values = of_targets([(compiled.at[s.path], i) for i, s in some])
    others = of_targets([(compiled.at[s.other], i) for i, s in some])
    number, moment = F.col("number"), F.col("moment")
    plain = number.isNull()
    inexact = F.when(number["exact"].isNull(), number["approx"])
    facts = others.groupBy(F.col("s").alias("f_s"), F.col("shape").alias("f_shape")).agg(
        F.count("*").alias("n"),
        F.count(number).alias("n_numbers"),
        F.min(number["exact"]).alias("least_exact"),
        F.min(inexact).alias("least_inexact"),
        F.min(number["approx"]).alias("least_number"),
        F.count(moment).alias("n_moments"),
        F.min(moment).alias("least_moment"),
        F.count(F.when(plain, moment)).alias("n_plain_moments"),
        F.min(F.when(plain, moment)).alias("least_plain_moment"),
    )
    joined = spread_join(
        values, facts, [("s", "f_s"), ("shape", "f_shape")]
    )
    exactly = number["exact"].isNull() | F.col("least_exact").isNull()
    exactly = exactly | (number["exact"] < F.col("least_exact"))
    against = F.when(number["exact"].isNull(), F.col("least_number")).otherwise(F.col("least_inexact"))
    below = exactly & (against.isNull() | (number["approx"] < against))
    # A number against what is no number: both may still be moments.
    n_plain = F.col("n") - F.col("n_numbers")
    rest = (n_plain == 0) | (
        (F.col("n_plain_moments") == n_plain) & (moment < F.col("least_plain_moment"))
    )
    all_moments = (F.col("n_moments") == F.col("n")) & (moment < F.col("least_moment"))
    less = F.when(plain, all_moments).otherwise(below & rest)
    return joined.where(~F.coalesce(less, F.lit(False))).select("s", "shape", "o")


def _unmet(compiled: _Compiled) -> DataFrame:
    """``(focus, shape)`` of subjects whose values, taken together, do not satisfy a shape."""
    some = compiled.of(["has_value", "count"])
    rows = [
        (compiled.at[s.path], i, s.kind == "count", s.operand)
        for i, s in some
    ]
    values = compiled.at_ends(rows, "shape int, counted boolean, operand string")
    values = values.where(F.col("counted") | (F.col("o") == F.col("operand")))
    each = values.groupBy("s", "shape", "o", "o_kind").agg(F.lit(1).alias("one"))
    counts = each.groupBy(F.col("s").alias("c_s"), F.col("shape").alias("c_shape")).agg(
        F.count("*").alias("n")
    )
    focus = compiled.focus(some)
    joined = spread_join(focus, counts, [("focus", "c_s"), ("shape", "c_shape")], how="left")
    n = F.coalesce("n", F.lit(0))
    bounds = [(i, *_bounds(s)) for i, s in some]
    table = literal_table(compiled.spark, bounds, "b_shape int, least bigint, most bigint")
    judged = spread_join(joined, table, [("shape", "b_shape")], right_bytes=driver_bytes(bounds))
    wrong = (n < F.col("least")) | F.coalesce(n > F.col("most"), F.lit(False))
    return judged.where(wrong).select("focus", "shape")


def _bounds(shape: Shape) -> tuple[int, int | None]:
    if shape.kind == "has_value":
        return 1, None
    return int(shape.lo or 0), None if shape.hi is None else int(shape.hi)


def validate_graph(
    triples: DataFrame, shapes: Sequence[Shape], carried: Mapping[str, Path] = CARRIED
) -> DataFrame:
    """Report rows: focusNode, resultSeverity, resultMessage, rule, value and the carried columns.

    One row for every target subject, rule and offending value; ``value`` is NULL where no single
    value offends.  A graph is a set: triples that repeat change nothing.  Carried columns take the
    least of several values along their path, and NULL if there is none.
    """
    compiled = _Compiled(triples, shapes, carried)
    if not compiled.shapes:
        empty = ", ".join(f"{c} string" for c in (*_REPORT, *carried))
        return literal_table(compiled.spark, [], empty)
    parts = []
    if compiled.of(_OF_VALUE):
        parts.append(_offending(compiled))
    if compiled.of(["instance"]):
        parts.append(_not_instances(compiled, triples))
    if compiled.of(["less_than"]):
        parts.append(_not_less(compiled))
    found = []
    if parts:
        of_values = [i for i in compiled.of((*_OF_VALUE, "instance", "less_than"))]
        focus = compiled.focus(of_values).withColumnRenamed("shape", "of_shape")
        offending = reduce(DataFrame.unionByName, parts).distinct()
        on = [("s", "focus"), ("shape", "of_shape")]
        kept = spread_join(offending, focus, on, how="left_semi")
        found.append(kept.select(F.col("s").alias("focusNode"), "shape", F.col("o").alias("value")))
    if compiled.of(["has_value", "count"]):
        nothing = F.lit(None).cast("string").alias("value")
        found.append(_unmet(compiled).select(F.col("focus").alias("focusNode"), "shape", nothing))
    rows = [(i, s.severity, s.message, s.rule_id) for i, s in enumerate(compiled.shapes)]
    names = literal_table(
        compiled.spark, rows, "n_shape int, resultSeverity string, resultMessage string, rule string"
    )
    report = spread_join(
        reduce(DataFrame.unionByName, found), names, [("shape", "n_shape")], right_bytes=driver_bytes(rows)
    ).select(*_REPORT)
    return _with_carried(compiled, report, carried)


_REPORT = ("focusNode", "resultSeverity", "resultMessage", "rule", "value")


def _with_carried(compiled: _Compiled, report: DataFrame, carried: Mapping[str, Path]) -> DataFrame:
    if not carried:
        return report
    ends = {name: compiled.at[path] for name, path in carried.items()}
    least: list[Column] = [
        F.min(F.when(F.col("at") == end, F.col("o"))).alias(name) for name, end in ends.items()
    ]
    facts = compiled.reached.where(F.col("at").isin(sorted(set(ends.values()))))
    facts = facts.groupBy(F.col("s").alias("carrier")).agg(*least)
    joined = spread_join(report, facts, [("focusNode", "carrier")], how="left")
    return joined.select(*report.columns, *carried)
