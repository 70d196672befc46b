"""Repeatable identifiers.

``uuid()`` changes with the partitioning and with every retry of a task, so derived records are
named by a hash of what they were derived from.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def alarm_key(
    observation: Column, time_text: Column, band: Column, operating_no: Column
) -> Column:
    """Hash of observation id, time as written, band id and the operating property it was resolved
    with (its place in the list of the system).

    The parts are hashed as a JSON array: a missing part stays apart from an empty one, and no part
    runs into the next.
    """
    parts = F.array(*[c.cast("string") for c in (observation, time_text, band, operating_no)])
    return F.md5(F.to_json(parts).cast("binary"))


def record_key(*fields: Column) -> Column:
    """Hash of several named fields, NULL ones included."""
    return F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary"))


def rule_alarm_key(observation_iri: Column, time_text: Column) -> Column:
    """Hash of the full observation IRI and the time as written; leaves the rule out, so all
    violations of one observation share it."""
    text = F.concat(observation_iri, F.lit("-"), time_text.cast("string"))
    return F.md5(text.cast("binary"))
