"""Column expressions shared by the operators."""

from normwatch.functions.identity import alarm_key, record_key, rule_alarm_key
from normwatch.functions.iris import expand_iri
from normwatch.functions.numbers import compared, is_number, to_number
from normwatch.functions.times import date_as_written, instant, now_or

__all__ = [
    "alarm_key",
    "compared",
    "date_as_written",
    "expand_iri",
    "instant",
    "is_number",
    "now_or",
    "record_key",
    "rule_alarm_key",
    "to_number",
]
