"""Time text: kept verbatim, with the written date and the instant derived beside it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_as_written(col: Column) -> Column:
    """The calendar date in the text, whatever offset follows it; NULL for malformed text."""
    return col.cast("string").try_cast("date")


def instant(col: Column) -> Column:
    """The moment an ISO text with offset denotes; NULL for malformed text."""
    return col.try_cast("timestamp")


def now_or(as_of: str | None) -> Column:
    """The clock of the query, or the given moment so that a rerun repeats the result."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
