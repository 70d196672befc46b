"""Numbers that arrive as text, double or decimal, compared without losing digits or range.

A number is a pair: its exact decimal, where it has a plain form that fits, and its double.  Two
numbers are compared exactly if both are exact, and as doubles otherwise, so no valid number is
ever missing: ``1e30`` and numbers with very many digits have only a double.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The written form of a number, with or without an exponent.
NUMBER_FORM = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
# A plain form that ``_EXACT`` holds digit for digit.
_PLAIN_FORM = r"^\s*[+-]?0*\d{0,20}(\.\d{0,18}0*)?\s*$"
_EXACT = "decimal(38,18)"


def is_number(col: Column) -> Column:
    """Whether the text of ``col`` has the form of a number; NULL for NULL."""
    return F.rlike(col.cast("string"), F.lit(NUMBER_FORM))


def to_number(col: Column) -> Column:
    """The pair ``(exact, approx)`` of a number or of its text; NULL for any other text.

    A double is taken as it is: its shortest text is exact only if it is the number that was meant.
    """
    text = col.cast("string")
    exact = F.when(F.rlike(text, F.lit(_PLAIN_FORM)), text.try_cast(_EXACT))
    pair = F.struct(exact.alias("exact"), text.try_cast("double").alias("approx"))
    return F.when(is_number(col), pair)


def compared(a: Column, b: Column, test: Callable[[Column, Column], Column]) -> Column:
    """``test`` of two numbers of :func:`to_number`; NULL if one is missing."""
    both = a["exact"].isNotNull() & b["exact"].isNotNull()
    return F.when(both, test(a["exact"], b["exact"])).otherwise(test(a["approx"], b["approx"]))
