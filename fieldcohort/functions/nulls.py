"""Predicates and defaults that treat missing values the way field data needs.

Exports mix SQL NULL with textual blanks, and exclusion rules must keep the
rows whose value is unknown; plain ``!=`` and ``NOT IN`` would drop them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ways a blank is written in the exports.
BLANK_MARKS = ("---", "//", "", "0", "0000-00-00")
# What a blank is filled with, by type.
BLANK_DATE = "1901-01-01"
BLANK_TEXT = "no_info"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: str | date | Column) -> Column:
    """A date column from a literal or a column of any date-like type."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def differs(c: str | Column, value) -> Column:
    """``c != value`` that is true when ``c`` is null."""
    return ~as_col(c).eqNullSafe(value)


def not_in(c: str | Column, values: Sequence) -> Column:
    """``c NOT IN values`` that is true when ``c`` is null."""
    col = as_col(c)
    return col.isNull() | ~col.isin(*values)


def blank_to_null(c: str | Column, marks: Sequence = BLANK_MARKS) -> Column:
    col = as_col(c)
    return F.when(~col.isin(*marks), col)


def yes_no(cond: Column) -> Column:
    """yes when the condition holds, no when it does not or is unknown."""
    return F.when(cond, F.lit("yes")).otherwise(F.lit("no"))
