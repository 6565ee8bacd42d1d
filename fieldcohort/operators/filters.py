"""Row selection rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import due_date, episode_start, to_number_or
from ..functions.nulls import as_col, as_date, differs, not_in
from .clean import ensure_columns, quoted

ALL = "all"


def on_or_between(c: str | Column, start=None, end=None) -> Column:
    """Date window with both ends inside.

    The column is compared at its own type (``>= start`` and ``< end + 1 day``)
    so that the filter reaches the parquet scan.
    """
    col = as_col(c)
    tests = []
    if start is not None:
        tests.append(col >= as_date(start))
    if end is not None:
        tests.append(col < F.date_add(as_date(end), 1))
    return reduce(and_, tests) if tests else F.lit(True)


def between_dates(df: DataFrame, col: str, start, end) -> DataFrame:
    return df.where(on_or_between(quoted(col), start, end))


def screened_in_period(df: DataFrame, col: str, start, end, ref) -> DataFrame:
    """In the window and not before a reference date."""
    return df.where(on_or_between(quoted(col), start, end) & (quoted(col) >= as_date(ref)))


def enrolled_with_visits(
    df: DataFrame,
    since,
    enrolled: str = "is_enrolled",
    visits: str = "nbr_visit_succeed",
    date1: str = "enrollement_date_de_visite",
    date2: str = "date_admission",
) -> DataFrame:
    """(Enrolled or visited) and enrolled on/after ``since`` by either date."""
    df = ensure_columns(
        df,
        {enrolled: (None, "string"), visits: (None, "string"), date1: (None, "date"), date2: (None, "date")},
    )
    first = (quoted(enrolled) == "yes") | (to_number_or(quoted(visits)) > 0)
    second = (quoted(date1) >= as_date(since)) | (quoted(date2) >= as_date(since))
    return df.where(first & second)


def exclude_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop listed values and keep rows with no value."""
    return df.where(not_in(quoted(col), values))


def not_equal_keep_null(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(differs(quoted(col), value))


def open_cases(df: DataFrame, col: str = "closed_date", open_value="---") -> DataFrame:
    return df.where(quoted(col) == open_value)


def sequential_filter(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Apply exclusion steps in order; a row must pass each one."""
    return df.where(reduce(and_, [F.coalesce(cond, F.lit(False)) for _, cond in steps]))


def attrition(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each step, from one pass over the table."""
    counts, passed = [F.count(F.lit(1)).alias("n0")], F.lit(True)
    for i, (_, cond) in enumerate(steps, start=1):
        passed = passed & F.coalesce(cond, F.lit(False))
        counts.append(F.count_if(passed).alias(f"n{i}"))
    names = ["initial"] + [name for name, _ in steps]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(f"n{i}").alias("rows_left"))
            for i, n in enumerate(names)
        ]
    )
    return df.agg(*counts).select(F.inline(rows))


def in_range_list(df: DataFrame, col: str, low: int, high: int, kind: str, kinds: Sequence) -> DataFrame:
    """Whole number in [low, high] and category in a list."""
    return df.where(quoted(col).between(low, high) & quoted(kind).isin(*kinds))


def conjunctive_filter(
    df: DataFrame,
    *,
    user: str,
    users: Sequence,
    day: str,
    start,
    end,
    closed: Column,
    cycle_blank: Column,
    area: str,
    not_area,
) -> DataFrame:
    """Listed agents, date window, open, cycle not started, area excluded."""
    return df.where(
        quoted(user).isin(*users)
        & on_or_between(quoted(day), start, end)
        & ~closed
        & cycle_blank
        & differs(quoted(area), not_area)
    )


def dashboard_filter(
    df: DataFrame,
    *,
    office: tuple[str, str | None] | None = None,
    communes: tuple[str, Sequence | None] | None = None,
    dates: tuple[str, object, object] | None = None,
) -> DataFrame:
    """Optional filters as (column, choice); ``all`` or an empty choice keeps all rows."""
    if office and office[1] and office[1] != ALL:
        df = df.where(quoted(office[0]) == office[1])
    if communes and communes[1] and ALL not in communes[1]:
        df = df.where(quoted(communes[0]).isin(*communes[1]))
    if dates:
        df = df.where(on_or_between(quoted(dates[0]), dates[1], dates[2]))
    return df


def exclude_on_alias(df: DataFrame, **excluded: Sequence) -> DataFrame:
    """Filter on projected columns; like SQL NOT IN, a null value is dropped."""
    return df.where(reduce(and_, [~F.col(c).isin(*values) for c, values in excluded.items()]))


def future_rows(df: DataFrame, col: str, as_of) -> DataFrame:
    return df.where(quoted(col) >= F.date_add(as_date(as_of), 1))


def last_n_days(df: DataFrame, col: str, days: int, as_of) -> DataFrame:
    """The trailing window of ``days`` days that ends on ``as_of``."""
    ref = as_date(as_of)
    return df.where(on_or_between(quoted(col), F.date_sub(ref, days - 1), ref))


def last_n_months(df: DataFrame, col: str, months: int, as_of) -> DataFrame:
    ref = as_date(as_of)
    return df.where(on_or_between(quoted(col), F.date_add(F.add_months(ref, -months), 1), ref))


def episode_overlaps(start: Column, due: Column, period_start, period_end) -> Column:
    """Does the episode overlap the period?

    A missing end is derived from the start and the reverse.
    """
    first = F.coalesce(as_date(start), episode_start(due))
    last = F.coalesce(as_date(due), due_date(start))
    return (last >= as_date(period_start)) & (first <= as_date(period_end))
