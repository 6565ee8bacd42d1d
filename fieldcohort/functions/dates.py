"""Date arithmetic. Nothing reads the clock: every rule takes ``as_of``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col, as_date, yes_no

AsOf = str | date | Column


def to_date_or_null(c: str | Column, fmt: str | None = None) -> Column:
    """Parse a date; an unreadable value becomes null instead of an error."""
    col = as_col(c)
    if fmt:
        return F.try_to_timestamp(col.cast("string"), F.lit(fmt)).cast("date")
    return col.try_cast("date")


def to_number_or(c: str | Column, fill: float | None = 0.0) -> Column:
    """Parse a number; an unreadable or missing value becomes ``fill``."""
    num = as_col(c).try_cast("double")
    return num if fill is None else F.coalesce(num, F.lit(float(fill)))


def days_between(start, end) -> Column:
    return F.datediff(as_date(end), as_date(start))


def complete_units(unit: str, start, end) -> Column:
    """Whole months, years or days from start to end, cut towards zero."""
    return F.timestamp_diff(unit, as_date(start), as_date(end))


def complete_months(start, end) -> Column:
    return complete_units("MONTH", start, end)


def complete_years(start, end) -> Column:
    return complete_units("YEAR", start, end)


def age_years_rounded(dob: str | Column, as_of: AsOf) -> Column:
    """Age in years, half to even; unknown birth date gives 0."""
    return F.coalesce(F.bround(days_between(as_col(dob), as_of) / 365.25), F.lit(0.0)).cast("int")


def age_months_rounded(dob: str | Column, as_of: AsOf) -> Column:
    return F.coalesce(F.bround(days_between(as_col(dob), as_of) / 30.44), F.lit(0.0)).cast("int")


def age_years_floor(dob: str | Column, as_of: AsOf) -> Column:
    return F.coalesce(F.floor(days_between(as_col(dob), as_of) / 365.25), F.lit(0)).cast("int")


def age_flag(dob: str | Column, end: AsOf, low: int = 180, high: int = 588) -> Column:
    """yes when the complete months from birth to ``end`` lie in [low, high]."""
    return yes_no(complete_months(as_col(dob), end).between(low, high))


def due_date(last_period: str | Column, extra_days: int = 7) -> Column:
    """Expected delivery: nine months and a week after the episode start."""
    return F.date_add(F.add_months(as_date(as_col(last_period)), 9), extra_days)


def episode_start(due: str | Column) -> Column:
    """The reverse rule: nine months and a week before the due date."""
    return F.date_sub(F.add_months(as_date(as_col(due)), -9), 7)


def gestation_weeks(last_period: str | Column, as_of: AsOf) -> Column:
    return F.coalesce((days_between(as_col(last_period), as_of) / 7).cast("int"), F.lit(0))


def gestation_months(last_period: str | Column, as_of: AsOf) -> Column:
    return F.coalesce((days_between(as_col(last_period), as_of) / 30).cast("int"), F.lit(0))


def trimester(due: str | Column, as_of: AsOf) -> Column:
    """Trimester from the weeks left to the due date."""
    weeks = days_between(as_of, as_col(due)) / 7
    return (
        F.when(weeks.isNull(), F.lit("Inconnu"))
        .when(weeks > 26, F.lit("1st"))
        .when(weeks > 13, F.lit("2nd"))
        .otherwise(F.lit("3rd"))
    )


PERIODS = (
    "current_week",
    "previous_week",
    "current_month",
    "previous_month",
    "last_3_months",
    "all",
)


def period_bounds(name: str, as_of: AsOf) -> tuple[Column, Column]:
    """First and last day (both inside) of a named period around ``as_of``."""
    ref = as_date(as_of)
    monday = F.trunc(ref, "week")
    first = F.trunc(ref, "month")
    if name == "current_week":
        return monday, F.date_add(monday, 6)
    if name == "previous_week":
        return F.date_sub(monday, 7), F.date_sub(monday, 1)
    if name == "current_month":
        return first, F.last_day(ref)
    if name == "previous_month":
        return F.add_months(first, -1), F.date_sub(first, 1)
    if name == "last_3_months":
        return F.add_months(first, -3), F.date_sub(first, 1)
    if name == "all":
        return as_date("2020-01-01"), ref
    raise ValueError(f"unknown period {name!r}; one of {PERIODS}")


def week_start(c: str | Column) -> Column:
    """Monday of the week, the only key weeks are grouped on."""
    return F.trunc(as_date(as_col(c)), "week")


def month_name(c: str | Column) -> Column:
    return F.date_format(as_col(c), "MMMM")


def fiscal_year(c: str | Column, start_month: int = 10) -> Column:
    """The year in which the fiscal year ends."""
    col = as_col(c)
    if start_month == 1:
        return F.year(col)
    return F.year(col) + F.when(F.month(col) >= start_month, 1).otherwise(0)


def fiscal_quarter(c: str | Column, start_month: int = 10) -> Column:
    month = F.month(as_col(c))
    return (F.floor(F.pmod(month - start_month, F.lit(12)) / 3) + 1).cast("int")


def quarter_flag(c: str | Column, quarter: int, as_of: AsOf) -> Column:
    """yes when the date lies in that quarter of the year of ``as_of``."""
    col = as_col(c)
    return yes_no((F.year(col) == F.year(as_date(as_of))) & (F.quarter(col) == quarter))


def period_status(c: str | Column) -> Column:
    """Season label of a date; an unknown date stays unknown."""
    month = F.month(as_col(c))
    # The labels of the seasons.
    return (
        F.when(month <= 4, F.lit("janvier-avril"))
        .when(month <= 9, F.lit("mai-septembre"))
        .when(month <= 12, F.lit("octobre-decembre"))
    )


def appointment_gap_bucket(visit: str | Column, next_visit: str | Column) -> Column:
    days = days_between(as_col(visit), as_col(next_visit))
    return (
        F.when(days.between(0, 35), F.lit("0-35"))
        .when(days.between(36, 89), F.lit("36-89"))
        .when(days.between(90, 120), F.lit("90-120"))
        .when(days.between(121, 180), F.lit("121-180"))
        .when(days > 180, F.lit(">180"))
    )


def lost_to_followup_flags(appointment: str | Column, as_of: AsOf) -> dict[str, Column]:
    """How late a person is against the next appointment, as yes/no columns."""
    appt = as_date(as_col(appointment))
    months = complete_months(appt, as_of)
    return {
        "ltfu_over_30_days": yes_no(days_between(appt, as_of) > 30),
        "ltfu_1_to_6_months": yes_no((months >= 1) & (months < 6)),
        "ltfu_6_to_12_months": yes_no((months >= 6) & (months < 12)),
        "ltfu_over_6_months": yes_no(months >= 6),
        "ltfu_over_12_months": yes_no(months >= 12),
    }


def next_test_date(last_test: str | Column, suppressed: Column) -> Column:
    """Suppressed people are retested after a year, others after six months."""
    last = as_date(as_col(last_test))
    return F.when(suppressed, F.add_months(last, 12)).otherwise(F.add_months(last, 6))


def test_eligible(last_test: str | Column, suppressed: Column, therapy_start: str | Column, as_of: AsOf) -> Column:
    """YES when the next test is due; never tested: due after six months of therapy."""
    due = next_test_date(last_test, suppressed)
    first_due = F.add_months(as_date(as_col(therapy_start)), 6)
    ok = F.when(as_col(last_test).isNotNull(), due <= as_date(as_of)).otherwise(first_due <= as_date(as_of))
    return F.when(ok, F.lit("YES")).otherwise(F.lit("NO"))


def active_within(last: str | Column, as_of: AsOf, months: int = 12) -> Column:
    return yes_no(as_date(as_col(last)) >= F.add_months(as_date(as_of), -months))


def merged_delivery_date(actual: str | Column, *others: str | Column) -> Column:
    """The recorded date, else the latest of the other known dates."""
    rest = [as_date(as_col(c)) for c in others]
    best = F.greatest(*rest) if len(rest) > 1 else rest[0]
    return F.coalesce(as_date(as_col(actual)), best)


def breastfeeding_status(infant_dob: Column, delivery: Column, terminated: Column, as_of: AsOf) -> Column:
    """Under 24 complete months since a birth; a terminated episode counts only
    through a known infant."""
    return (
        F.when(complete_months(infant_dob, as_of) < 24, F.lit("yes"))
        .when(terminated, F.lit("no"))
        .otherwise(yes_no(complete_months(delivery, as_of) < 24))
    )


def pregnant_status(start: Column, delivery: Column, expected: Column, terminated: Column, as_of: AsOf) -> Column:
    """Episode under nine complete months or expected in the future, with no
    termination and no delivery in the last five months."""
    ref = as_date(as_of)
    just_delivered = F.coalesce(delivery.between(F.add_months(ref, -5), ref), F.lit(False))
    open_episode = (complete_months(start, as_of) < 9) | (F.coalesce(delivery, expected) > ref)
    return yes_no(~just_delivered & ~F.coalesce(terminated, F.lit(False)) & F.coalesce(open_episode, F.lit(False)))


def reference_month_last_year(as_of: AsOf) -> Column:
    """First day of the previous month, one year earlier."""
    return F.add_months(F.trunc(as_date(as_of), "month"), -13)
