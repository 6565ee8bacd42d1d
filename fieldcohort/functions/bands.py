"""Bands, scores and case rules as single expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col, as_date, yes_no

# Planned visits per case type and the highest count the rule covers.
PLANNED_VISITS = {"MAM": (8, 12), "MAS": (12, 18)}
# Arm circumference limits in centimetres.
MUAC_SEVERE, MUAC_MODERATE = 11.5, 12.5


def visits_remaining(kind: str | Column, done: str | Column, clip: bool = True) -> Column:
    """Planned minus done visits by case type, 0 outside the covered range."""
    kind_col, done_col = as_col(kind), as_col(done)
    out = None
    for label, (planned, covered) in PLANNED_VISITS.items():
        cond = (kind_col == label) & (done_col <= covered)
        left = F.lit(planned) - done_col
        out = F.when(cond, left) if out is None else out.when(cond, left)
    out = F.coalesce(out.otherwise(0), F.lit(0)).cast("int")
    return F.greatest(out, F.lit(0)) if clip else out


def health_index(weights: Mapping[str, float], scale: float = 22.0) -> Column:
    """Weighted symptom sum on a 0-10 scale."""
    total = None
    for name, weight in weights.items():
        term = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(weight))
        total = term if total is None else total + term
    return total / F.lit(float(scale)) * 10


def risk_band(score: str | Column) -> Column:
    col = as_col(score)
    return F.when(col <= 3, "low").when(col <= 6, "moderate").when(col > 6, "high")


def muac_class(muac_cm: str | Column) -> Column:
    """Arm circumference in cm to MAS / MAM / none; missing gives n/a."""
    col = as_col(muac_cm)
    return (
        F.when(col.isNull(), "n/a")
        .when(col < MUAC_SEVERE, "MAS")
        .when(col < MUAC_MODERATE, "MAM")
        .otherwise("none")
    )


def age_band_months(months: str | Column) -> Column:
    col = as_col(months)
    return (
        F.when(col < 6, "<6").when(col < 24, "6-23").when(col < 60, "24-59").when(col >= 60, "60+")
    )


def age_band_0_2_12(months: str | Column) -> Column:
    col = as_col(months)
    return F.when(col < 0, None).when(col <= 2, "0-2").when(col <= 12, "2-12").when(col > 12, "+12")


def band(value: str | Column, edges: Sequence[tuple[float, str]], last: str | None = None) -> Column:
    """First label whose upper edge lies above the value, else ``last``."""
    col = as_col(value)
    out = None
    for upper, label in edges:
        out = F.when(col < upper, label) if out is None else out.when(col < upper, label)
    return out if last is None else out.when(col.isNotNull(), last)


# Age bands in years as (upper edge, label).
AGE_YEAR_EDGES = ((1, "< 1"), (5, "1 - 4"), (10, "5 - 9"), (15, "10 - 14"), (18, "15 - 17"), (21, "18 - 20"))


def age_band_years(age: str | Column) -> Column:
    return band(age, AGE_YEAR_EDGES, "21+")


def safe_pct(num: Column, den: Column, digits: int = 1) -> Column:
    """Percentage that is 0 where the base is 0."""
    return F.when(den > 0, F.bround(num * 100.0 / den, digits)).otherwise(F.lit(0.0))


def suppressed_flag(undetectable: Column, count: Column, limit: float = 1000) -> Column:
    return F.when(undetectable | (count < limit), "OUI").when(count >= limit, "NON")


def active_case(start, end, *, closed, created, graduated, abandoned, inactive, is_inactive, is_graduated) -> Column:
    """Was the case active in [start, end]? First matching rule wins and a
    missing date never matches."""
    lo, hi = as_date(start), as_date(end)
    none_set = (F.coalesce(is_inactive, F.lit(0)) == 0) & (F.coalesce(is_graduated, F.lit(0)) == 0)
    return (
        F.when(closed < lo, "no")
        .when(created > hi, "no")
        .when(graduated > lo, "yes")
        .when(abandoned > lo, "yes")
        .when(inactive > lo, "yes")
        .when(inactive < lo, "no")
        .when(graduated < lo, "no")
        .when(none_set, "yes")
        .otherwise("no")
    )


def active_group(start, end, *, office, excluded: Sequence, closed, created, graduated, inactive, is_inactive, is_graduated) -> Column:
    """Was the group active in [start, end]? Groups of excluded offices never
    are; abandoning plays no part. First matching rule wins and a missing date
    never matches."""
    rule = active_case(
        start, end, closed=closed, created=created, graduated=graduated, abandoned=F.lit(None).cast("date"),
        inactive=inactive, is_inactive=is_inactive, is_graduated=is_graduated,
    )
    return F.when(office.isin(*excluded), F.lit("no")).otherwise(rule)


def period_eligible(user: str | Column, day: str | Column, users: Sequence, start, end) -> Column:
    return yes_no(as_col(user).isin(*users) & as_date(as_col(day)).between(as_date(start), as_date(end)))


def pick_reason(counts: Mapping[str, str | Column], default: str = "no_info") -> Column:
    """First label, in priority order, whose count is not zero."""
    return F.coalesce(
        *[F.when(F.coalesce(as_col(c), F.lit(0)) != 0, F.lit(label)) for label, c in counts.items()],
        F.lit(default),
    )
