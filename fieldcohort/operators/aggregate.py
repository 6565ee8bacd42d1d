"""Counts, rates, pivots and KPI rows.

Everything is a grouped aggregate that Spark combines before its shuffle.
Pivots take their value list, so no extra pass finds it and width is known.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import safe_pct
from ..functions.nulls import as_date
from .clean import quoted, value_names
from .filters import on_or_between

TOTAL = "Total"
#: Column and band of what was not declared.
OTHER = "other"


def _known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with all grouping keys set: a missing key forms no group."""
    for k in keys:
        df = df.where(quoted(k).isNotNull())
    return df


def with_margin(counts: DataFrame, name: str) -> DataFrame:
    """Add a total row over all measures of a grouped table.

    The grouped rows are rolled up, so the detail is neither read twice nor
    expanded.
    """
    measures = [c for c in counts.columns if c != name]
    rolled = counts.rollup(quoted(name)).agg(
        F.grouping(name).alias("_g"), *[F.coalesce(F.sum(quoted(c)), F.lit(0)).alias(c) for c in measures]
    )
    label = F.when(F.col("_g") == 1, TOTAL).otherwise(quoted(name))
    return rolled.select(label.alias(name), *[quoted(c) for c in measures])


def count_by(df: DataFrame, col: str, total: bool = True) -> DataFrame:
    """Group sizes, largest first, with the grand total as one more row."""
    counts = _known(df, col).groupBy(quoted(col).cast("string").alias(col)).agg(F.count(F.lit(1)).alias("n"))
    if total:
        counts = with_margin(counts, col)
    return counts.orderBy(F.col("n").desc(), F.col(col))


def typed_aggregates(
    df: DataFrame,
    key: str,
    *,
    order: Sequence[str],
    count_cols: Sequence[str] = (),
    span_cols: Sequence[str] = (),
    last_cols: Sequence[str] = (),
) -> list[Column]:
    """One aggregate per column, chosen by its type.

    Counted ids, first and last of the span dates, newest other dates, summed
    numbers, last value of named columns, else the first non-null value; first
    and last follow the ``order`` columns.
    """
    place = F.struct(*[quoted(c) for c in order])
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if f.name == key:
            continue
        if f.name in count_cols:
            out.append(F.count(c).alias(f.name))
        elif f.name in span_cols:
            out += [F.min(c).alias(f"first_{f.name}"), F.max(c).alias(f"last_{f.name}")]
        elif f.name in last_cols:
            out.append(F.max_by(c, F.when(c.isNotNull(), place)).alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(F.max(c).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            out.append(F.sum(c).alias(f.name))
        else:
            out.append(F.min_by(c, F.when(c.isNotNull(), place)).alias(f.name))
    return out


def smart_aggregate(df: DataFrame, key: str, **policy) -> DataFrame:
    """One row per key with every column aggregated by type."""
    return _known(df, key).groupBy(key).agg(*typed_aggregates(df, key, **policy))


def collapse_keep_all(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Fixed policy: numbers summed, dates newest, texts first non-null."""
    return smart_aggregate(df, key, order=order)


def conditional_counts(df: DataFrame, key: str, conds: Mapping[str, Column]) -> DataFrame:
    return _known(df, key).groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in conds.items()])


def count_distinct_by(df: DataFrame, key: str, cols: Mapping[str, str]) -> DataFrame:
    return _known(df, key).groupBy(key).agg(*[F.count_distinct(quoted(c)).alias(n) for n, c in cols.items()])


def first_last_dates(df: DataFrame, key: str, day: str, as_of, active_days: int = 365) -> DataFrame:
    """First and last date, days since the last, and whether that is recent."""
    spans = _known(df, key).groupBy(key).agg(
        F.min(as_date(quoted(day))).alias("first_date"), F.max(as_date(quoted(day))).alias("last_date")
    )
    since = F.datediff(as_date(as_of), F.col("last_date"))
    return spans.withColumn("days_since", since).withColumn(
        "is_active", F.when(since <= active_days, "yes").otherwise("no")
    )


def string_agg_by(df: DataFrame, key: str, value: Column, out: str, sep: str = ", ") -> DataFrame:
    """Distinct values of each key in order as one text.

    Values are made distinct in a grouped pass first, so a frequent key
    gathers its vocabulary and not its rows.
    """
    pairs = _known(df, key).select(F.col(key), value.cast("string").alias("_v")).where("_v is not null").distinct()
    return pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("_v")), sep).alias(out))


def rate_by(df: DataFrame, key: Column | str, cond: Column, name: str, digits: int = 1) -> DataFrame:
    """Share of rows that meet the condition, in percent, per group."""
    col = quoted(key) if isinstance(key, str) else key
    grouped = df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("n"), F.count_if(cond).alias("hits"))
    return grouped.where(F.col(name).isNotNull()).withColumn("rate", safe_pct(F.col("hits"), F.col("n"), digits))


def with_total(df: DataFrame, value: str, total: str, by: Sequence[str] = ()) -> DataFrame:
    """Attach the sum of ``value`` over all rows or per group."""
    if not by:
        return df.withColumn(total, df.agg(F.sum(value)).scalar())
    return df.join(df.groupBy(*by).agg(F.sum(value).alias(total)), list(by), "left")


def distribution(df: DataFrame, col: str, digits: int = 1) -> DataFrame:
    """Count and percent of the total per value; the total is one row."""
    counts = _known(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return with_total(counts, "n", "_t").withColumn("pct", safe_pct(F.col("n"), F.col("_t"), digits)).drop("_t")


def share_within(df: DataFrame, category: str, target: str, digits: int = 1) -> DataFrame:
    """Percent of each target inside its category."""
    counts = _known(df, category, target).groupBy(category, target).agg(F.count(F.lit(1)).alias("n"))
    shares = with_total(counts, "n", "_t", [category])
    return shares.withColumn("pct", safe_pct(F.col("n"), F.col("_t"), digits)).drop("_t")


# Label pattern of each bucket size.
BUCKET_LABELS = {"day": "yyyy-MM-dd", "week": "dd MMM", "month": "yyyy-MM", "quarter": "yyyy-'Q'q", "year": "yyyy"}


def time_bucket(c: Column, unit: str) -> Column:
    if unit == "day":
        return as_date(c)
    return F.date_trunc(unit, c).cast("date")


def time_bucket_counts(df: DataFrame, col: str, unit: str) -> DataFrame:
    """Counts per calendar bucket in time order, with a label.

    ``weekday`` groups on the day of the week (1 is Monday).
    """
    rows = _known(df, col)
    if unit == "weekday":
        number = F.weekday(quoted(col)) + 1
        counts = rows.groupBy(number.alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.date_format(quoted(col), "EEEE")).alias("label")
        )
        return counts.select("bucket", "label", "n").orderBy("bucket")
    counts = rows.groupBy(time_bucket(quoted(col), unit).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    label = F.date_format("bucket", BUCKET_LABELS[unit])
    return counts.select("bucket", label.alias("label"), "n").orderBy("bucket")


def time_buckets_of_all_units(df: DataFrame, col: str, units: Sequence[str] = ("day", "week", "month", "quarter", "weekday")) -> DataFrame:
    """(unit, bucket as text, label, n) for several units from one pass.

    Rows are counted per day first; every other unit is rolled up from the days.
    """
    days = _known(df, col).groupBy(as_date(quoted(col)).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    marks = []
    for unit in units:
        if unit == "weekday":
            bucket, label = (F.weekday("day") + 1).cast("string"), F.date_format("day", "EEEE")
        else:
            start = time_bucket(F.col("day"), unit)
            bucket, label = start.cast("string"), F.date_format(start, BUCKET_LABELS[unit])
        marks.append(F.struct(F.lit(unit).alias("unit"), bucket.alias("bucket"), label.alias("label")))
    each = days.select("n", F.inline(F.array(*marks)))
    return each.groupBy("unit", "bucket", "label").agg(F.sum("n").alias("n"))


def fill_buckets(counts: DataFrame, unit: str) -> DataFrame:
    """Add the empty buckets between the first and the last as 0."""
    span = counts.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).where("lo is not null")
    every = span.select(F.explode(F.sequence("lo", "hi", F.expr(f"interval 1 {unit}"))).alias("bucket"))
    return every.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n")).orderBy("bucket")


def density_fill_buckets(df: DataFrame, col: str, unit: str = "day") -> DataFrame:
    """Counts per bucket from first to last, empty buckets as 0."""
    counts = _known(df, col).groupBy(time_bucket(quoted(col), unit).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return fill_buckets(counts, unit)


def crosstab(
    df: DataFrame,
    row: Column,
    row_name: str,
    col: str,
    values: Sequence,
    *,
    measure: Column | None = None,
    margins: bool = True,
    percent: bool = False,
    digits: int = 1,
) -> DataFrame:
    """Rows by columns with counts (or a summed measure) and totals.

    One grouped pass over the rows with one conditional aggregate per declared
    column; the total row is rolled up from its result. Values that are not
    declared are summed up in the column ``other``, so totals hold all rows; a
    missing row or column value is in neither.
    """
    base = df.select(row.cast("string").alias(row_name), quoted(col).alias("_col"),
                     (F.lit(1) if measure is None else measure).alias("_m")).where(
        F.col(row_name).isNotNull() & F.col("_col").isNotNull()
    )
    names = value_names(values, taken=[row_name, "total", OTHER])
    aggs = [F.coalesce(F.sum(F.when(F.col("_col") == F.lit(v), F.col("_m"))), F.lit(0)).alias(n) for v, n in names.items()]
    aggs.append(F.coalesce(F.sum(F.when(~F.col("_col").isin(*values), F.col("_m"))), F.lit(0)).alias(OTHER))
    aggs.append(F.coalesce(F.sum("_m"), F.lit(0)).alias("total"))
    body = base.groupBy(row_name).agg(*aggs)
    if margins:
        body = with_margin(body, row_name)
    if percent:
        body = body.withColumns({f"{n}_pct": safe_pct(F.col(n), F.col("total"), digits) for n in [*names.values(), OTHER]})
    return body


def category_order_by_total(table: DataFrame, row_name: str) -> DataFrame:
    """Crosstab rows, largest total first, the margin last."""
    return table.orderBy((F.col(row_name) == TOTAL).asc(), F.col("total").desc(), F.col(row_name))


def pivot_margins(
    df: DataFrame,
    index: Column,
    index_name: str,
    groups: Sequence[tuple[str, Sequence]],
    total: bool = True,
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Counts of one or two nested column levels with row and column totals.

    Rows whose levels are not declared are counted in the column ``other``, so
    totals hold all rows; a missing index or level is not counted. ``counts``
    adds the number of rows that meet a condition on the levels.
    """
    (outer, outer_values), *rest = groups
    base = df.select(index.cast("string").alias(index_name), *[quoted(g).alias(g) for g, _ in groups])
    base = base.dropna(subset=[index_name, *[g for g, _ in groups]])
    cells = {n: F.col(outer) == F.lit(v) for v, n in value_names(outer_values, taken=[index_name, "total", OTHER]).items()}
    for inner, inner_values in rest:
        inner_names = value_names(inner_values)
        cells = {f"{n}_{m}": c & (F.col(inner) == F.lit(w)) for n, c in cells.items() for w, m in inner_names.items()}
    declared = functools.reduce(lambda one, two: one | two, cells.values())
    aggs = [F.count_if(c).alias(n) for n, c in cells.items()] + [F.count_if(~declared).alias(OTHER), F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(c).alias(n) for n, c in (counts or {}).items()]
    body = base.groupBy(index_name).agg(*aggs)
    return with_margin(body, index_name) if total else body


def add_found_percentage(pivot: DataFrame, found_cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Sum of the found columns and its share of the total, as a number."""
    found = sum((F.col(c) for c in found_cols[1:]), F.col(found_cols[0]))
    return pivot.withColumn("total_found", found).withColumn(
        "pct_found", safe_pct(F.col("total_found"), F.col("total"), digits)
    )


def attendance_summary(df: DataFrame, key: str, present: Column) -> DataFrame:
    return _known(df, key).groupBy(key).agg(
        F.count_if(present).alias("present"), F.count_if(~F.coalesce(present, F.lit(False))).alias("absent")
    )


def heatmap_matrix(df: DataFrame, row: str, col: str, values: Sequence, measure: Column) -> DataFrame:
    """Summed measure per row and declared column, missing cells as 0; ``other`` sums all other columns."""
    zero = F.lit(0)
    cells = [
        F.coalesce(F.sum(F.when(quoted(col) == F.lit(v), measure)), zero).alias(n)
        for v, n in value_names(values, taken=[row, OTHER]).items()
    ]
    rest = F.coalesce(F.sum(F.when(F.coalesce(~quoted(col).isin(*values), F.lit(True)), measure)), zero).alias(OTHER)
    return _known(df, row).groupBy(row).agg(*cells, rest)


def profile(df: DataFrame) -> DataFrame:
    """Type, null count and numeric statistics per column, from one pass.

    Quartiles are approximate on large inputs (``percentile_approx`` with
    accuracy 10 000); they are values that occur.
    """
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(df.schema.fields):
        c = quoted(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        num = c.cast("double") if numeric else F.lit(None).cast("double")
        stats = {"min": F.min(num), "max": F.max(num), "mean": F.avg(num), "std": F.stddev(num)}
        aggs += [F.count(c).alias(f"c{i}"), *[v.alias(f"{k}{i}") for k, v in stats.items()]]
        aggs.append(F.percentile_approx(num, [0.25, 0.5, 0.75], 10_000).alias(f"q{i}"))
        quartiles = [F.get(F.col(f"q{i}"), F.lit(k)).alias(n) for k, n in enumerate(("q25", "q50", "q75"))]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                (F.col("_rows") - F.col(f"c{i}")).alias("n_null"),
                *[F.col(f"{k}{i}").alias(k) for k in stats],
                *quartiles,
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def top_categories(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """The most frequent values of each column as one long table."""
    from .latest import top_n_per_key

    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("value")) for c in cols])))
    counts = pairs.where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return top_n_per_key(counts, "column_name", [F.col("n").desc(), F.col("value")], k, "rank")


def top_key(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value and its count; a tie goes to the smaller value."""
    counts = _known(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(col)).limit(1)


def kpi_row(df: DataFrame, counts: Mapping[str, Column], rates: Mapping[str, tuple[str, str]], digits: int = 1) -> DataFrame:
    """One row of aggregates and guarded rates between them."""
    row = df.agg(*[c.alias(n) for n, c in counts.items()])
    return row.withColumns({n: safe_pct(F.col(a), F.col(b), digits) for n, (a, b) in rates.items()})


def kpi_by_office(
    screened: DataFrame,
    enrolled: DataFrame,
    office: str,
    counts: Mapping[str, Column],
    rates: Mapping[str, tuple[str, str]],
    digits: int = 1,
) -> DataFrame:
    """The same per office; the two sides are grouped before they are joined."""
    left = _known(screened, office).groupBy(office).agg(*[c.alias(n) for n, c in counts.items()])
    right = _known(enrolled, office).groupBy(office).agg(F.count(F.lit(1)).alias("enrolled"))
    out = left.join(right, office, "left").withColumn("enrolled", F.coalesce("enrolled", F.lit(0)))
    return out.withColumns({n: safe_pct(F.col(a), F.col(b), digits) for n, (a, b) in rates.items()})


def period_compare(df: DataFrame, day: str, start, end) -> DataFrame:
    """Rows in the period, in the equally long period before it, and the change."""
    lo, hi = as_date(start), as_date(end)
    before_lo = F.date_sub(lo, F.datediff(hi, lo) + 1)
    before_hi = F.date_sub(lo, 1)
    both = df.where(on_or_between(quoted(day), before_lo, hi))
    d = as_date(quoted(day))
    row = both.agg(
        F.count_if(d.between(lo, hi)).alias("current_n"), F.count_if(d.between(before_lo, before_hi)).alias("previous_n")
    )
    change = (F.col("current_n") - F.col("previous_n")) * 100.0 / F.col("previous_n")
    return row.withColumn("pct_change", F.when(F.col("previous_n") > 0, F.bround(change, 2)).otherwise(F.lit(0.0)))


# Months in fiscal order.
FISCAL_MONTHS = {"oct": 10, "nov": 11, "dec": 12, "jan": 1, "feb": 2, "mar": 3,
                 "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9}


def month_wide_counts(df: DataFrame, key: str, day: str) -> DataFrame:
    """One count column per month, October to September."""
    cells = [F.count_if(F.month(quoted(day)) == m).alias(n) for n, m in FISCAL_MONTHS.items()]
    return _known(df, key).groupBy(key).agg(*cells, F.count(F.lit(1)).alias("total"))


def sum_by(df: DataFrame, key: str, value: Column, out: str) -> DataFrame:
    """Sum per key and the grand total as one more row."""
    sums = _known(df, key).groupBy(quoted(key).cast("string").alias(key)).agg(F.sum(value).alias(out))
    return with_margin(sums, key)


def age_pyramid(df: DataFrame, band: Column, sex: str, sexes: Sequence) -> DataFrame:
    """Band by sex counts; every sex has its column.

    Rows of any other or missing sex are counted in ``other``, rows without a
    band in the band ``other``.
    """
    rows = df.select(F.coalesce(band.cast("string"), F.lit(OTHER)).alias("band"), quoted(sex).alias("_sex"))
    names = value_names(sexes, taken=["band", OTHER])
    rest = F.count_if(F.coalesce(~F.col("_sex").isin(*sexes), F.lit(True))).alias(OTHER)
    return rows.groupBy("band").agg(*[F.count_if(F.col("_sex") == F.lit(s)).alias(n) for s, n in names.items()], rest)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return _known(df, col).select(quoted(col).alias(col)).distinct().orderBy(col)


def indicator_rows(row: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide counts as (indicator, n) rows, zeros left out."""
    cells = F.array(*[F.struct(F.lit(n).alias("indicator"), F.col(n).cast("long").alias("n")) for n in names])
    return row.select(*keep, F.inline(cells)).where("n > 0")


def alert_summary(df: DataFrame, cond: Column, office: str) -> DataFrame:
    """Alert rows per office with the overall count and number of offices."""
    per_office = _known(df.where(cond), office).groupBy(office).agg(F.count(F.lit(1)).alias("n"))
    return per_office.withColumns(
        {
            "total": per_office.agg(F.sum("n")).scalar(),
            "n_offices": per_office.agg(F.count(F.lit(1))).scalar(),
            "has_alert": F.col("n") > 0,
        }
    )


def active_units(df: DataFrame, unit: str, day: str, start, end, present: Column) -> DataFrame:
    """Distinct units and distinct operating days with a presence in the period."""
    rows = df.where(on_or_between(quoted(day), start, end) & present)
    return rows.agg(
        F.count_distinct(quoted(unit)).alias("active_units"), F.count_distinct(as_date(quoted(day))).alias("active_days")
    )
