"""Dashboard and activity packs, and follow-up work lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import safe_pct
from ..functions.dates import PERIODS, period_bounds
from ..functions.nulls import as_date
from ..operators import aggregate, filters, latest, partials


def dashboard_pack(
    rows: DataFrame, *, day: str, office: str, agent: str, age_band: Column, start, end, top: int = 10, weight: str | None = None
) -> DataFrame:
    """The dashboard as one long table (block, label, n, measure).

    Trend against the period before, daily series without gaps, age shares,
    agents by activity, and rows and agents per office. The detail is read
    once: grouping sets give the counts of every block, and the blocks are
    built from them; Spark reuses their exchange. Building starts no job.
    ``rows`` may be ``daily_activity``, whose column ``weight`` counts the rows.
    """
    lo, hi = as_date(start), as_date(end)
    before = F.date_sub(lo, F.datediff(hi, lo) + 1)
    both = rows.where(filters.on_or_between(day, before, hi)).select(
        as_date(F.col(day)).alias("day"),
        F.col(office).cast("string").alias("office"),
        F.col(agent).alias("agent"),
        age_band.alias("band"),
        (F.lit(1) if weight is None else F.col(weight)).alias("rows"),
    )
    both = both.withColumn("now", F.col("day") >= lo)
    sets = [[F.col(c) for c in cols] for cols in (["now"], ["now", "day"], ["now", "band"], ["now", "office", "agent"])]
    counts = both.groupingSets(sets, "now", "day", "band", "office", "agent").agg(
        F.grouping_id().alias("set"), F.sum("rows").alias("n")
    )
    # one bit per column that a set leaves out, in the order now day band office agent
    overall = counts.where("set = 15")
    days, bands, pairs = (counts.where(f"set = {s} and now") for s in (7, 11, 12))

    def block(name: str, df: DataFrame, label: Column, n: Column, measure: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("block"),
            label.cast("string").alias("label"),
            n.cast("long").alias("n"),
            measure.cast("double").alias("measure"),
        )

    none = F.lit(None)
    trend = overall.agg(
        F.coalesce(F.sum(F.when(F.col("now"), F.col("n"))), F.lit(0)).alias("c"),
        F.coalesce(F.sum(F.when(~F.col("now"), F.col("n"))), F.lit(0)).alias("p"),
    )
    change = F.when(F.col("p") > 0, F.bround((F.col("c") - F.col("p")) * 100.0 / F.col("p"), 2)).otherwise(F.lit(0.0))
    shares = aggregate.with_total(bands.where("band is not null"), "n", "t")
    agents = pairs.where("agent is not null").groupBy("agent").agg(F.sum("n").alias("n"))
    offices = pairs.where("office is not null").groupBy("office").agg(F.sum("n").alias("n"), F.count("agent").alias("agents"))
    return latest.union_all(
        block("trend", trend, F.lit("current"), F.col("c"), change),
        block("daily", aggregate.fill_buckets(days.select(F.col("day").alias("bucket"), "n"), "day"), F.col("bucket"), F.col("n"), none),
        block("ages", shares, F.col("band"), F.col("n"), safe_pct(F.col("n"), F.col("t"))),
        block("agents", agents.orderBy(F.col("n").desc(), "agent").limit(top), F.col("agent"), F.col("n"), none),
        block("offices", offices, F.col("office"), F.col("n"), F.col("agents")),
    )


def daily_activity(rows: DataFrame, *, day: str, office: str, agent: str, age_band: Column) -> DataFrame:
    """(day, office, agent, band, n): what the dashboard of any period needs of the detail."""
    keys = [as_date(F.col(day)).alias("day"), F.col(office).alias("office"), F.col(agent).alias("agent"), age_band.alias("band")]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def activity_from_partials(daily: DataFrame, as_of, indicators: Sequence[str], periods: Sequence[str] = PERIODS) -> DataFrame:
    """``activity_pack`` from daily partials alone; their bitmaps give distinct people of any period."""
    spans = {p: None if p == "all" else period_bounds(p, as_of) for p in periods}
    found = partials.period_measures(daily, spans)
    return found.where(F.col("measure").isin(*indicators) & (F.col("n") > 0)).select("period", F.col("measure").alias("indicator"), "n")


def activity_pack(
    rows: DataFrame,
    day: str,
    as_of,
    indicators: Mapping[str, Column],
    periods: Sequence[str] = PERIODS,
) -> DataFrame:
    """The same indicators for several periods as (period, indicator, n).

    The table is read once; each row is repeated for the periods it lies in,
    which are at most as many as there are periods. "all" has no bounds: it
    holds every row, also one without a date. Zero rows are left out.
    """
    bounds = {p: period_bounds(p, as_of) for p in periods if p != "all"}
    d = as_date(F.col(day))
    inside = [F.when(d.between(lo, hi), F.lit(p)) for p, (lo, hi) in bounds.items()]
    marks = F.array_compact(F.array(*inside, *[F.lit(p) for p in periods if p == "all"]))
    dated = rows.where(F.size(marks) > 0).withColumn("period", F.explode(marks))
    wide = dated.groupBy("period").agg(*[c.alias(n) for n, c in indicators.items()])
    return aggregate.indicator_rows(wide, list(indicators), ["period"])


def action_lists(rows: DataFrame, key: str, office: str, sort_date: str, lists: Mapping[str, Column]) -> DataFrame:
    """Work lists as one long table: a person appears once per list it is on."""
    marks = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in lists.items()]))
    return rows.select(
        F.explode(marks).alias("list"), F.col(key).alias("key"), F.col(office).alias("office"), F.col(sort_date).alias("sort_date")
    )


def action_list_counts(lists: DataFrame) -> DataFrame:
    """People per list and office with the share of the list."""
    counts = lists.groupBy("list", "office").agg(F.count(F.lit(1)).alias("n"))
    total = aggregate.with_total(counts, "n", "_t", ["list"])
    return total.withColumn("pct", safe_pct(F.col("n"), F.col("_t"))).drop("_t")
