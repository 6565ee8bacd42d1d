"""Joins between people, episodes, events and lookups.

No broadcast hints: lookups stay small in practice, but their size is not
known here, so the choice is left to the optimizer, which broadcasts only a
side whose measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
splits skewed partitions of the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import due_date, episode_start
from ..functions.nulls import as_date, yes_no
from ..functions.text import decode
from ..session import cut_lineage
from .clean import quoted, select_existing
from .latest import latest_per_key
from .skew import frequent_keys, grid_join

MATCH = {"both": "yes", "left_only": "no"}


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def left_lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Add the lookup columns that exist; rows without a match keep nulls."""
    keys = _keys(on)
    return df.join(select_existing(dim, [*keys, *[c for c in cols if c not in keys]]), keys, "left")


def equi_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Join on one shared key; with ``null_safe`` two missing keys match."""
    if not null_safe:
        return left.join(right, on, how)
    other = right.withColumnRenamed(on, "_right_key")
    return left.join(other, left[on].eqNullSafe(other["_right_key"]), how).drop("_right_key")


def match_flag_join(
    df: DataFrame,
    other: DataFrame,
    on: str | Sequence[str],
    out: str,
    mapping: Mapping[str, str] = MATCH,
    dedupe_right: Sequence[Column] | None = None,
) -> DataFrame:
    """Left join plus a column that tells whether the key was found.

    Repeated right keys repeat the row, unless ``dedupe_right`` gives an order
    by which one right row per key is kept.
    """
    keys = _keys(on)
    if dedupe_right is not None:
        other = latest_per_key(other, keys, dedupe_right)
    marked = other.withColumn("_found", F.lit(True))
    flag = F.when(F.col("_found"), F.lit(mapping["both"])).otherwise(F.lit(mapping["left_only"]))
    return df.join(marked, keys, "left").withColumn(out, flag).drop("_found")


def exists_flag(df: DataFrame, other: DataFrame, on: str | Sequence[str], out: str, mapping=MATCH) -> DataFrame:
    """Only the flag: the other side is reduced to its distinct keys."""
    keys = _keys(on)
    return match_flag_join(df, other.select(*keys).distinct(), keys, out, mapping)


def inner_chain(first: DataFrame, *steps: tuple[DataFrame, Column | str | list]) -> DataFrame:
    return reduce(lambda left, step: left.join(step[0], step[1], "inner"), steps, first)


def left_star(fact: DataFrame, *dims: tuple[DataFrame, Column | str | list]) -> DataFrame:
    return reduce(lambda left, step: left.join(step[0], step[1], "left"), dims, fact)


def anti_join(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in the other table; a missing key is kept."""
    keys = _keys(on)
    return df.join(other.select(*keys), keys, "left_anti")


def semi_join(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    keys = _keys(on)
    return df.join(other.select(*keys), keys, "left_semi")


def membership_ignore_case(df: DataFrame, other: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows whose key is (not) in the other table in any case; key comes out upper."""
    left = df.withColumn("_k", F.lower(quoted(key)))
    right = other.select(F.lower(quoted(key)).alias("_k"))
    hit = left.join(right, "_k", "left_semi" if keep else "left_anti")
    return hit.drop("_k").withColumn(key, F.upper(quoted(key)))


def interval_join(
    episodes: DataFrame,
    events: DataFrame,
    key: str,
    event_date: str,
    *,
    start: Column | None = None,
    due: Column | None = None,
    windows: Sequence[tuple[Column, Column]] | None = None,
    how: str = "left",
) -> DataFrame:
    """Events of the same person inside the episode.

    By default a date counts when it lies within nine months and a week after
    the start, or before the due date. The person is an equality key, so the
    window is only a residual test. People with very many events or episodes are
    joined by person and date bin instead (``binned_join``). Where only totals are
    wanted, ``daily_totals`` of the events make fewer pairs.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    day = as_date(quoted(event_date))
    if windows is None:
        windows = [(as_date(start), due_date(start)), (episode_start(due), as_date(due))]
    names = [f"_{side}{i}" for i in range(len(windows)) for side in ("lo", "hi")]
    bounded = episodes.withColumns(dict(zip(names, [c for pair in windows for c in pair])))
    spans = [(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in range(len(windows))]
    inside = reduce(or_, [F.col("_day").between(lo, hi) for lo, hi in spans])
    dated = events.withColumn("_day", day)
    often = frequent_keys(events, [key], "_often").select(key).unionByName(frequent_keys(episodes, [key], "_often").select(key)).distinct()
    if often.isEmpty():
        met = bounded.join(dated, (bounded[key] == dated[key]) & inside, how).drop(dated[key])
        return met.drop(*names, "_day")
    mark = F.broadcast(often.withColumn("_often", F.lit(True)))
    sides = [df.join(mark, key, "left") for df in (bounded, dated)]
    usual, frequent = ([df.where(F.col("_often").isNull() == rare).drop("_often") for df in sides] for rare in (True, False))
    met = usual[0].join(usual[1], (usual[0][key] == usual[1][key]) & inside, how).drop(usual[1][key])
    return met.unionByName(binned_join(*frequent, key, spans, inside, how)).drop(*names, "_day")


def daily_totals(events: DataFrame, key: str, event_date: str, **totals: Column) -> DataFrame:
    """(key, day, totals): one row per person and day, combined before the shuffle.

    A window of whole days holds all events of a day or none, so sums and counts
    over an episode are sums over its days. A person's days are bounded where
    the events are not, and so are the pairs that ``interval_join`` makes of them.
    """
    return events.groupBy(quoted(key), as_date(quoted(event_date)).alias("day")).agg(*[c.alias(n) for n, c in totals.items()])


#: Days of a date bin.
BIN_DAYS = 32


def binned_join(
    episodes: DataFrame, events: DataFrame, key: str, spans: Sequence[tuple[Column, Column]], inside: Column, how: str
) -> DataFrame:
    """Join by key and date bin: an event lies in the bin of ``_day``, an episode in every bin its spans touch.

    The bins of an episode are distinct and an event has one, so a pair meets
    once. Bins with many rows are cut in a grid of tasks.
    """
    place = lambda c: F.floor(F.unix_date(c) / BIN_DAYS)
    of_span = lambda lo, hi: F.when(lo <= hi, F.sequence(place(lo), place(hi))).otherwise(F.array().cast("array<bigint>"))
    bins = F.array_distinct(F.concat(*[F.coalesce(of_span(lo, hi), F.array().cast("array<bigint>")) for lo, hi in spans]))
    numbered = cut_lineage(episodes.withColumn("_episode", F.monotonically_increasing_id()), "episodes")
    sent = numbered.withColumn("_bin", F.explode(bins))
    held = events.where("_day is not null").withColumn("_bin", place(F.col("_day")))
    met = grid_join(sent, held, [key, "_bin"]).where(inside).drop("_bin")
    if how == "left":
        alone = numbered.join(met.select("_episode").distinct(), "_episode", "left_anti")
        met = met.unionByName(alone, allowMissingColumns=True)
    return met.drop("_episode")


def expr_key_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "left") -> DataFrame:
    """Equality join on keys built by expressions; an inner one cuts keys that are frequent on both sides in a grid."""
    a = left.withColumn("_join_key", left_key)
    b = right.withColumn("_join_key", right_key)
    if how == "inner":
        return grid_join(a, b, "_join_key").drop("_join_key")
    return a.join(b, "_join_key", how).drop("_join_key")


def pair_counts(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, key: str, out: str) -> DataFrame:
    """How many pairs each key would make: both sides are counted first, and only the counts meet."""
    a = left.groupBy(left_key.alias(key)).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(right_key.alias(key)).agg(F.count(F.lit(1)).alias("_b"))
    return a.join(b, key).select(key, (F.col("_a") * F.col("_b")).alias(out))


def groupwise_latest_join(
    df: DataFrame, events: DataFrame, key: str, order: Sequence[Column], how: str = "left"
) -> DataFrame:
    """Join each key with its newest event."""
    return df.join(latest_per_key(events, key, order), key, how)


def correlated_extreme(
    df: DataFrame, events: DataFrame, key: str, value: Column, out: str, where: Column | None = None, func=F.max
) -> DataFrame:
    """Largest (or smallest) qualifying value of each key, as one grouped pass."""
    picked = events if where is None else events.where(where)
    return df.join(picked.groupBy(key).agg(func(value).alias(out)), key, "left")


def presence_matrix(
    base: DataFrame | None,
    key: str,
    sources: Mapping[str, tuple[DataFrame, str, Column | None]],
    periods: Mapping[str, tuple[object, object]],
) -> DataFrame:
    """yes/no per (source, period) and one any-source flag per period.

    A source is (table, date column, row condition or None). All sources are
    stacked with a tag and grouped once; several sources on one table are read
    in one pass. The wide row is then left joined to the population; without
    one, everybody a source saw in a period is listed.
    """
    shared: dict[tuple[int, str], list[str]] = {}
    for name, (src, day, _) in sources.items():
        shared.setdefault((id(src), day), []).append(name)
    tagged = []
    for (_, day), names in shared.items():
        marks = [F.lit(n) if sources[n][2] is None else F.when(sources[n][2], F.lit(n)) for n in names]
        src = sources[names[0]][0]
        tag = marks[0] if len(marks) == 1 else F.explode(F.array_compact(F.array(*marks)))
        rows = src.select(F.col(key), tag.alias("_source"), as_date(F.col(day)).alias("_day"))
        tagged.append(rows.where(F.col("_source").isNotNull()))
    stacked = reduce(DataFrame.unionByName, tagged)
    inside = {p: F.col("_day").between(as_date(lo), as_date(hi)) for p, (lo, hi) in periods.items()}
    stacked = stacked.where(reduce(or_, inside.values()))
    cells = {
        f"{s}_{p}": F.max(F.when((F.col("_source") == s) & hit, True)) for s in sources for p, hit in inside.items()
    }
    cells |= {f"any_{p}": F.max(F.when(hit, True)) for p, hit in inside.items()}
    wide = stacked.groupBy(key).agg(*[c.alias(n) for n, c in cells.items()])
    rows = wide.where(F.col(key).isNotNull()) if base is None else base.join(wide, key, "left")
    return rows.withColumns({n: yes_no(F.col(n)) for n in cells})


def latest_then_flag(
    base: DataFrame,
    events: DataFrame,
    key: str,
    *,
    positive: Column,
    event_date: str,
    order: Sequence[Column],
    since: Column,
    found: str,
    during: str,
) -> DataFrame:
    """Newest positive event per key, whether there is one, and whether it
    lies on or after the episode start."""
    newest = events.where(positive)
    out = match_flag_join(base, newest, key, found, dedupe_right=order)
    return out.withColumn(during, yes_no(as_date(F.col(event_date)) >= as_date(since)))


def status_partition(
    df: DataFrame, key: str, classes: Sequence[tuple[str, DataFrame]], rest: str, out: str = "status"
) -> DataFrame:
    """Place each row in the first class that holds its key, else in ``rest``.

    The classes are stacked with their rank and reduced to the lowest rank per
    key, so one join gives a complete split without overlap.
    """
    tagged = [d.select(F.col(key), F.lit(i).alias("_rank")) for i, (_, d) in enumerate(classes)]
    ranks = reduce(DataFrame.unionByName, tagged).groupBy(key).agg(F.min("_rank").alias("_rank"))
    label = decode("_rank", {i: name for i, (name, _) in enumerate(classes)}, rest)
    return df.join(ranks, key, "left").withColumn(out, label).drop("_rank")


def canonical_id(linked: str, own: str) -> Column:
    """The linked person when one is recorded, else the person itself."""
    return F.when(F.col(linked) > 0, F.col(linked)).otherwise(F.col(own))


def disjoint_by_key(df: DataFrame, key: str, start, end, out: str = "part") -> DataFrame:
    """Yearly cohort, told apart from the people whose only deliveries are too old.

    Columns: dpa, ddr, delivery_date, added_at. Selected rows have a due date
    from ``start`` on, or none and were added in the period. People are taken
    out when every selected row has a delivery over two years before
    ``start``; of the others, a delivery over three months before it needs an
    episode date. ``out`` is "kept", or "old" for the rows of the people taken out.
    """
    lo, hi = as_date(start), as_date(end)
    chosen = df.where((F.col("dpa") >= lo) | (F.col("dpa").isNull() & F.col("added_at").between(lo, hi)))
    recent = F.col("delivery_date").isNull() | (F.col("delivery_date") >= F.add_months(lo, -24))
    flags = chosen.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(recent).alias("_recent"))
    flagged = chosen.join(flags, key, "left").withColumn("_out", ~F.coalesce("_recent", F.lit(False)))
    valid = F.coalesce(F.col("delivery_date") > F.add_months(lo, -3), F.lit(False)) | F.col("dpa").isNotNull() | F.col("ddr").isNotNull()
    old = F.col("_out") & F.col("delivery_date").isNotNull()
    kept = (~F.col("_out") | F.col(key).isNull()) & valid
    return flagged.withColumn(out, F.when(kept, "kept").when(old, "old")).where(F.col(out).isNotNull()).drop("_recent", "_out")
