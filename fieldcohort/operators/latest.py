"""One or a few rows per key, ordering, and set operations.

Rankings are filtered right away (``row_number <= n``), so Spark cuts every
key to n rows before the shuffle: a key that holds a third of all rows sends
only n rows per input partition. Group statistics on detail rows are grouped
first and joined back, never computed in a window over the whole key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .clean import quoted


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def top_n_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """First n rows of each key; ``order`` must decide every tie."""
    keys = [quoted(k) for k in _keys(key)]
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``."""
    return top_n_per_key(df, key, order, 1, "_rn").drop("_rn")


def dedupe_keep(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], keep: str = "first"
) -> DataFrame:
    """First or last row of each key in the order of the named columns."""
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    cols = [quoted(c).asc_nulls_last() if keep == "first" else quoted(c).desc_nulls_first() for c in order]
    return latest_per_key(df, key, cols)


one_row_per_key = latest_per_key
distinct_keep_all = dedupe_keep


def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return latest_per_key(df, key, order)


HOT_KEYS = 1000


def join_group_rows(df: DataFrame, groups: DataFrame, key: str | Sequence[str], size: str) -> DataFrame:
    """Left join one row per group to its detail rows, whatever the group sizes.

    ``size`` is the number of detail rows of a group. Groups over a thousandth
    of all rows are at most a thousand, so they are broadcast. Their detail
    rows skip the other join: a salt spreads them over its partitions, where
    they meet nothing. The salt is a hash of the row's short columns, so it is
    the same when a task runs again. A missing key gets nulls. The groups are
    written to the shared folder, so they are computed once.
    """
    keys = _keys(key)
    groups = cut_lineage(groups, "groups")
    cols = [c for c in groups.columns if c not in keys and c != size]
    limit = F.lit(groups.agg(F.sum(size) / HOT_KEYS).first()[0] or 0.0)
    large = groups.where(F.col(size) > limit).select(*keys, *[quoted(c).alias(f"_hot_{c}") for c in cols], F.lit(True).alias("_hot"))
    small = groups.where(F.col(size) <= limit).select(*keys, *cols, F.lit(0).cast("long").alias("_salt"))
    short = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StringType)] or df.columns
    place = F.pmod(F.xxhash64(*[quoted(c) for c in short], F.spark_partition_id()), F.lit(1 << 20)) + 1
    marked = df.join(F.broadcast(large), keys, "left").withColumn("_salt", F.when(F.col("_hot"), place).otherwise(F.lit(0)))
    both = marked.join(small, [*keys, "_salt"], "left")
    return both.select(
        *[quoted(c) for c in df.columns],
        *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(quoted(c)).alias(c) for c in cols],
    )


def with_key_stats(df: DataFrame, key: str | Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Repeat group statistics on every row of the group.

    A grouped pass, combined before its shuffle, and a join that no frequent
    key can pile up in one task; no window over a whole group.
    """
    keys = _keys(key)
    groups = df.groupBy(*[quoted(k) for k in keys]).agg(
        *[c.alias(n) for n, c in stats.items()], F.count(F.lit(1)).alias("_size")
    )
    return join_group_rows(df, groups, keys, "_size")


def count_over_key(df: DataFrame, key: str | Sequence[str], out: str) -> DataFrame:
    return with_key_stats(df, key, {out: F.count(F.lit(1))})


def first_last_at_levels(
    detail: DataFrame, rows: DataFrame, day: str, levels: Sequence[tuple[Sequence[str], Mapping[str, str]]]
) -> DataFrame:
    """First and last dates of several groupings on each detail row.

    A level is (keys, {column: "first" or "last"}). ``rows`` is what the dates
    are taken from and may hold more than ``detail``. It is grouped once by all
    keys together; the levels are grouped from that result.
    """
    keys = list(dict.fromkeys(k for names, _ in levels for k in names))
    finest = rows.groupBy(*[quoted(k) for k in keys]).agg(
        F.min(quoted(day)).alias("_first"), F.max(quoted(day)).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    for names, columns in levels:
        stats = {n: F.min("_first") if end == "first" else F.max("_last") for n, end in columns.items()}
        groups = finest.groupBy(*names).agg(*[c.alias(n) for n, c in stats.items()], F.sum("_n").alias("_size"))
        detail = join_group_rows(detail, groups, names, "_size")
    return detail


def latest_and_previous(
    df: DataFrame, key: str, order: Sequence[Column], cols: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Newest and second newest row of each key side by side.

    Unqualified rows are dropped first, so they cannot hide a person.
    """
    picked = df if where is None else df.where(where)
    two = top_n_per_key(picked, key, order, 2, "_rn")
    return two.groupBy(key).agg(
        *[F.max(F.when(F.col("_rn") == 1, F.col(c))).alias(f"last_{c}") for c in cols],
        *[F.max(F.when(F.col("_rn") == 2, F.col(c))).alias(f"previous_{c}") for c in cols],
    )


def last_n_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """The newest n buckets of a bucketed series, oldest first."""
    return df.orderBy(F.col(period).desc()).limit(n).orderBy(period)


def sort_multi(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def limit_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


# Calendar order of names.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def sort_by_calendar(df: DataFrame, name_col: str, names: Sequence[str] = MONTHS) -> DataFrame:
    """Order by place in the calendar instead of by text."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), quoted(name_col))
    return df.orderBy(F.nullif(place, F.lit(0)).asc_nulls_last())


def top_k_by_count(df: DataFrame, key: str, k: int, count_name: str = "n") -> DataFrame:
    """The k most frequent keys; ties go to the smaller key."""
    counts = df.where(quoted(key).isNotNull()).groupBy(quoted(key).alias(key)).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.col(count_name).desc(), F.col(key)).limit(k)


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def union_by_name(*parts: DataFrame) -> DataFrame:
    """Stack tables with different columns; what is missing becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_distinct(*parts: DataFrame) -> DataFrame:
    """Distinct rows of all parts, each made distinct before the shuffle."""
    return union_all(*parts).distinct()


def set_difference_ids(df: DataFrame, key: str, *excluded: DataFrame) -> DataFrame:
    """Ids of ``df`` that are in none of the other tables."""
    ids = df.select(key).distinct()
    return ids.join(union_all(*[e.select(key) for e in excluded]), key, "left_anti")


def append_newer_than(base: DataFrame, full: DataFrame, day: str) -> DataFrame:
    """Base rows plus the rows created after the newest base row."""
    newest = base.agg(F.max(quoted(day))).scalar()
    return base.unionByName(full.where(quoted(day) > newest).select(*base.columns))
