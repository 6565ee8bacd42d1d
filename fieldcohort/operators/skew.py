"""Joins whose frequent keys are cut, on both sides, into a grid of tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .clean import quoted

#: Rows of one side that a task may hold of one key, if the key has no more than a thousandth of all rows.
PART_ROWS = 20_000
HOT_KEYS = 1000


def frequent_keys(df: DataFrame, keys: Sequence[str], parts: str) -> DataFrame:
    """(keys, parts): in how many parts a frequent key's rows are cut.

    Rows are counted with map-side combine. A key is frequent with over
    ``PART_ROWS`` rows and over a thousandth of all, so there are at most a
    thousand of them. Missing keys meet nothing and are left out.
    """
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")).dropna(subset=list(keys))
    counts = cut_lineage(counts.where(F.col("_n") > PART_ROWS), "frequent")
    total = df.count() if not counts.isEmpty() else 0
    cell = max(PART_ROWS, total // HOT_KEYS)
    return counts.where(F.col("_n") > cell).select(*keys, F.ceil(F.col("_n") / cell).cast("int").alias(parts))


def grid_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join on equal keys, however many rows a key has on either side.

    The left rows of a frequent key are dealt to the rows of a grid, the right
    ones to its columns, and each is sent to every cell of its row or column:
    each pair meets once, and no task holds more than a part of either side.
    A part follows from a row's short columns and its partition, so it is the
    same when a task runs again. Both sides must have different other columns.
    """
    keys = [on] if isinstance(on, str) else list(on)
    across, down = (frequent_keys(df, keys, part) for df, part in ((left, "_rows"), (right, "_columns")))

    def dealt(df: DataFrame, mine: str, other: str, own: str, every: str) -> DataFrame:
        short = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.StringType, T.MapType))] or df.columns
        place = F.xxhash64(*[quoted(c) for c in short], F.spark_partition_id())
        marked = df.join(F.broadcast(across), keys, "left").join(F.broadcast(down), keys, "left")
        cells = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
        return marked.select(*[quoted(c) for c in df.columns], F.pmod(place, F.coalesce(mine, F.lit(1))).cast("int").alias(own), F.explode(cells).alias(every))

    sent = dealt(left, "_rows", "_columns", "_i", "_j"), dealt(right, "_columns", "_rows", "_j", "_i")
    return sent[0].join(sent[1], [*keys, "_i", "_j"]).drop("_i", "_j")
