"""Daily summaries that answer any period without reading the detail again.

Counts are kept per day. Distinct people or units are kept as exact bitmaps: an
id is one bit, and the bits of a day lie in rows of 32,768 ids, so a day's size
is bounded by the range of the ids and not by its rows. Periods add up the
counts and join the bitmaps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import as_date
from .clean import quoted

SCHEMA = "day DATE, by STRING, measure STRING, n BIGINT, bucket BIGINT, bits BINARY"


def daily_partials(
    df: DataFrame, day: str, counts: Mapping[str, Column], distinct: Mapping[str, tuple[Column, Column | None]], by: Column | None = None
) -> DataFrame:
    """(day, by, measure, n, bucket, bits): the summary of the detail, from one pass.

    ``counts`` are conditions (true rows are counted), ``distinct`` pairs of a
    whole number and a condition or None. Rows without a date have the day null.
    Both are combined before their shuffle. A missing id is not counted.
    """
    key = F.lit(None).cast("string") if by is None else by.cast("string")
    rows = df.select(
        as_date(quoted(day)).alias("day"),
        key.alias("by"),
        *[c.alias(f"c_{n}") for n, c in counts.items()],
        *[(v if cond is None else F.when(cond, v)).cast("long").alias(f"d_{n}") for n, (v, cond) in distinct.items()],
    )
    marks = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(f"d_{n}").alias("id")) for n in distinct])
    parts = []
    if counts:
        summed = rows.groupBy("day", "by").agg(*[F.count_if(F.col(f"c_{n}")).alias(n) for n in counts])
        cells = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("n")) for n in counts])
        parts.append(summed.select("day", "by", F.inline(cells)).selectExpr("day", "by", "measure", "n", "cast(null as bigint) bucket", "cast(null as binary) bits"))
    if distinct:
        ids = rows.select("day", "by", F.inline(marks)).where("id is not null")
        grouped = ids.groupBy("day", "by", "measure", F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
        parts.append(grouped.selectExpr("day", "by", "measure", "cast(null as bigint) n", "bucket", "bits"))
    return reduce(DataFrame.unionByName, parts)


def write_partials(partials: DataFrame, path: str) -> None:
    partials.write.mode("overwrite").parquet(path)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def period_measures(partials: DataFrame, periods: Mapping[str, tuple | None], keep: Sequence[str] = ()) -> DataFrame:
    """(period, keep, measure, n) from the summary alone.

    A period is (first day, last day), both inside, or None for everything,
    days that are missing too. ``keep`` may hold ``by``. Bitmaps of a period are
    joined per row of ids, so no task holds all ids of a period.
    """
    inside = [F.lit(p) if span is None else F.when(F.col("day").between(as_date(span[0]), as_date(span[1])), F.lit(p)) for p, span in periods.items()]
    rows = partials.withColumn("period", F.explode(F.array_compact(F.array(*inside))))
    pieces = rows.groupBy("period", *keep, "measure", "bucket").agg(F.sum("n").alias("n"), F.bitmap_or_agg(F.coalesce("bits", F.lit(b""))).alias("bits"))
    held = F.when(F.col("bucket").isNull(), F.col("n")).otherwise(F.bitmap_count("bits"))
    return pieces.groupBy("period", *keep, "measure").agg(F.sum(held).alias("n"))


def active_days(partials: DataFrame, measure: str, start, end) -> DataFrame:
    """Distinct units and distinct days with one in a period, from the summary."""
    rows = partials.where((F.col("measure") == measure) & F.col("day").between(as_date(start), as_date(end)))
    pieces = rows.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.collect_set("day").alias("days"))
    days = F.array_size(F.array_distinct(F.flatten(F.collect_list("days")))).cast("long")
    return pieces.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("active_units"), days.alias("active_days"))
