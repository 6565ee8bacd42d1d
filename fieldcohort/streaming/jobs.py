"""Incremental forms of batch steps over arriving files.

Every job reads new files of a folder, keeps its progress in a checkpoint
folder and ends when all files that are there have been read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregate import time_bucket_counts
from ..operators.latest import latest_per_key
from .buckets import first_of_each_key, read_first_rows, read_state, spread, upsert


def read_arriving(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def stream_time_buckets(rows: DataFrame, ts: str, out: str, checkpoint: str, late: str = "1 day") -> None:
    """Weekly counts, Monday to Sunday, written once a week is complete.

    The epoch was a Thursday, so weeks start four days after it. Windows are
    cut in UTC; times are moved to the wall clock of the session before and
    back after. A week is complete when its end lies ``late`` before the
    newest time seen.
    """
    zone = rows.sparkSession.conf.get("spark.sql.session.timeZone")
    weeks = (
        rows.withColumn("_wall", F.from_utc_timestamp(ts, zone))
        .withWatermark("_wall", late)
        .groupBy(F.window("_wall", "7 days", startTime="4 days"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_utc_timestamp("window.start", zone).cast("date").alias("week_start"), "n")
    )
    _finish(
        weeks.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def stream_dedupe_forms(rows: DataFrame, key: str, ts: str, out: str, checkpoint: str, late: str = "7 days") -> None:
    """Drop forms that were sent again within the lateness limit."""
    unique = rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    _finish(
        unique.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def stream_alerts(rows: DataFrame, cond: Column, out: str, checkpoint: str) -> None:
    """Write alert rows, one folder per batch, so a repeated batch replaces itself."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    _finish(
        rows.where(cond)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _per_batch(rows: DataFrame, checkpoint: str, save) -> None:
    _finish(rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_latest_per_key(rows: DataFrame, key: str, order: Sequence[Column], out: str, checkpoint: str, buckets: int = 16) -> None:
    """Keep the newest row per key as a state in buckets by the hash of the key.

    A repeated batch starts from the pointer before it and changes nothing twice.
    """
    _per_batch(rows, checkpoint, lambda batch, number: upsert(batch, number, out, key, lambda df: latest_per_key(spread(df, key), key, order), buckets))


def read_latest_version(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest row of each key after the last batch."""
    return read_state(spark, path, schema)


def stream_bucket_counts(rows: DataFrame, ts: str, unit: str, out: str, checkpoint: str) -> None:
    """Counts per time bucket, the open ones too, as up to date as the last batch.

    Each batch adds its counts to the buckets of the state it touches, so the
    result equals the batch form after every run, whatever comes late.
    """

    def add(df: DataFrame) -> DataFrame:
        return df.groupBy("bucket_start").agg(F.sum("n").alias("n"))

    def save(batch: DataFrame, number: int) -> None:
        upsert(time_bucket_counts(batch, ts, unit).withColumnRenamed("bucket", "bucket_start"), number, out, "bucket_start", add, buckets=4)

    _per_batch(rows, checkpoint, save)


def read_bucket_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_state(spark, path, "bucket_start DATE, n BIGINT")


def stream_forms_once(rows: DataFrame, key: str, order: Sequence[Column], out: str, checkpoint: str, buckets: int = 256) -> None:
    """Each form once, however late it is sent again; the first in ``order`` of a batch stays."""
    _per_batch(rows, checkpoint, lambda batch, number: first_of_each_key(batch, number, out, key, order, buckets))


def read_forms_once(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_first_rows(spark, path, schema)
