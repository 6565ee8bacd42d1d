"""Incremental jobs over the event file (M)."""

from pyspark.sql import functions as F

from ..operators import aggregate, latest
from ..session import scratch_path
from ..streaming import jobs
from .registry import Tables, query

SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _arriving(t: Tables, folder: str | None = None, **options):
    if folder is None:
        return jobs.read_arriving(t.spark, t.folder, SCHEMA, pattern="events.parquet")
    return jobs.read_arriving(t.spark, folder, SCHEMA, **options)


@query(
    "m01_stream_time_buckets",
    """SELECT CAST(date_trunc('week', ts) AS DATE)::VARCHAR AS week_start, COUNT(*) AS n FROM events GROUP BY 1
       HAVING CAST(date_trunc('week', MIN(ts)) AS DATE) + 7 <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM events)""",
)
def m01(t: Tables):
    out, mark = scratch_path(t.spark, "weeks"), scratch_path(t.spark, "mark")
    jobs.stream_time_buckets(_arriving(t), "ts", out, mark)
    return t.spark.read.schema("week_start DATE, n BIGINT").parquet(out)


@query(
    "m01_batch_time_buckets",
    "SELECT CAST(date_trunc('week', ts) AS DATE)::VARCHAR AS week_start, COUNT(*) AS n FROM events GROUP BY 1",
)
def m01_batch(t: Tables):
    return aggregate.time_bucket_counts(t.events, "ts", "week").select(F.col("bucket").alias("week_start"), "n")


@query(
    "m01_stream_open_weeks",
    "SELECT CAST(date_trunc('week', ts) AS DATE)::VARCHAR AS bucket_start, COUNT(*) AS n FROM events GROUP BY 1",
)
def m01_open(t: Tables):
    folder = scratch_path(t.spark, "arriving")
    t.events.repartition(3, "event_id").write.parquet(folder)
    out, mark = scratch_path(t.spark, "weeks"), scratch_path(t.spark, "mark")
    jobs.stream_bucket_counts(_arriving(t, folder, files_per_batch=1), "ts", "week", out, mark)
    return jobs.read_bucket_counts(t.spark, out)


@query(
    "m02_stream_forms_once",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def m02_once(t: Tables):
    folder = scratch_path(t.spark, "arriving")
    # two batches, and then every form once more, a year later
    t.events.repartition(2, "event_id").write.parquet(folder)
    out, mark = scratch_path(t.spark, "forms"), scratch_path(t.spark, "mark")
    order = [F.col("ts")]
    jobs.stream_forms_once(_arriving(t, folder, files_per_batch=1), "event_id", order, out, mark, buckets=32)
    late = t.events.withColumn("ts", F.col("ts") + F.expr("interval 1 year"))
    late.coalesce(1).write.mode("append").parquet(folder)
    jobs.stream_forms_once(_arriving(t, folder), "event_id", order, out, mark, buckets=32)
    return jobs.read_forms_once(t.spark, out, SCHEMA).select("event_id", "user_id", "event_type", "value")


@query("m02_stream_dedupe_forms", "SELECT event_id, user_id, event_type, value FROM events")
def m02(t: Tables):
    folder = scratch_path(t.spark, "arriving")
    # the file is sent twice, and both copies arrive in the same batch
    for _ in range(2):
        t.events.write.mode("append").parquet(folder)
    out, mark = scratch_path(t.spark, "forms"), scratch_path(t.spark, "mark")
    jobs.stream_dedupe_forms(_arriving(t, folder), "event_id", "ts", out, mark, late="60 days")
    return t.spark.read.schema(SCHEMA).parquet(out).select("event_id", "user_id", "event_type", "value")


@query(
    "m03_stream_alerts",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'error' AND value > 50",
)
def m03(t: Tables):
    out, mark = scratch_path(t.spark, "alerts"), scratch_path(t.spark, "mark")
    jobs.stream_alerts(_arriving(t), (F.col("event_type") == "error") & (F.col("value") > 50), out, mark)
    return t.spark.read.schema(SCHEMA).parquet(f"{out}/batch=*").select("event_id", "user_id", "value")


def _newest():
    return [F.col("ts").desc(), F.col("event_id").desc()]


@query(
    "m04_stream_latest_per_key",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events) WHERE rn = 1""",
)
def m04(t: Tables):
    folder = scratch_path(t.spark, "arriving")
    # four files, read one per batch
    t.events.repartition(4, "event_id").write.parquet(folder)
    out, mark = scratch_path(t.spark, "newest"), scratch_path(t.spark, "mark")
    jobs.stream_latest_per_key(_arriving(t, folder, files_per_batch=1), "user_id", _newest(), out, mark)
    return jobs.read_latest_version(t.spark, out, SCHEMA).select("user_id", "event_id", "event_type", "value")


@query(
    "m04_batch_latest_per_key",
    """SELECT user_id, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def m04_batch(t: Tables):
    return latest.latest_per_key(t.events, "user_id", _newest()).select("user_id", "event_id")
