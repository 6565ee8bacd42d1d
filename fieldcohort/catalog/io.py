"""Readers and writers (A)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, scratch_path
from ..sources import tables as io
from .registry import AS_OF, Tables, query


@query("a01_load_table", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def a01(t: Tables):
    return io.load_table(t.spark, f"{t.folder}/customer.parquet", ["c_custkey", "c_name", "c_nationkey"])


@query("a02_load_latest_dated", "SELECT c_custkey, c_acctbal, '2001-11-20' AS export_date FROM customer")
def a02(t: Tables):
    folder = scratch_path(t.spark, "exports")
    for day in ("2001-10-05", "2001-11-20", "2002-01-03"):
        rows = t.customer.select("c_custkey", "c_acctbal", F.lit(day).alias("export_date"))
        io.write_table(rows, f"{folder}/customer list {day}.parquet")
    return io.load_latest_dated(t.spark, folder, "customer list", AS_OF)


@query(
    "a03_run_report_sql",
    """SELECT o_orderstatus, COUNT(*) AS n_orders FROM orders
       WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01' GROUP BY 1""",
)
def a03(t: Tables):
    text = """
        SELECT o_orderstatus, count(*) AS n_orders FROM {orders}
        WHERE o_orderdate >= cast(:start_date AS date) AND o_orderdate < date_add(cast(:end_date AS date), 1)
        GROUP BY o_orderstatus
    """
    return io.run_report_sql(
        t.spark, text, {"start_date": "1997-01-01", "end_date": "1997-12-31"}, orders=t.orders
    )


FEED_RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query("a04_read_paged_json", "SELECT event_id, user_id, event_type, value FROM events")
def a04(t: Tables):
    folder = scratch_path(t.spark, "feed")
    size, overlap = 2000, 2
    record = F.struct(*FEED_RECORD.fieldNames())
    place = F.pmod("event_id", F.lit(size))
    first = F.floor(F.col("event_id") / size)
    # the last records of a page are sent again at the top of the next one
    pages = F.when(place >= size - overlap, F.array(first, first + 1)).otherwise(F.array(first))
    feed = (
        t.events.select(record.alias("r"), F.explode(pages).alias("page"))
        .groupBy("page")
        .agg(F.collect_list("r").alias("value"))
        .select("value", F.concat(F.lit("feed?page="), F.col("page") + 1).alias("@odata.nextLink"))
    )
    feed.write.option("maxRecordsPerFile", 1).json(folder)
    return io.read_paged_json(t.spark, folder, FEED_RECORD, "event_id", ["user_id", "event_type", "value"])


@query("a04_read_new_pages", "SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 3 < 2 THEN 1 ELSE 2 END AS run FROM events")
def a04_new(t: Tables):
    # two thirds of the events land in pages first, the rest later; the second run opens only its own pages
    folder, ledger = scratch_path(t.spark, "feed"), scratch_path(t.spark, "ledger")
    run = F.when(F.col("event_id") % 3 < 2, 1).otherwise(2)
    number = F.floor(F.col("event_id") / 6000)
    page = lambda run, k: F.concat_ws("-", run.cast("string"), k.cast("string"))
    events = t.events.select(run.alias("run"), number.alias("k"), F.struct(*FEED_RECORD.fieldNames()).alias("r"))
    pages = events.groupBy("run", "k").agg(F.collect_list("r").alias("value"))
    last = t.events.agg(F.max(number)).first()[0]
    ends = F.col("k") == last
    feed = pages.select(
        "run",
        page(F.col("run"), F.col("k")).alias("link"),
        "value",
        F.when(~ends, page(F.col("run"), F.col("k") + 1)).alias("@odata.nextLink"),
        F.when(ends, page(F.col("run") + 1, F.lit(0))).alias("@odata.deltaLink"),
    )
    runs = []
    for part in (1, 2):
        feed.where(F.col("run") == part).drop("run").write.mode("append").option("maxRecordsPerFile", 1).json(folder)
        rows = io.read_new_pages(t.spark, folder, FEED_RECORD, "event_id", ["user_id", "event_type", "value"], "1-0", ledger)
        runs.append(cut_lineage(rows.withColumn("run", F.lit(part)), "records"))
    return runs[0].unionByName(runs[1])


@query("a05_csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a05(t: Tables):
    path = scratch_path(t.spark, "csv")
    io.write_csv(t.customer, path)
    return io.read_csv(t.spark, path, t.customer.schema)


@query("a06_write_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def a06(t: Tables):
    path = scratch_path(t.spark, "table")
    io.write_table(t.supplier, path)
    return io.load_table(t.spark, path)


@query(
    "a07_write_report",
    """SELECT 'open orders' AS name, 'Orders still open' AS title, COUNT(*) AS rows FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT 'customers', 'All customers', COUNT(*) FROM customer""",
)
def a07(t: Tables):
    sheets = {
        "open orders": ("Orders still open", t.orders.where("o_orderstatus = 'O'")),
        "customers": ("All customers", t.customer),
    }
    return io.write_report(sheets, scratch_path(t.spark, "report"))


@query("a08_write_partitioned", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def a08(t: Tables):
    path = scratch_path(t.spark, "blocks")
    io.write_partitioned(t.orders, "o_orderstatus", path)
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _snapshots(t: Tables) -> str:
    path = scratch_path(t.spark, "snapshots")
    for day in ("2001-11-01", "2001-11-05", "2001-11-10"):
        io.snapshot_write(t.customer.withColumn("taken", F.lit(day)), path, day, min_days=7)
    return path


@query(
    "a09_snapshot_write",
    """SELECT '2001-11-01' AS snapshot_date, COUNT(*) AS n FROM customer
       UNION ALL SELECT '2001-11-10', COUNT(*) FROM customer""",
)
def a09(t: Tables):
    return io.snapshot_read_all(t.spark, _snapshots(t)).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


@query("a10_snapshot_read_latest", "SELECT c_custkey, '2001-11-10' AS taken, '2001-11-10' AS snapshot_date FROM customer")
def a10(t: Tables):
    return io.snapshot_read_latest(t.spark, _snapshots(t)).select("c_custkey", "taken", "snapshot_date")
