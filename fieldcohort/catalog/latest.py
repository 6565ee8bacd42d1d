"""Latest and ranked rows, sorting, set operations (F, G, H)."""

from pyspark.sql import functions as F

from ..functions.dates import month_name
from ..operators import aggregate as agg
from ..operators import latest as op
from .registry import Tables, query

def _newest():
    return [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]


@query(
    "f01_row_number_latest",
    """SELECT o_custkey, o_orderkey, rn FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
       ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 3""",
)
def f01(t: Tables):
    return op.top_n_per_key(t.orders, "o_custkey", _newest(), 3, "rn").select(
        "o_custkey", "o_orderkey", F.col("rn").cast("long").alias("rn")
    )


@query(
    "f02_latest_per_key",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
       ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def f02(t: Tables):
    out = op.latest_per_key(t.events, "user_id", [F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("user_id", "event_id", "event_type", "value")


_LINE_ORDER = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(
    "f03_dedupe_keep",
    f"""SELECT 'first' AS keep, l_orderkey, l_partkey, l_quantity FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
        ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1
        UNION ALL SELECT 'last', l_orderkey, l_partkey, l_quantity FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
        ORDER BY {', '.join(c + ' DESC' for c in _LINE_ORDER.split(', '))}) AS rn FROM lineitem) WHERE rn = 1""",
)
def f03(t: Tables):
    order = _LINE_ORDER.split(", ")
    parts = [op.dedupe_keep(t.lineitem, "l_orderkey", order, k).withColumn("keep", F.lit(k)) for k in ("first", "last")]
    return op.union_all(*parts).select("keep", "l_orderkey", "l_partkey", "l_quantity")


@query(
    "f04_count_over_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, COUNT(*) OVER (PARTITION BY l_orderkey) AS n_lines FROM lineitem",
)
def f04(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return op.count_over_key(rows, "l_orderkey", "n_lines")


@query(
    "f05_previous_value",
    """SELECT o_custkey, MAX(CASE WHEN rn = 1 THEN o_totalprice END) AS last_o_totalprice,
              MAX(CASE WHEN rn = 1 THEN CAST(o_orderdate AS DATE) END)::VARCHAR AS last_day,
              MAX(CASE WHEN rn = 2 THEN o_totalprice END) AS previous_o_totalprice,
              MAX(CASE WHEN rn = 2 THEN CAST(o_orderdate AS DATE) END)::VARCHAR AS previous_day
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
             FROM orders WHERE o_orderstatus <> 'P') WHERE rn <= 2 GROUP BY 1""",
)
def f05(t: Tables):
    rows = t.orders.withColumn("day", F.to_date("o_orderdate"))
    return op.latest_and_previous(
        rows, "o_custkey", _newest(), ["o_totalprice", "day"], where=F.col("o_orderstatus") != "P"
    )


@query(
    "f06_first_per_key",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
       AS rn FROM orders) WHERE rn = 1""",
)
def f06(t: Tables):
    return op.first_per_key(t.orders, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderkey"
    )


@query(
    "f07_first_last_at_levels",
    """SELECT event_id, CAST(MIN(ts) OVER (PARTITION BY user_id) AS DATE)::VARCHAR AS first_day,
              CAST(MAX(ts) OVER (PARTITION BY user_id) AS DATE)::VARCHAR AS last_day,
              CAST(MIN(ts) OVER (PARTITION BY user_id, event_type) AS DATE)::VARCHAR AS first_day_by_type FROM events""",
)
def f07(t: Tables):
    events = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    levels = [
        (["user_id"], {"first_day": "first", "last_day": "last"}),
        (["user_id", "event_type"], {"first_day_by_type": "first"}),
    ]
    rows = op.first_last_at_levels(events, events, "day", levels)
    return rows.select("event_id", "first_day", "last_day", "first_day_by_type")


@query(
    "f08_last_n_periods",
    """SELECT strftime(bucket, '%Y-%m') AS label, n FROM (SELECT date_trunc('month', o_orderdate) AS bucket, COUNT(*) AS n
       FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 12)""",
)
def f08(t: Tables):
    return op.last_n_periods(agg.time_bucket_counts(t.orders, "o_orderdate", "month"), "bucket", 12).select("label", "n")


@query("g01_sort_multi", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def g01(t: Tables):
    site = F.concat("o_orderstatus", F.lit("/"), "o_orderpriority")
    return op.sort_multi(t.orders, site, F.col("o_custkey"), F.col("o_orderkey")).select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )


@query("g02_limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def g02(t: Tables):
    return op.limit_n(t.orders, 100, F.col("o_totalprice").desc(), F.col("o_orderkey")).select("o_orderkey", "o_totalprice")


@query(
    "g03_sort_by_calendar",
    "SELECT monthname(o_orderdate) AS month_name, COUNT(*) AS n FROM orders GROUP BY 1",
)
def g03(t: Tables):
    counts = t.orders.groupBy(month_name("o_orderdate").alias("month_name")).agg(F.count(F.lit(1)).alias("n"))
    return op.sort_by_calendar(counts, "month_name")


@query(
    "g04_top_k_by_count",
    "SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10",
)
def g04(t: Tables):
    return op.top_k_by_count(t.events, "user_id", 10)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "g05_category_order_by_total",
    "SELECT COALESCE(n_name, 'Total') AS n_name, "
    + ", ".join(f"COUNT(*) FILTER (c_mktsegment = '{s}') AS {s.lower()}" for s in SEGMENTS)
    + ", 0::BIGINT AS other, COUNT(*) AS total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ROLLUP(n_name)",
)
def g05(t: Tables):
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return agg.category_order_by_total(agg.crosstab(rows, F.col("n_name"), "n_name", "c_mktsegment", SEGMENTS), "n_name")


@query(
    "h01_union_all",
    """SELECT c_custkey AS id, c_name AS name, 'customer' AS program, 'person' AS kind FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'supplier', 'site' FROM supplier""",
)
def h01(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    sites = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return op.union_all(
        people.withColumns({"program": F.lit("customer"), "kind": F.lit("person")}),
        sites.withColumns({"program": F.lit("supplier"), "kind": F.lit("site")}),
    )


@query(
    "h02_union_by_name",
    """SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status, CAST(NULL AS DOUBLE) AS quantity FROM orders
       UNION ALL SELECT l_orderkey, NULL, l_linestatus, l_quantity FROM lineitem""",
)
def h02(t: Tables):
    return op.union_by_name(
        t.orders.selectExpr("o_orderkey id", "o_totalprice price", "o_orderstatus status"),
        t.lineitem.selectExpr("l_orderkey id", "l_quantity quantity", "l_linestatus status"),
    )


@query(
    "h03_union_distinct",
    """SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_totalprice > 400000
       UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0""",
)
def h03(t: Tables):
    return op.union_distinct(
        t.orders.where("o_orderstatus = 'F'").selectExpr("o_custkey id"),
        t.orders.where("o_totalprice > 400000").selectExpr("o_custkey id"),
        t.customer.where("c_acctbal < 0").selectExpr("c_custkey id"),
    )


@query(
    "h04_set_difference_ids",
    """SELECT c_custkey AS id FROM customer EXCEPT (SELECT o_custkey FROM orders WHERE o_totalprice > 480000
       UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def h04(t: Tables):
    return op.set_difference_ids(
        t.customer.selectExpr("c_custkey id"),
        "id",
        t.orders.where("o_totalprice > 480000").selectExpr("o_custkey id"),
        t.customer.where("c_acctbal < 0").selectExpr("c_custkey id"),
    )


@query(
    "h05_append_newer_than",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < DATE '2000-06-01'
       UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >
         (SELECT MAX(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < DATE '2000-06-01')""",
)
def h05(t: Tables):
    base = t.orders.where("o_orderstatus = 'F' AND o_orderdate < DATE '2000-06-01'")
    return op.append_newer_than(base, t.orders, "o_orderdate").select("o_orderkey", "o_orderstatus")


@query(
    "h06_distinct_keep_all",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
       ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def h06(t: Tables):
    return op.distinct_keep_all(t.events, ["user_id", "event_type"], ["event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )
