"""Joins (D)."""

from pyspark.sql import functions as F

from ..operators import joins as op
from .registry import MOVED_ORDERS, Tables, moved_orders, query


def _orders_by_customer(t: Tables, where: str = "true"):
    return t.orders.where(where).withColumnRenamed("o_custkey", "c_custkey")


@query(
    "d01_left_lookup",
    "SELECT c_custkey, c_name, n_name, n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
)
def d01(t: Tables):
    people = t.customer.withColumnRenamed("c_nationkey", "n_nationkey")
    out = op.left_lookup(people, t.nation, "n_nationkey", ["n_name", "n_regionkey", "ghost"])
    return out.select("c_custkey", "c_name", "n_name", "n_regionkey")


@query(
    "d02_match_flag_join",
    f"""SELECT c_custkey, o_orderkey, CASE WHEN o.o_custkey IS NULL THEN 'no' ELSE 'yes' END AS has_order, 'all' AS kind
        FROM customer LEFT JOIN {MOVED_ORDERS} o ON c_custkey = o.o_custkey
        UNION ALL
        SELECT c_custkey, o_orderkey, CASE WHEN o.o_custkey IS NULL THEN 'no' ELSE 'yes' END, 'newest'
        FROM customer LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {MOVED_ORDERS}) WHERE rn = 1) o
          ON c_custkey = o.o_custkey""",
)
def d02(t: Tables):
    people, big = t.customer.select("c_custkey"), moved_orders(t).withColumnRenamed("o_custkey", "c_custkey").select("c_custkey", "o_orderkey", "o_orderdate")
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    every = op.match_flag_join(people, big, "c_custkey", "has_order").withColumn("kind", F.lit("all"))
    one = op.match_flag_join(people, big, "c_custkey", "has_order", dedupe_right=newest).withColumn("kind", F.lit("newest"))
    return every.unionByName(one).select("c_custkey", "o_orderkey", "has_order", "kind")


@query(
    "d03_inner_chain",
    """SELECT n_name, COUNT(*) AS n_lines, SUM(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS qty
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def d03(t: Tables):
    rows = op.inner_chain(
        t.lineitem.select("l_orderkey", "l_quantity"),
        (t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")),
        (t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")),
        (t.nation, F.col("c_nationkey") == F.col("n_nationkey")),
    )
    return rows.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("qty")
    )


@query(
    "d04_left_star",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, s_name, n_name, r_name FROM lineitem
       LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def d04(t: Tables):
    return op.left_star(
        t.lineitem,
        (t.supplier, F.col("l_suppkey") == F.col("s_suppkey")),
        (t.nation, F.col("s_nationkey") == F.col("n_nationkey")),
        (t.region, F.col("n_regionkey") == F.col("r_regionkey")),
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "s_name", "n_name", "r_name")


@query(
    "d05_anti_join",
    f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {MOVED_ORDERS})",
)
def d05(t: Tables):
    return op.anti_join(t.customer, moved_orders(t).withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey", "c_name")


_URGENT = "o_orderpriority = '1-URGENT'"


@query(
    "d06_semi_join",
    f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {_URGENT})",
)
def d06(t: Tables):
    return op.semi_join(t.customer, _orders_by_customer(t, _URGENT), "c_custkey").select("c_custkey", "c_name")


@query(
    "d07_membership_ignore_case",
    """SELECT UPPER(c_name) AS c_name, c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'in' ELSE 'out' END AS side
       FROM customer""",
)
def d07(t: Tables):
    people = t.customer.select("c_custkey", F.lower("c_name").alias("c_name"))
    listed = t.customer.where("c_mktsegment = 'BUILDING'").select(F.upper("c_name").alias("c_name"))
    inside = op.membership_ignore_case(people, listed, "c_name").withColumn("side", F.lit("in"))
    outside = op.membership_ignore_case(people, listed, "c_name", keep=False).withColumn("side", F.lit("out"))
    return inside.unionByName(outside)


@query(
    "d08_interval_join",
    """SELECT o_orderkey, l_linenumber, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
         AND (CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE)
                AND CAST(CAST(o_orderdate AS DATE) + INTERVAL 9 MONTH AS DATE) + 7
           OR CAST(l_shipdate AS DATE) BETWEEN CAST(DATE '2000-12-31' - INTERVAL 9 MONTH AS DATE) - 7 AND DATE '2000-12-31')""",
)
def d08(t: Tables):
    episodes = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("ddr"), F.lit("2000-12-31").cast("date").alias("dpa"))
    events = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    out = op.interval_join(episodes, events, "o_orderkey", "l_shipdate", start=F.col("ddr"), due=F.col("dpa"))
    return out.select("o_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "d08_window_join",
    """SELECT o_orderkey, l_linenumber, l_partkey, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
         AND CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 60""",
)
def d08_window(t: Tables):
    episodes = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("ddr"))
    events = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    window = (F.col("ddr"), F.date_add("ddr", 60))
    out = op.interval_join(episodes, events, "o_orderkey", "l_shipdate", windows=[window], how="inner")
    return out.select("o_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "d09_expr_key_join",
    """SELECT c_custkey, s_suppkey FROM customer JOIN supplier
       ON c_nationkey || '/' || SUBSTR(c_name, 17, 2) = s_nationkey || '/' || SUBSTR(s_name, 17, 2)""",
)
def d09(t: Tables):
    def code(nation, name):
        return F.concat(F.col(nation).cast("string"), F.lit("/"), F.substring(name, 17, 2))

    out = op.expr_key_join(t.customer, t.supplier, code("c_nationkey", "c_name"), code("s_nationkey", "s_name"), "inner")
    return out.select("c_custkey", "s_suppkey")


@query(
    "d09_pairs_by_code",
    """SELECT c_nationkey AS code, COUNT(*) AS pairs FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON c_nationkey = s_nationkey GROUP BY 1""",
)
def d09_counts(t: Tables):
    # all deliveries of a nation's suppliers against all its customers, counted without making the pairs
    sent = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return op.pair_counts(sent, t.customer, F.col("s_nationkey"), F.col("c_nationkey"), "code", "pairs")


@query(
    "d08_hot_person",
    """SELECT o_orderkey, COUNT(l_partkey) AS n, COALESCE(SUM(l_quantity), 0) AS quantity FROM
         (SELECT *, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS person FROM orders) o LEFT JOIN
         (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_partkey END AS person FROM lineitem) l ON o.person = l.person
         AND CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 1 GROUP BY 1""",
)
def d08_hot(t: Tables):
    # a third of all episodes and events belong to one person
    person = lambda c: F.when(F.col(c) % 3 == 0, 0).otherwise(F.col(c)).alias("person")
    episodes = t.orders.select("o_orderkey", person("o_custkey"), F.to_date("o_orderdate").alias("ddr"))
    events = t.lineitem.select(person("l_partkey"), "l_shipdate", "l_quantity")
    window = (F.col("ddr"), F.date_add("ddr", 1))
    # pairs of that person's episodes and events grow with the square of the table, those with its days do not
    daily = op.daily_totals(events, "person", "l_shipdate", n=F.count("l_quantity"), quantity=F.sum("l_quantity"))
    out = op.interval_join(episodes, daily, "person", "day", windows=[window])
    return out.groupBy("o_orderkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity"))


_NEWEST = """(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
             FROM orders WHERE {}) WHERE rn = 1)"""


@query(
    "d10_groupwise_latest_join",
    f"""SELECT c_custkey, o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS o_orderdate
        FROM customer LEFT JOIN {_NEWEST.format('TRUE')} o ON o.o_custkey = c_custkey""",
)
def d10(t: Tables):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    out = op.groupwise_latest_join(t.customer, _orders_by_customer(t), "c_custkey", order)
    return out.select("c_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))


@query(
    "d11_correlated_extreme",
    """SELECT o_orderkey, (SELECT CAST(MAX(l_shipdate) AS DATE) FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 30)::VARCHAR
              AS last_big, (SELECT MIN(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey) AS least FROM orders""",
)
def d11(t: Tables):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    rows = t.orders.select("o_orderkey")
    rows = op.correlated_extreme(rows, lines, "o_orderkey", F.to_date("l_shipdate"), "last_big", F.col("l_quantity") > 30)
    return op.correlated_extreme(rows, lines, "o_orderkey", F.col("l_quantity"), "least", func=F.min)


def _cell(source, lo, hi):
    return f"MAX(CASE WHEN src = '{source}' AND d BETWEEN DATE '{lo}' AND DATE '{hi}' THEN 1 ELSE 0 END)"


QUARTERS = {"q1": ("2000-01-01", "2000-03-31"), "q2": ("2000-04-01", "2000-06-30")}
_SOURCES = """SELECT 'orders' AS src, o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders
    UNION ALL SELECT 'lines', o_custkey, CAST(l_shipdate AS DATE) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    UNION ALL SELECT 'returns', o_custkey, CAST(l_shipdate AS DATE) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'R'"""


def presence_sql() -> str:
    cols, outs = [], []
    for p, (lo, hi) in QUARTERS.items():
        for s in ("orders", "lines", "returns"):
            cols.append(f"{_cell(s, lo, hi)} AS {s}_{p}")
            outs.append(f"CASE WHEN {s}_{p} = 1 THEN 'yes' ELSE 'no' END AS {s}_{p}")
        cols.append(f"MAX(CASE WHEN d BETWEEN DATE '{lo}' AND DATE '{hi}' THEN 1 ELSE 0 END) AS any_{p}")
        outs.append(f"CASE WHEN any_{p} = 1 THEN 'yes' ELSE 'no' END AS any_{p}")
    return f"""SELECT c_custkey, {', '.join(outs)} FROM customer LEFT JOIN
               (SELECT k, {', '.join(cols)} FROM ({_SOURCES}) GROUP BY k) ON k = c_custkey"""


def service_sources(t: Tables):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_returnflag")
    shipped = lines.join(orders.select("o_orderkey", "c_custkey"), "o_orderkey")
    return {
        "orders": (orders, "o_orderdate", None),
        "lines": (shipped, "l_shipdate", None),
        "returns": (shipped, "l_shipdate", F.col("l_returnflag") == "R"),
    }


@query("d12_presence_matrix", presence_sql())
def d12(t: Tables):
    return op.presence_matrix(t.customer.select("c_custkey"), "c_custkey", service_sources(t), QUARTERS)


@query(
    "d13_composite_key_join",
    """SELECT a.l_orderkey, a.l_linenumber, COUNT(*) AS n, SUM(CAST(b.l_quantity AS DECIMAL(18,2)))::DOUBLE AS qty
       FROM (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R') a
       JOIN (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag <> 'R') b
         ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber GROUP BY 1, 2""",
)
def d13(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    # both sides are grouped first, so the join has one row per key
    returned = t.lineitem.where("l_returnflag = 'R'").groupBy(*keys).agg(F.count(F.lit(1)).alias("a"))
    qty = F.sum(F.col("l_quantity").cast("decimal(18,2)"))
    other = t.lineitem.where("l_returnflag <> 'R'").groupBy(*keys).agg(F.count(F.lit(1)).alias("b"), qty.alias("q"))
    both = op.inner_chain(returned, (other, keys))
    return both.select(*keys, (F.col("a") * F.col("b")).alias("n"), (F.col("a") * F.col("q")).cast("decimal(38,2)").alias("qty"))


@query(
    "d14_latest_then_flag",
    f"""SELECT c_custkey, o_orderkey, CASE WHEN o_custkey IS NULL THEN 'no' ELSE 'yes' END AS served,
               CASE WHEN o_orderdate >= DATE '2001-06-01' THEN 'yes' ELSE 'no' END AS served_during
        FROM customer LEFT JOIN {_NEWEST.format("o_orderstatus = 'F'")} o ON o.o_custkey = c_custkey""",
)
def d14(t: Tables):
    out = op.latest_then_flag(
        t.customer.select("c_custkey", F.lit("2001-06-01").cast("date").alias("ddr")),
        _orders_by_customer(t),
        "c_custkey",
        positive=F.col("o_orderstatus") == "F",
        event_date="o_orderdate",
        order=[F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
        since=F.col("ddr"),
        found="served",
        during="served_during",
    )
    return out.select("c_custkey", "o_orderkey", "served", "served_during")


@query(
    "d15_status_partition",
    """SELECT c_custkey, CASE
         WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000) THEN 'enrolled'
         WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice < 100000) THEN 'waiting'
         ELSE 'no_follow_up' END AS status FROM customer""",
)
def d15(t: Tables):
    return op.status_partition(
        t.customer.select("c_custkey"),
        "c_custkey",
        [
            ("enrolled", _orders_by_customer(t, "o_totalprice > 480000")),
            ("waiting", _orders_by_customer(t, "o_orderpriority = '1-URGENT' AND o_totalprice < 100000")),
        ],
        rest="no_follow_up",
    )


@query(
    "d16_canonical_id",
    """SELECT person, COUNT(*) AS n_orders FROM (SELECT CASE WHEN c_nationkey > 0 THEN c_nationkey ELSE c_custkey END AS person
       FROM customer JOIN orders ON o_custkey = c_custkey) GROUP BY 1""",
)
def d16(t: Tables):
    people = t.customer.withColumn("person", op.canonical_id("c_nationkey", "c_custkey"))
    return people.join(_orders_by_customer(t), "c_custkey").groupBy("person").agg(F.count(F.lit(1)).alias("n_orders"))
