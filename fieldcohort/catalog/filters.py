"""Row selection (C)."""

from pyspark.sql import functions as F

from ..operators import filters as op
from ..operators import joins
from .registry import AS_OF, EVENTS_AS_OF, MOVED_ORDERS, Tables, moved_orders, query

_IN_1997 = "o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'"


@query("c01_between_dates", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_IN_1997}")
def c01(t: Tables):
    return op.between_dates(t.orders, "o_orderdate", "1997-01-01", "1997-12-31").select("o_orderkey", "o_custkey")


@query(
    "c02_screened_in_period",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE {_IN_1997} AND o_orderdate >= DATE '1997-04-15'",
)
def c02(t: Tables):
    rows = op.screened_in_period(t.orders, "o_orderdate", "1997-01-01", "1997-12-31", "1997-04-15")
    return rows.select("o_orderkey", "o_custkey")


_LINES = "(SELECT l_orderkey, COUNT(*) AS n_lines, MIN(l_shipdate) AS first_ship FROM lineitem GROUP BY 1)"


@query(
    "c03_enrolled_with_visits",
    f"""SELECT o_orderkey, COALESCE(n_lines, 0) AS n_lines FROM orders LEFT JOIN {_LINES} ON l_orderkey = o_orderkey
        WHERE (o_orderstatus = 'F' OR COALESCE(n_lines, 0) > 3)
          AND (o_orderdate >= DATE '2000-01-01' OR first_ship >= DATE '2000-01-01')""",
)
def c03(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("l_shipdate").alias("first_ship")
    )
    rows = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("is_enrolled"),
        (F.coalesce("n_lines", F.lit(0)) - 3).alias("extra"),
        F.to_date("o_orderdate").alias("enrolled_on"),
        F.to_date("first_ship").alias("admitted_on"),
    )
    out = op.enrolled_with_visits(rows, "2000-01-01", visits="extra", date1="enrolled_on", date2="admitted_on")
    return out.select("o_orderkey", "n_lines")


_LARGE = f"customer LEFT JOIN {MOVED_ORDERS} o ON c_custkey = o.o_custkey"


def _large(t: Tables):
    return t.customer.join(moved_orders(t), F.col("c_custkey") == F.col("o_custkey"), "left")


@query(
    "c04_exclude_values",
    f"""SELECT c_custkey, o_orderkey, o_orderpriority FROM {_LARGE}
        WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
)
def c04(t: Tables):
    return op.exclude_values(_large(t), "o_orderpriority", ["1-URGENT", "2-HIGH"]).select(
        "c_custkey", "o_orderkey", "o_orderpriority"
    )


@query("c05_open_cases", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'")
def c05(t: Tables):
    return op.open_cases(t.orders, "o_orderstatus", "O").select("o_orderkey", "o_custkey")


_STEPS_SQL = ["c_mktsegment <> 'BUILDING'", "c_nationkey NOT IN (3, 7)", "c_acctbal BETWEEN 0 AND 8000", "c_acctbal NOT BETWEEN 4000 AND 4500"]


def _steps():
    return [
        ("not building", F.col("c_mktsegment") != "BUILDING"),
        ("nation", ~F.col("c_nationkey").isin(3, 7)),
        ("balance", F.col("c_acctbal").between(0, 8000)),
        ("settled", ~F.col("c_acctbal").between(4000, 4500)),
    ]


@query(
    "c06_sequential_filter",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE " + " AND ".join(_STEPS_SQL),
)
def c06(t: Tables):
    return op.sequential_filter(t.customer, _steps()).select("c_custkey", "c_mktsegment")


@query(
    "c06_attrition",
    "SELECT 0 AS step, 'initial' AS name, COUNT(*) AS rows_left FROM customer "
    + " ".join(
        f"UNION ALL SELECT {i}, '{n}', COUNT(*) FROM customer WHERE {' AND '.join(_STEPS_SQL[:i])}"
        for i, n in enumerate(["not building", "nation", "balance", "settled"], start=1)
    ),
)
def c06_attrition(t: Tables):
    return op.attrition(t.customer, _steps())


@query(
    "c07_not_equal_keep_null",
    f"SELECT c_custkey, o_orderkey, o_orderstatus FROM {_LARGE} WHERE o_orderstatus IS DISTINCT FROM 'F'",
)
def c07(t: Tables):
    return op.not_equal_keep_null(_large(t), "o_orderstatus", "F").select("c_custkey", "o_orderkey", "o_orderstatus")


@query(
    "c08_in_range_list",
    "SELECT p_partkey, p_size, p_type FROM part WHERE p_size BETWEEN 9 AND 17 AND p_type IN ('SMALL', 'PROMO')",
)
def c08(t: Tables):
    return op.in_range_list(t.part, "p_size", 9, 17, "p_type", ["SMALL", "PROMO"]).select("p_partkey", "p_size", "p_type")


@query(
    "c09_conjunctive_filter",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
       WHERE l_suppkey IN (1, 2, 3, 5, 8) AND l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '2000-01-01'
         AND l_linestatus <> 'F' AND l_tax = 0.02 AND l_returnflag <> 'R'""",
)
def c09(t: Tables):
    return op.conjunctive_filter(
        t.lineitem,
        user="l_suppkey",
        users=[1, 2, 3, 5, 8],
        day="l_shipdate",
        start="1997-01-01",
        end="1999-12-31",
        closed=F.col("l_linestatus") == "F",
        cycle_blank=F.col("l_tax") == 0.02,
        area="l_returnflag",
        not_area="R",
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "c10_dashboard_filter",
    """SELECT o_orderkey, n_name, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey
       WHERE c_mktsegment = 'HOUSEHOLD' AND n_name IN ('NATION_1', 'NATION_4') AND o_orderdate >= DATE '1999-01-01'
         AND o_orderdate < DATE '2001-01-01'""",
)
def c10(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = op.dashboard_filter(rows, office=("c_mktsegment", "all"))
    return op.dashboard_filter(
        rows,
        office=("c_mktsegment", "HOUSEHOLD"),
        communes=("n_name", ["NATION_1", "NATION_4"]),
        dates=("o_orderdate", "1999-01-01", "2000-12-31"),
    ).select("o_orderkey", "n_name", "c_mktsegment")


@query(
    "c11_exclude_on_alias",
    """SELECT * FROM (SELECT o_orderkey, n_name AS commune, r_name AS departement FROM orders
         JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
         LEFT JOIN region ON r_regionkey = n_regionkey)
       WHERE commune NOT IN ('NATION_2', 'NATION_9') AND departement NOT IN ('ASIA')""",
)
def c11(t: Tables):
    rows = joins.left_star(
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")),
        (t.nation, F.col("c_nationkey") == F.col("n_nationkey")),
        (t.region, F.col("n_regionkey") == F.col("r_regionkey")),
    ).select("o_orderkey", F.col("n_name").alias("commune"), F.col("r_name").alias("departement"))
    return op.exclude_on_alias(rows, commune=["NATION_2", "NATION_9"], departement=["ASIA"])


@query("c12_future_rows", "SELECT event_id, user_id FROM events WHERE ts >= DATE '2024-01-26'")
def c12(t: Tables):
    return op.future_rows(t.events, "ts", "2024-01-25").select("event_id", "user_id")


_EPISODE = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS ddr, last_ship AS dpa
    FROM orders LEFT JOIN (SELECT l_orderkey, CAST(MAX(l_shipdate) AS DATE) AS last_ship FROM lineitem GROUP BY 1)
    ON l_orderkey = o_orderkey"""


@query(
    "c13_episode_overlaps",
    f"""SELECT o_orderkey, ddr::VARCHAR AS ddr, dpa::VARCHAR AS dpa FROM ({_EPISODE})
        WHERE COALESCE(dpa, CAST(ddr + INTERVAL 9 MONTH AS DATE) + 7) >= DATE '1998-03-01'
          AND COALESCE(ddr, CAST(dpa - INTERVAL 9 MONTH AS DATE) - 7) <= DATE '1998-03-31'""",
)
def c13(t: Tables):
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("dpa"))
    rows = t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("ddr"), "dpa"
    )
    return rows.where(op.episode_overlaps(F.col("ddr"), F.col("dpa"), "1998-03-01", "1998-03-31"))


_COHORT = """SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS ddr,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 9 MONTH AS DATE) END AS dpa,
    CAST(o_orderdate AS DATE) AS added_at,
    CASE WHEN o_orderpriority < '3' THEN CAST(o_orderdate - INTERVAL 20 MONTH AS DATE) END AS delivery_date FROM orders"""


@query(
    "c14_disjoint_by_key",
    f"""WITH b AS ({_COHORT}), chosen AS (SELECT * FROM b WHERE dpa >= DATE '2000-10-01'
            OR (dpa IS NULL AND added_at BETWEEN DATE '2000-10-01' AND DATE '2001-09-30')),
        recent AS (SELECT o_custkey FROM chosen WHERE delivery_date IS NULL OR delivery_date >= DATE '1998-10-01'),
        old AS (SELECT * FROM chosen WHERE o_custkey NOT IN (SELECT o_custkey FROM recent) AND delivery_date IS NOT NULL)
        SELECT 'kept' AS part, o_custkey, o_orderkey FROM chosen
        WHERE o_custkey NOT IN (SELECT o_custkey FROM old)
          AND (COALESCE(delivery_date > DATE '2000-07-01', FALSE) OR dpa IS NOT NULL OR ddr IS NOT NULL)
        UNION ALL SELECT 'old', o_custkey, o_orderkey FROM old""",
)
def c14(t: Tables):
    day = F.to_date("o_orderdate")
    rows = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", day).alias("ddr"),
        F.when(F.col("o_orderstatus") == "F", F.add_months(day, 9)).alias("dpa"),
        day.alias("added_at"),
        F.when(F.col("o_orderpriority") < "3", F.add_months(day, -20)).alias("delivery_date"),
    )
    return joins.disjoint_by_key(rows, "o_custkey", "2000-10-01", "2001-09-30").select("part", "o_custkey", "o_orderkey")


@query(
    "c15_last_n_days",
    """SELECT 'week' AS span, event_id AS id FROM events WHERE ts >= DATE '2024-01-25' AND ts < DATE '2024-02-01'
       UNION ALL SELECT '13 months', o_orderkey FROM orders
       WHERE o_orderdate >= DATE '2000-11-02' AND o_orderdate < DATE '2001-12-02'""",
)
def c15(t: Tables):
    week = op.last_n_days(t.events, "ts", 7, EVENTS_AS_OF).select(F.lit("week").alias("span"), F.col("event_id").alias("id"))
    year = op.last_n_months(t.orders, "o_orderdate", 13, AS_OF).select(
        F.lit("13 months").alias("span"), F.col("o_orderkey").alias("id")
    )
    return week.unionByName(year)
