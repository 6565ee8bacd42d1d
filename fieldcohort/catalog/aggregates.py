"""Counts, rates, pivots and KPI rows (E)."""

from pyspark.sql import functions as F

from ..functions.bands import band
from ..operators import aggregate as op
from ..operators import partials
from ..session import scratch_path
from .registry import AS_OF, Tables, query

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
TYPES = ["click", "error", "purchase", "signup", "view"]
MONEY = "decimal(18,2)"


def money(name: str):
    return F.col(name).cast(MONEY)


def customers_with_nation(t: Tables):
    return t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))


def pct(num: str, den: str, digits: int = 1) -> str:
    return f"CASE WHEN {den} > 0 THEN round_even({num} * 100.0::DOUBLE / {den}, {digits}) ELSE 0 END::DOUBLE"


@query(
    "e01_count_by",
    """SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'Total', COUNT(*) FROM orders""",
)
def e01(t: Tables):
    return op.count_by(t.orders, "o_orderpriority")


_SHIP = "CAST({}(l_shipdate) AS DATE)::VARCHAR"
_PLACE = "(l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)"
_PLACE_COLS = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "e02_smart_aggregate",
    f"""SELECT l_orderkey, COUNT(l_partkey) AS l_partkey, {_SHIP.format('MIN')} AS first_l_shipdate,
               {_SHIP.format('MAX')} AS last_l_shipdate, SUM(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS l_quantity,
               arg_max(l_linestatus, row{_PLACE}) AS l_linestatus, arg_min(l_returnflag, row{_PLACE}) AS l_returnflag
        FROM lineitem GROUP BY 1""",
)
def e02(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("l_shipdate"), money("l_quantity").alias("l_quantity"),
        "l_linestatus", "l_returnflag",
        F.struct(*_PLACE_COLS).alias("place"),
    )
    out = op.smart_aggregate(
        rows, "l_orderkey", order=["place"], count_cols=["l_partkey"], span_cols=["l_shipdate"], last_cols=["l_linestatus"]
    )
    return out.drop("place")


@query(
    "e03_collapse_keep_all",
    f"""SELECT l_orderkey, SUM(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS l_quantity, {_SHIP.format('MAX')} AS l_shipdate,
               arg_min(l_returnflag, row{_PLACE}) AS l_returnflag FROM lineitem GROUP BY 1""",
)
def e03(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", money("l_quantity").alias("l_quantity"), F.to_date("l_shipdate").alias("l_shipdate"), "l_returnflag",
        F.struct(*_PLACE_COLS).alias("place"),
    )
    return op.collapse_keep_all(rows, "l_orderkey", ["place"]).drop("place")


@query(
    "e04_conditional_counts",
    """SELECT l_orderkey, COUNT(*) FILTER (l_returnflag = 'R') AS returned, COUNT(*) FILTER (l_returnflag = 'A') AS accepted,
              COUNT(*) FILTER (l_linestatus = 'O') AS open_lines FROM lineitem GROUP BY 1""",
)
def e04(t: Tables):
    return op.conditional_counts(
        t.lineitem,
        "l_orderkey",
        {
            "returned": F.col("l_returnflag") == "R",
            "accepted": F.col("l_returnflag") == "A",
            "open_lines": F.col("l_linestatus") == "O",
        },
    )


@query(
    "e05_count_distinct_by",
    """SELECT n_name, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS days
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""",
)
def e05(t: Tables):
    rows = t.orders.join(customers_with_nation(t), F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.withColumn("day", F.to_date("o_orderdate"))
    return op.count_distinct_by(rows, "n_name", {"customers": "o_custkey", "days": "day"})


@query(
    "e06_first_last_dates",
    f"""SELECT o_custkey, first_date::VARCHAR AS first_date, last_date::VARCHAR AS last_date, days_since::INT AS days_since,
               CASE WHEN days_since <= 365 THEN 'yes' ELSE 'no' END AS is_active
        FROM (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_date, CAST(MAX(o_orderdate) AS DATE) AS last_date,
              DATE '{AS_OF}' - CAST(MAX(o_orderdate) AS DATE) AS days_since FROM orders GROUP BY 1)""",
)
def e06(t: Tables):
    return op.first_last_dates(t.orders, "o_custkey", "o_orderdate", AS_OF)


@query(
    "e07_one_row_per_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
       ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def e07(t: Tables):
    from ..operators.latest import one_row_per_key

    out = one_row_per_key(t.orders, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "e08_string_agg_by",
    """SELECT o_custkey, string_agg(DISTINCT label, ' | ' ORDER BY label) AS labels FROM (SELECT o_custkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' WHEN o_orderpriority = '2-HIGH' THEN 'soon'
              ELSE o_orderpriority END AS label FROM orders) GROUP BY 1""",
)
def e08(t: Tables):
    p = F.col("o_orderpriority")
    label = F.when(p == "1-URGENT", "now").when(p == "2-HIGH", "soon").otherwise(p)
    return op.string_agg_by(t.orders, "o_custkey", label, "labels", " | ")


@query(
    "e09_rate_by",
    f"""SELECT CAST(ts AS DATE)::VARCHAR AS day, COUNT(*) AS n, COUNT(*) FILTER (value > 50) AS hits,
               {pct('COUNT(*) FILTER (value > 50)', 'COUNT(*)')} AS rate FROM events GROUP BY 1""",
)
def e09(t: Tables):
    return op.rate_by(t.events, F.to_date("ts"), F.col("value") > 50, "day")


@query(
    "e10_distribution",
    f"""SELECT event_type, n, {pct('n', 't')} AS pct FROM (SELECT event_type, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS t
        FROM events GROUP BY 1)""",
)
def e10(t: Tables):
    return op.distribution(t.events, "event_type")


@query(
    "e11_share_within",
    f"""SELECT c_mktsegment, o_orderstatus, n, {pct('n', 't')} AS pct FROM (SELECT c_mktsegment, o_orderstatus, COUNT(*) AS n,
        SUM(COUNT(*)) OVER (PARTITION BY c_mktsegment) AS t FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)""",
)
def e11(t: Tables):
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return op.share_within(rows, "c_mktsegment", "o_orderstatus")


def _bucket(unit: str, label: str) -> str:
    return f"""SELECT '{unit}' AS unit, CAST(date_trunc('{unit}', o_orderdate) AS DATE)::VARCHAR AS bucket, {label} AS label,
               COUNT(*) AS n FROM orders GROUP BY ALL"""


@query(
    "e12_time_bucket_counts",
    " UNION ALL ".join(
        [
            _bucket("week", "strftime(date_trunc('week', o_orderdate), '%d %b')"),
            _bucket("month", "strftime(o_orderdate, '%Y-%m')"),
            _bucket("quarter", "year(o_orderdate) || '-Q' || quarter(o_orderdate)"),
            _bucket("day", "strftime(o_orderdate, '%Y-%m-%d')"),
            "SELECT 'weekday', isodow(o_orderdate)::VARCHAR, dayname(o_orderdate), COUNT(*) FROM orders GROUP BY ALL",
        ]
    ),
)
def e12(t: Tables):
    return op.time_buckets_of_all_units(t.orders, "o_orderdate")


PRIORITY_PAIR = ["1-URGENT", "5-LOW"]
DECLARED = ["BUILDING", "MACHINERY"]
STATUSES = ["F", "O"]
_CELLS = [
    (f"{s.lower()}_{p.lower().replace('-', '_')}", f"o_orderstatus = '{s}' AND o_orderpriority = '{p}'")
    for s in STATUSES
    for p in PRIORITY_PAIR
]


@query(
    "e13_pivot_margins",
    "SELECT COALESCE(monthname(o_orderdate), 'Total') AS month, "
    + ", ".join(f"COUNT(*) FILTER ({c}) AS {n}" for n, c in _CELLS)
    + """, COUNT(*) FILTER (NOT (o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '5-LOW'))) AS other, COUNT(*) AS total
         FROM orders GROUP BY ROLLUP(monthname(o_orderdate))""",
)
def e13(t: Tables):
    return op.pivot_margins(
        t.orders,
        F.date_format("o_orderdate", "MMMM"),
        "month",
        [("o_orderstatus", STATUSES), ("o_orderpriority", PRIORITY_PAIR)],
    )


def _seg_cells(measure: str) -> str:
    """One column per declared segment and one for all others."""
    rest = "c_mktsegment NOT IN ({})".format(", ".join(f"'{s}'" for s in DECLARED))
    return ", ".join([*[measure.format(f"c_mktsegment = '{s}'") + f" AS {s.lower()}" for s in DECLARED], measure.format(rest) + " AS other"])


@query(
    "e14_crosstab",
    f"""WITH b AS (SELECT COALESCE(n_name, 'Total') AS n_name, {_seg_cells("COUNT(*) FILTER ({})")},
          COUNT(*) AS total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ROLLUP(n_name))
        SELECT *, {', '.join(pct(s.lower(), 'total') + f' AS {s.lower()}_pct' for s in [*DECLARED, 'other'])} FROM b""",
)
def e14(t: Tables):
    return op.crosstab(customers_with_nation(t), F.col("n_name"), "n_name", "c_mktsegment", DECLARED, percent=True)


@query(
    "e14_crosstab_sum",
    f"""SELECT n_name, {_seg_cells("COALESCE(SUM(CAST(c_acctbal AS DECIMAL(18,2))) FILTER ({}), 0)::DOUBLE")},
        SUM(CAST(c_acctbal AS DECIMAL(18,2)))::DOUBLE AS total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""",
)
def e14_sum(t: Tables):
    return op.crosstab(
        customers_with_nation(t), F.col("n_name"), "n_name", "c_mktsegment", DECLARED, measure=money("c_acctbal"), margins=False
    )


@query(
    "e15_add_found_percentage",
    f"""WITH b AS (SELECT COALESCE(event_type, 'Total') AS event_type, COUNT(*) FILTER (value > 50) AS oui,
           COUNT(*) FILTER (value <= 50) AS non, 0::BIGINT AS other, COUNT(*) AS total FROM events GROUP BY ROLLUP(event_type))
        SELECT *, oui AS total_found, {pct('oui', 'total', 2)} AS pct_found FROM b""",
)
def e15(t: Tables):
    rows = t.events.withColumn("found", F.when(F.col("value") > 50, "Oui").otherwise("Non"))
    pivot = op.pivot_margins(rows, F.col("event_type"), "event_type", [("found", ["Oui", "Non"])])
    return op.add_found_percentage(pivot, ["oui"])


@query(
    "e16_attendance_summary",
    """SELECT user_id, COUNT(*) FILTER (event_type = 'view') AS present, COUNT(*) FILTER (event_type <> 'view') AS absent
       FROM events GROUP BY 1""",
)
def e16(t: Tables):
    return op.attendance_summary(t.events, "user_id", F.col("event_type") == "view")


@query(
    "e17_heatmap_matrix",
    f"""SELECT r_name, {_seg_cells("COALESCE(SUM(CAST(c_acctbal AS DECIMAL(18,2))) FILTER ({}), 0)::DOUBLE")}
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1""",
)
def e17(t: Tables):
    rows = customers_with_nation(t).join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    return op.heatmap_matrix(rows, "r_name", "c_mktsegment", DECLARED, money("c_acctbal"))


def _profile_sql() -> str:
    cols = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
    parts = []
    for c, kind in cols.items():
        num = f"CAST({c} AS DOUBLE)" if kind != "string" else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT '{c}' AS column_name, '{kind}' AS type, COUNT(*) - COUNT({c}) AS n_null, MIN({num}) AS min, MAX({num}) AS max,
                round(AVG({num}), 4) AS mean, round(STDDEV({num}), 4) AS std, QUANTILE_DISC({num}, 0.25) AS q25, QUANTILE_DISC({num}, 0.5) AS q50,
                QUANTILE_DISC({num}, 0.75) AS q75 FROM customer"""
        )
    return " UNION ALL ".join(parts)


@query("e18_profile", _profile_sql())
def e18(t: Tables):
    return op.profile(t.customer).withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query(
    "e18_top_categories",
    """SELECT column_name, value, n, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank
       FROM (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, COUNT(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'o_orderpriority', o_orderpriority, COUNT(*) FROM orders GROUP BY 2)) WHERE rank <= 3""",
)
def e18_top(t: Tables):
    out = op.top_categories(t.orders, ["o_orderstatus", "o_orderpriority"], 3)
    return out.withColumn("rank", F.col("rank").cast("long"))


@query("e19_top_key", "SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 1")
def e19(t: Tables):
    return op.top_key(t.events, "user_id")


@query(
    "e20_kpi_row",
    f"""SELECT *, {pct('eligible', 'total')} AS pct_eligible, {pct('mas', 'total')} AS pct_mas, {pct('total', 'none_n')} AS pct_none
        FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (o_orderstatus = 'F') AS eligible,
              COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS mas, COUNT(*) FILTER (o_totalprice < 0) AS none_n,
              COUNT(DISTINCT o_custkey) AS people FROM orders)""",
)
def e20(t: Tables):
    return op.kpi_row(
        t.orders,
        {
            "total": F.count(F.lit(1)),
            "eligible": F.count_if(F.col("o_orderstatus") == "F"),
            "mas": F.count_if(F.col("o_orderpriority") == "1-URGENT"),
            "none_n": F.count_if(F.col("o_totalprice") < 0),
            "people": F.count_distinct("o_custkey"),
        },
        {"pct_eligible": ("eligible", "total"), "pct_mas": ("mas", "total"), "pct_none": ("total", "none_n")},
    )


@query(
    "e21_kpi_by_office",
    f"""WITH s AS (SELECT n_name, COUNT(*) AS screened, COUNT(*) FILTER (c_acctbal > 0) AS eligible FROM customer
          JOIN nation ON n_nationkey = c_nationkey GROUP BY 1),
        e AS (SELECT n_name, COUNT(*) AS enrolled FROM orders JOIN customer ON c_custkey = o_custkey
          JOIN nation ON n_nationkey = c_nationkey WHERE o_totalprice > 490000 GROUP BY 1)
        SELECT n_name, screened, eligible, COALESCE(enrolled, 0) AS enrolled, {pct('COALESCE(enrolled, 0)', 'eligible')} AS admission
        FROM s LEFT JOIN e USING (n_name)""",
)
def e21(t: Tables):
    people = customers_with_nation(t)
    enrolled = t.orders.where("o_totalprice > 490000").join(people, F.col("c_custkey") == F.col("o_custkey"))
    return op.kpi_by_office(
        people,
        enrolled,
        "n_name",
        {"screened": F.count(F.lit(1)), "eligible": F.count_if(F.col("c_acctbal") > 0)},
        {"admission": ("enrolled", "eligible")},
    )


@query(
    "e22_period_compare",
    """SELECT c AS current_n, p AS previous_n, CASE WHEN p > 0 THEN round_even((c - p) * 100.0::DOUBLE / p, 2) ELSE 0 END AS pct_change
       FROM (SELECT COUNT(*) FILTER (o_orderdate >= DATE '2000-04-01' AND o_orderdate < DATE '2000-07-01') AS c,
             COUNT(*) FILTER (o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2000-04-01') AS p FROM orders)""",
)
def e22(t: Tables):
    # 91 days, so the window before it starts on 1 January of the leap year
    return op.period_compare(t.orders, "o_orderdate", "2000-04-01", "2000-06-30")


@query(
    "e23_month_wide_counts",
    "SELECT o_custkey, "
    + ", ".join(f"COUNT(*) FILTER (month(o_orderdate) = {m}) AS {n}" for n, m in op.FISCAL_MONTHS.items())
    + ", COUNT(*) AS total FROM orders GROUP BY 1",
)
def e23(t: Tables):
    return op.month_wide_counts(t.orders, "o_custkey", "o_orderdate")


@query(
    "e24_sum_by",
    """SELECT c_nationkey::VARCHAR AS c_nationkey, SUM(CAST(c_acctbal AS DECIMAL(18,2)))::DOUBLE AS balance FROM customer GROUP BY 1
       UNION ALL SELECT 'Total', SUM(CAST(c_acctbal AS DECIMAL(18,2)))::DOUBLE FROM customer""",
)
def e24(t: Tables):
    return op.sum_by(t.customer, "c_nationkey", money("c_acctbal"), "balance")


@query(
    "e25_age_pyramid",
    """SELECT CASE WHEN p_size < 5 THEN '0-4' WHEN p_size < 10 THEN '5-9' WHEN p_size < 15 THEN '10-14' WHEN p_size < 18 THEN '15-17' ELSE 'other' END AS band,
              COUNT(*) FILTER (p_type = 'SMALL') AS small, COUNT(*) FILTER (p_type = 'PROMO') AS promo,
              COUNT(*) FILTER (p_type = 'NEVER') AS never, COUNT(*) FILTER (p_type NOT IN ('SMALL', 'PROMO', 'NEVER')) AS other FROM part GROUP BY 1""",
)
def e25(t: Tables):
    bands = band("p_size", [(5, "0-4"), (10, "5-9"), (15, "10-14"), (18, "15-17")])
    return op.age_pyramid(t.part, bands, "p_type", ["SMALL", "PROMO", "NEVER"])


@query("e26_distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def e26(t: Tables):
    return op.distinct_values(t.customer, "c_mktsegment")


@query(
    "e27_indicator_rows",
    """SELECT 'all orders' AS scope, indicator, n FROM (SELECT 'orders' AS indicator, COUNT(*) AS n FROM orders
       UNION ALL SELECT 'open', COUNT(*) FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT 'negative', COUNT(*) FROM orders WHERE o_totalprice < 0) WHERE n > 0""",
)
def e27(t: Tables):
    row = t.orders.agg(
        F.lit("all orders").alias("scope"),
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open"),
        F.count_if(F.col("o_totalprice") < 0).alias("negative"),
    )
    return op.indicator_rows(row, ["orders", "open", "negative"], ["scope"])


@query(
    "e28_alert_summary",
    """SELECT user_id, n, SUM(n) OVER ()::BIGINT AS total, COUNT(*) OVER () AS n_offices, TRUE AS has_alert
       FROM (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'error' AND value > 80 GROUP BY 1)""",
)
def e28(t: Tables):
    return op.alert_summary(t.events, (F.col("event_type") == "error") & (F.col("value") > 80), "user_id")


@query(
    "e29_active_units",
    """SELECT COUNT(DISTINCT user_id) AS active_units, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days FROM events
       WHERE ts >= DATE '2024-01-08' AND ts < DATE '2024-01-15' AND event_type = 'view'""",
)
def e29(t: Tables):
    return op.active_units(t.events, "user_id", "ts", "2024-01-08", "2024-01-14", F.col("event_type") == "view")


@query(
    "e29_active_units_from_partials",
    """SELECT COUNT(DISTINCT user_id) AS active_units, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days FROM events
       WHERE ts >= DATE '2024-01-08' AND ts < DATE '2024-01-15' AND event_type = 'view'""",
)
def e29_partials(t: Tables):
    path = scratch_path(t.spark, "daily")
    seen = {"seen": (F.col("user_id"), F.col("event_type") == "view")}
    partials.write_partials(partials.daily_partials(t.events, "ts", {}, seen), path)
    return partials.active_days(partials.read_partials(t.spark, path), "seen", "2024-01-08", "2024-01-14")


@query(
    "e30_density_fill_buckets",
    """WITH r AS (SELECT CAST(l_shipdate AS DATE) + 3 * (CAST(l_shipdate AS DATE) - DATE '1990-01-01')::INT AS d FROM lineitem)
       SELECT CAST(g AS DATE)::VARCHAR AS bucket, COUNT(d) AS n FROM generate_series((SELECT MIN(d) FROM r)::TIMESTAMP,
         (SELECT MAX(d) FROM r)::TIMESTAMP, INTERVAL 1 DAY) s(g) LEFT JOIN r ON d = CAST(g AS DATE) GROUP BY 1""",
)
def e30(t: Tables):
    # every date moves to four times its distance, which leaves three empty days after each
    day = F.to_date("l_shipdate")
    spread = F.date_add(day, 3 * F.datediff(day, F.lit("1990-01-01").cast("date")))
    return op.density_fill_buckets(t.lineitem.select(spread.alias("day")), "day")
