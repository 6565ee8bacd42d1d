"""Projection and cleaning (B)."""

from pyspark.sql import functions as F

from ..operators import clean as op
from .registry import MOVED_ORDERS, Tables, moved_orders, query


@query("b01_select_existing", "SELECT c_name, c_custkey FROM customer")
def b01(t: Tables):
    return op.select_existing(t.customer, ["c_name", "ghost", "c_custkey"])


@query("b02_rename_cols", "SELECT s_suppkey AS site_id, s_name AS site_name, s_nationkey, s_acctbal FROM supplier")
def b02(t: Tables):
    return op.rename_cols(t.supplier, {"s_suppkey": "site_id", "s_name": "site_name"})


@query(
    "b03_strip_name_prefix",
    """SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS orderstatus,
              o_totalprice AS totalprice, CAST(o_orderdate AS DATE)::VARCHAR AS order_date
       FROM orders""",
)
def b03(t: Tables):
    raw = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_order date")
    )
    return op.strip_name_prefix(raw, "o_")


@query("b04_drop_duplicate_columns", "SELECT * FROM customer")
def b04(t: Tables):
    both = t.customer.alias("b").join(t.customer.alias("a"), F.col("a.c_custkey") == F.col("b.c_custkey"))
    return op.drop_duplicate_columns(both.select("b.*", "a.*"))


@query(
    "b05_to_date_coerce",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)::VARCHAR END AS iso_day,
              CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)::VARCHAR END AS local_day
       FROM orders""",
)
def b05(t: Tables):
    def mixed(fmt):
        day = F.date_format("o_orderdate", fmt)
        return F.when(F.col("o_orderstatus") == "F", day).when(F.col("o_orderstatus") == "P", "---").otherwise(
            F.col("o_orderpriority")
        )

    raw = t.orders.select("o_orderkey", mixed("yyyy-MM-dd").alias("iso_day"), mixed("dd/MM/yyyy").alias("local_day"))
    return op.to_date_coerce(raw, ["iso_day", "ghost"]).transform(op.to_date_coerce, ["local_day"], "dd/MM/yyyy")


@query(
    "b06_to_number_coerce",
    """SELECT o_orderkey, COALESCE(TRY_CAST(SUBSTR(o_orderpriority, 1, 1) AS DOUBLE), 0) AS level,
              COALESCE(TRY_CAST(CASE o_orderstatus WHEN 'F' THEN o_totalprice::VARCHAR ELSE o_orderpriority END AS DOUBLE), -1)
              AS amount FROM orders""",
)
def b06(t: Tables):
    mixed = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string")).otherwise(F.col("o_orderpriority"))
    raw = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"), mixed.alias("amount"))
    return op.to_number_coerce(op.to_number_coerce(raw, "level"), "amount", -1)


@query(
    "b07_sentinel_to_null",
    """SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN o_orderpriority END
              AS o_orderpriority FROM orders""",
)
def b07(t: Tables):
    raw = t.orders.select("o_orderkey", "o_orderpriority")
    return op.sentinel_to_null(raw, ["o_orderpriority"], ["5-LOW", "4-NOT SPECIFIED"])


_LEFT = f"customer LEFT JOIN {MOVED_ORDERS} o ON c_custkey = o.o_custkey"


def _with_orders(t: Tables):
    return t.customer.join(moved_orders(t), F.col("c_custkey") == F.col("o_custkey"), "left")


@query(
    "b08_fill_missing_by_type",
    f"""SELECT c_custkey, COALESCE(o_orderkey, 0) AS o_orderkey, COALESCE(o_totalprice, 0) AS o_totalprice,
               COALESCE(o_orderstatus, 'no_info') AS o_orderstatus,
               COALESCE(CAST(o_orderdate AS DATE), DATE '1901-01-01')::VARCHAR AS o_orderdate
        FROM {_LEFT}""",
)
def b08(t: Tables):
    rows = _with_orders(t).select("c_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return op.fill_missing_by_type(rows).withColumn("o_orderdate", F.to_date("o_orderdate"))


@query(
    "b09_fill_value",
    f"""SELECT c_custkey, o_orderkey, CASE WHEN o_orderstatus IS NULL OR o_orderstatus = 'P' THEN 'community'
               ELSE o_orderstatus END AS o_orderstatus FROM {_LEFT}""",
)
def b09(t: Tables):
    rows = _with_orders(t).select("c_custkey", "o_orderkey", "o_orderstatus")
    return op.fill_value(rows, "o_orderstatus", "P", "community")


@query(
    "b10_coalesce_cols",
    f"SELECT c_custkey, o_orderkey, COALESCE(o_orderpriority, c_mktsegment) AS label FROM {_LEFT}",
)
def b10(t: Tables):
    out = op.coalesce_cols(_with_orders(t), "label", "o_orderpriority", "c_mktsegment")
    return out.select("c_custkey", "o_orderkey", "label")


OFFICES = {"BUILDING": "CAP", "AUTOMOBILE": "PAP", "MACHINERY": "GON"}


@query(
    "b11_map_values",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'CAP' WHEN 'AUTOMOBILE' THEN 'PAP'
              WHEN 'MACHINERY' THEN 'GON' END AS office,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'CAP' WHEN 'AUTOMOBILE' THEN 'PAP'
              WHEN 'MACHINERY' THEN 'GON' ELSE c_mktsegment END AS office_or_same FROM customer""",
)
def b11(t: Tables):
    rows = op.map_values(t.customer, "c_mktsegment", OFFICES, "office")
    rows = op.map_values(rows, "c_mktsegment", OFFICES, "office_or_same", keep=True)
    return rows.select("c_custkey", "office", "office_or_same")


@query(
    "b12_flag_equals",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS is_final FROM orders",
)
def b12(t: Tables):
    return op.flag_equals(t.orders, "o_orderstatus", "is_final", "F").select("o_orderkey", "is_final")


@query(
    "b13_flag_threshold",
    """SELECT l_orderkey, l_linenumber, l_quantity,
              CASE WHEN l_quantity > 25 THEN 'yes' ELSE 'no' END AS gt, CASE WHEN l_quantity >= 25 THEN 'yes' ELSE 'no' END AS ge,
              CASE WHEN l_quantity < 25 THEN 'yes' ELSE 'no' END AS lt, CASE WHEN l_quantity <= 25 THEN 'yes' ELSE 'no' END AS le,
              CASE WHEN l_quantity = 25 THEN 'yes' ELSE 'no' END AS eq, CASE WHEN l_quantity <> 25 THEN 'yes' ELSE 'no' END AS ne
       FROM lineitem""",
)
def b13(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    for name, sign in {"gt": ">", "ge": ">=", "lt": "<", "le": "<=", "eq": "==", "ne": "!="}.items():
        rows = op.flag_threshold(rows, "l_quantity", name, 25, op=sign)
    return rows


@query(
    "b14_case_last_wins",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity > 40 THEN 'large' WHEN l_quantity > 20 THEN 'medium'
              WHEN l_quantity > 5 THEN 'small' ELSE 'tiny' END AS tier FROM lineitem""",
)
def b14(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    q = F.col("l_quantity")
    return op.case_last_wins(rows, "tier", [(q > 5, "small"), (q > 20, "medium"), (q > 40, "large")], "tiny")


@query(
    "b15_flag_any",
    """SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_quantity,
              CASE WHEN l_discount <> 0 OR l_tax <> 0 THEN 'exeat' ELSE 'enrole' END AS status,
              CASE WHEN l_discount > 0.08 OR l_tax > 0.08 OR l_quantity > 0.08 THEN 'yes' ELSE 'no' END AS any_over
       FROM lineitem""",
)
def b15(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity")
    rows = op.flag_any(rows, ["l_discount", "l_tax"])
    return op.flag_any(rows, ["l_discount", "l_tax", "l_quantity"], 0.08, ">", "any_over", "yes", "no")


@query(
    "b16_update_where",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN 'HOUSEHOLD' ELSE c_mktsegment END
              AS c_mktsegment FROM customer""",
)
def b16(t: Tables):
    rule = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0)
    return op.update_where(t.customer, rule, "c_mktsegment", "HOUSEHOLD").select("c_custkey", "c_mktsegment")


@query(
    "b17_clamp_dates",
    """SELECT o_orderkey,
              LEAST(GREATEST(CAST(o_orderdate AS DATE), DATE '1996-01-01'), DATE '2000-12-31')::VARCHAR AS clamped,
              CASE WHEN o_orderdate < DATE '1996-01-01' THEN DATE '1996-05-31'
                   ELSE CAST(o_orderdate AS DATE) END::VARCHAR AS moved
       FROM orders""",
)
def b17(t: Tables):
    rows = op.clamp_dates(t.orders, "o_orderdate", "1996-01-01", "2000-12-31", out="clamped")
    rows = op.clamp_dates(rows, "o_orderdate", low="1996-01-01", low_value="1996-05-31", out="moved")
    return rows.select("o_orderkey", "clamped", "moved")


@query(
    "b18_ensure_columns",
    "SELECT s_suppkey, s_name, '---' AS closed_date, 0 AS visits, CAST(NULL AS VARCHAR) AS opened FROM supplier",
)
def b18(t: Tables):
    rows = t.supplier.select("s_suppkey", "s_name")
    return op.ensure_columns(
        rows,
        {"s_name": ("x", "string"), "closed_date": ("---", "string"), "visits": (0, "int"), "opened": (None, "date")},
    )


@query(
    "b19_make_code",
    "SELECT c_custkey, UPPER('nut-' || SUBSTR(c_name, 1, 3) || '-' || RIGHT(c_name, 4)) AS code FROM customer",
)
def b19(t: Tables):
    return op.make_code(t.customer, "c_name", "code", "nut").select("c_custkey", "code")


@query(
    "b20_one_hot",
    """SELECT l_orderkey, l_linenumber, (l_returnflag = 'A')::INT AS l_returnflag_a, (l_returnflag = 'N')::INT AS l_returnflag_n,
              (l_returnflag = 'R')::INT AS l_returnflag_r, 0 AS l_returnflag_null FROM lineitem""",
)
def b20(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return op.one_hot(rows, "l_returnflag", dummy_null=True).drop("l_returnflag")


@query(
    "b21_multi_label_flags",
    """SELECT p_partkey, list_contains(string_split(p_name, ' '), 'red')::INT AS has_red,
              list_contains(string_split(p_name, ' '), 'ring')::INT AS has_ring,
              list_contains(string_split(p_name, ' '), 'widget')::INT AS has_widget, 0 AS has_small FROM part""",
)
def b21(t: Tables):
    rows = t.part.select("p_partkey", "p_name")
    # 'small' never stands alone in a two-token name
    return op.multi_label_flags(rows, "p_name", ["red", "ring", "widget", "small"], alone="small", prefix="has_").drop("p_name")


@query(
    "b22_row_max_date",
    """SELECT o_orderkey, l_linenumber, l_partkey, l_quantity,
              GREATEST(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))::VARCHAR AS newest
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def b22(t: Tables):
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return op.row_max_date(rows, "newest", "o_orderdate", "l_shipdate").select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_quantity", "newest"
    )


@query("b23_require_columns", "SELECT s_suppkey, s_nationkey FROM supplier")
def b23(t: Tables):
    try:
        op.require_columns(t.supplier, ["s_suppkey", "ghost"])
    except ValueError:
        return op.require_columns(t.supplier, ["s_suppkey", "s_nationkey"]).select("s_suppkey", "s_nationkey")
    raise AssertionError("a missing column was not reported")


@query("b24_probe", "SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def b24(t: Tables):
    seen, _ = op.probe(t.orders.where("o_totalprice > 100000"), "large orders")
    return seen.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
