"""Column functions (I)."""

from pyspark.sql import functions as F

from ..functions import bands as bd
from ..functions import dates as dt
from ..functions import text as tx
from .registry import AS_OF, Tables, query

DAY = "CAST(o_orderdate AS DATE)"
REF = f"DATE '{AS_OF}'"


def day():
    return F.to_date("o_orderdate")


def months_sql(a: str, b: str) -> str:
    """Complete months from a to b, cut towards zero."""

    def up(x, y):
        return f"(12 * (year({y}) - year({x})) + month({y}) - month({x}) - (day({y}) < day({x}))::INT)"

    return f"CAST(CASE WHEN {b} >= {a} THEN {up(a, b)} ELSE -{up(b, a)} END AS BIGINT)"


def due_sql(d: str) -> str:
    return f"(CAST({d} + INTERVAL 9 MONTH AS DATE) + 7)"


def _age(expr: str) -> str:
    return f"SELECT o_orderkey, CAST({expr} AS INT) AS age FROM orders"


@query("i01_age_years_rounded", _age(f"round_even(({REF} - {DAY}) / 365.25::DOUBLE, 0)"))
def i01(t: Tables):
    return t.orders.select("o_orderkey", dt.age_years_rounded("o_orderdate", AS_OF).alias("age"))


@query("i02_age_months_rounded", _age(f"round_even(({REF} - {DAY}) / 30.44::DOUBLE, 0)"))
def i02(t: Tables):
    return t.orders.select("o_orderkey", dt.age_months_rounded("o_orderdate", AS_OF).alias("age"))


@query("i03_age_years_floor", _age(f"floor(({REF} - {DAY}) / 365.25::DOUBLE)"))
def i03(t: Tables):
    return t.orders.select("o_orderkey", dt.age_years_floor("o_orderdate", AS_OF).alias("age"))


_PAIR = "lineitem JOIN orders ON o_orderkey = l_orderkey"
SHIP = "CAST(l_shipdate AS DATE)"


def _pairs(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    return lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    "i04_complete_units",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {months_sql(DAY, SHIP)} AS months,
               {months_sql(DAY, SHIP)} // 12 AS years, CAST({SHIP} - {DAY} AS BIGINT) AS days FROM {_PAIR} WHERE {SHIP} >= {DAY}""",
)
def i04(t: Tables):
    rows = _pairs(t).where(F.to_date("l_shipdate") >= day())
    ship = F.to_date("l_shipdate")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        dt.complete_months(day(), ship).alias("months"),
        dt.complete_years(day(), ship).alias("years"),
        dt.complete_units("DAY", day(), ship).alias("days"),
    )


@query(
    "i04_complete_months_both_ways",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {months_sql(DAY, SHIP)} AS months FROM {_PAIR}",
)
def i04_both(t: Tables):
    months = dt.complete_months(day(), F.to_date("l_shipdate"))
    return _pairs(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", months.alias("months"))


@query(
    "i05_age_flag",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
               CASE WHEN {months_sql(DAY, SHIP)} BETWEEN 1 AND 3 THEN 'yes' ELSE 'no' END AS flag FROM {_PAIR}""",
)
def i05(t: Tables):
    flag = dt.age_flag("o_orderdate", F.col("l_shipdate"), 1, 3)
    return _pairs(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", flag.alias("flag"))


@query("i06_due_date", f"""SELECT o_orderkey, {due_sql(DAY)}::VARCHAR AS due,
    (CAST({due_sql(DAY)} - INTERVAL 9 MONTH AS DATE) - 7)::VARCHAR AS start_again FROM orders""")
def i06(t: Tables):
    due = dt.due_date("o_orderdate")
    return t.orders.select("o_orderkey", due.alias("due"), dt.episode_start(due).alias("start_again"))


@query(
    "i07_gestation",
    f"SELECT o_orderkey, CAST(trunc((DATE '1998-06-30' - {DAY}) / 7) AS INT) AS weeks, CAST(trunc((DATE '1998-06-30' - {DAY}) / 30) AS INT) AS months FROM orders",
)
def i07(t: Tables):
    return t.orders.select(
        "o_orderkey",
        dt.gestation_weeks("o_orderdate", "1998-06-30").alias("weeks"),
        dt.gestation_months("o_orderdate", "1998-06-30").alias("months"),
    )


_LEFT_WEEKS = f"(({due_sql(DAY)} - DATE '1998-06-30') / 7.0)"


@query(
    "i08_trimester",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Inconnu' WHEN {_LEFT_WEEKS} > 26 THEN '1st'
               WHEN {_LEFT_WEEKS} > 13 THEN '2nd' ELSE '3rd' END AS trimester FROM orders""",
)
def i08(t: Tables):
    due = F.when(F.col("o_orderstatus") != "P", dt.due_date("o_orderdate"))
    return t.orders.select("o_orderkey", dt.trimester(due, "1998-06-30").alias("trimester"))


_BOUNDS = {
    "current_week": ("date_trunc('week', d)", "date_trunc('week', d) + INTERVAL 6 DAY"),
    "previous_week": ("date_trunc('week', d) - INTERVAL 7 DAY", "date_trunc('week', d) - INTERVAL 1 DAY"),
    "current_month": ("date_trunc('month', d)", "last_day(d)"),
    "previous_month": ("date_trunc('month', d) - INTERVAL 1 MONTH", "date_trunc('month', d) - INTERVAL 1 DAY"),
    "last_3_months": ("date_trunc('month', d) - INTERVAL 3 MONTH", "date_trunc('month', d) - INTERVAL 1 DAY"),
    "all": ("DATE '2020-01-01'", "d"),
}


@query(
    "i09_period_bounds",
    " UNION ALL ".join(
        f"""SELECT d::VARCHAR AS as_of, '{p}' AS period, CAST({lo} AS DATE)::VARCHAR AS first_day, CAST({hi} AS DATE)::VARCHAR AS last_day
            FROM (SELECT DISTINCT {DAY} AS d FROM orders)"""
        for p, (lo, hi) in _BOUNDS.items()
    ),
)
def i09(t: Tables):
    # every order day serves once as the run date
    days = t.orders.select(day().alias("as_of")).distinct()
    rows = []
    for name in dt.PERIODS:
        lo, hi = dt.period_bounds(name, F.col("as_of"))
        rows.append(F.struct(F.lit(name).alias("period"), lo.alias("first_day"), hi.alias("last_day")))
    return days.select("as_of", F.inline(F.array(*rows)))


@query(
    "i10_week_labels",
    f"""SELECT CAST(date_trunc('week', o_orderdate) AS DATE)::VARCHAR AS week_start, weekofyear(MIN(o_orderdate))::INT AS iso_week,
               strftime(date_trunc('week', MIN(o_orderdate)), '%d %b') AS week_label, COUNT(*) AS n FROM orders GROUP BY 1""",
)
def i10(t: Tables):
    weeks = t.orders.groupBy(dt.week_start("o_orderdate").alias("week_start")).agg(F.count(F.lit(1)).alias("n"))
    return weeks.select(
        "week_start", F.weekofyear("week_start").alias("iso_week"), F.date_format("week_start", "dd MMM").alias("week_label"), "n"
    )


@query(
    "i11_month_name",
    "SELECT monthname(o_orderdate) AS month_name, year(o_orderdate)::INT AS year, COUNT(*) AS n FROM orders GROUP BY 1, 2",
)
def i11(t: Tables):
    return t.orders.groupBy(dt.month_name("o_orderdate").alias("month_name"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "i12_fiscal",
    f"""SELECT (year({DAY}) + (month({DAY}) >= 10)::INT)::INT AS fiscal_year,
               (((month({DAY}) + 2) % 12) // 3 + 1)::INT AS fiscal_quarter, year({DAY})::INT AS plain_year,
               quarter({DAY})::INT AS plain_quarter, COUNT(*) AS n FROM orders GROUP BY ALL""",
)
def i12(t: Tables):
    return t.orders.groupBy(
        dt.fiscal_year("o_orderdate").alias("fiscal_year"),
        dt.fiscal_quarter("o_orderdate").alias("fiscal_quarter"),
        dt.fiscal_year("o_orderdate", 1).alias("plain_year"),
        dt.fiscal_quarter("o_orderdate", 1).alias("plain_quarter"),
    ).agg(F.count(F.lit(1)).alias("n"))


_Q = ", ".join(
    f"CASE WHEN o_orderstatus <> 'P' AND year({DAY}) = 2001 AND quarter({DAY}) = {q} THEN 'yes' ELSE 'no' END AS in_q{q}" for q in (1, 2, 3, 4)
)


@query("i13_quarter_flags", f"SELECT o_orderkey, {_Q} FROM orders")
def i13(t: Tables):
    known = F.when(F.col("o_orderstatus") != "P", day())
    return t.orders.select("o_orderkey", *[dt.quarter_flag(known, q, AS_OF).alias(f"in_q{q}") for q in (1, 2, 3, 4)])


@query(
    "i14_period_status",
    f"""SELECT CASE WHEN o_orderstatus = 'P' THEN NULL WHEN month({DAY}) <= 4 THEN 'janvier-avril' WHEN month({DAY}) <= 9 THEN 'mai-septembre'
               ELSE 'octobre-decembre' END AS status, COUNT(*) AS n FROM orders GROUP BY 1""",
)
def i14(t: Tables):
    known = F.when(F.col("o_orderstatus") != "P", day())
    return t.orders.groupBy(dt.period_status(known).alias("status")).agg(F.count(F.lit(1)).alias("n"))


_LAST = """(SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS visit, last_ship AS appt FROM orders
    LEFT JOIN (SELECT l_orderkey, CAST(MAX(l_shipdate) AS DATE) AS last_ship FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


def _last(t: Tables):
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("appt"))
    return t.orders.join(last, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", day().alias("visit"), "appt"
    )


@query(
    "i15_appointment_gap",
    f"""SELECT o_orderkey, CASE WHEN g BETWEEN 0 AND 35 THEN '0-35' WHEN g BETWEEN 36 AND 89 THEN '36-89' WHEN g BETWEEN 90 AND 120
          THEN '90-120' WHEN g BETWEEN 121 AND 180 THEN '121-180' WHEN g > 180 THEN '>180' END AS gap
        FROM (SELECT *, appt - visit AS g FROM {_LAST})""",
)
def i15(t: Tables):
    return _last(t).select("o_orderkey", dt.appointment_gap_bucket("visit", "appt").alias("gap"))


def _yn(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'yes' ELSE 'no' END"


_M = months_sql("appt", REF)


@query(
    "i16_lost_to_followup",
    f"""SELECT o_orderkey, {_yn(f"{REF} - appt > 30")} AS ltfu_over_30_days, {_yn(f"{_M} >= 1 AND {_M} < 6")} AS ltfu_1_to_6_months,
        {_yn(f"{_M} >= 6 AND {_M} < 12")} AS ltfu_6_to_12_months, {_yn(f"{_M} >= 6")} AS ltfu_over_6_months,
        {_yn(f"{_M} >= 12")} AS ltfu_over_12_months FROM {_LAST}""",
)
def i16(t: Tables):
    flags = dt.lost_to_followup_flags("appt", AS_OF)
    return _last(t).select("o_orderkey", *[c.alias(n) for n, c in flags.items()])


_NEXT = "CASE WHEN o_totalprice < 100000 THEN CAST(appt + INTERVAL 12 MONTH AS DATE) ELSE CAST(appt + INTERVAL 6 MONTH AS DATE) END"


@query(
    "i17_next_test",
    f"""SELECT o_orderkey, ({_NEXT})::VARCHAR AS next_test, CASE WHEN (appt IS NOT NULL AND {_NEXT} <= DATE '2000-06-30')
          OR (appt IS NULL AND CAST(visit + INTERVAL 6 MONTH AS DATE) <= DATE '2000-06-30') THEN 'YES' ELSE 'NO' END AS eligible
        FROM {_LAST}""",
)
def i17(t: Tables):
    low = F.col("o_totalprice") < 100000
    return _last(t).select(
        "o_orderkey",
        dt.next_test_date("appt", low).alias("next_test"),
        dt.test_eligible("appt", low, "visit", "2000-06-30").alias("eligible"),
    )


@query("i18_active_within", f"SELECT o_orderkey, {_yn(f'appt >= DATE {chr(39)}2000-12-01{chr(39)}')} AS active FROM {_LAST}")
def i18(t: Tables):
    return _last(t).select("o_orderkey", dt.active_within("appt", AS_OF).alias("active"))


@query(
    "i19_merged_delivery_date",
    f"""SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus = 'F' THEN appt END,
        CASE WHEN appt IS NULL THEN {due_sql('visit')} ELSE GREATEST(appt, {due_sql('visit')}) END)::VARCHAR AS delivery FROM {_LAST}""",
)
def i19(t: Tables):
    actual = F.when(F.col("o_orderstatus") == "F", F.col("appt"))
    merged = dt.merged_delivery_date(actual, "appt", dt.due_date("visit"))
    return _last(t).select("o_orderkey", merged.alias("delivery"))


_BORN, _TERM, _ON = "CASE WHEN o_orderstatus = 'F' THEN appt END", "o_totalprice > 400000", "DATE '2000-06-30'"


@query(
    "i20_pregnancy_status",
    f"""SELECT o_orderkey,
          CASE WHEN {months_sql('born', _ON)} < 24 THEN 'yes' WHEN term THEN 'no' WHEN {months_sql('appt', _ON)} < 24 THEN 'yes' ELSE 'no' END AS breastfeeding,
          CASE WHEN COALESCE(born BETWEEN CAST({_ON} - INTERVAL 5 MONTH AS DATE) AND {_ON}, FALSE) THEN 'no' WHEN term THEN 'no'
               WHEN {months_sql('visit', _ON)} < 9 OR COALESCE(born, {due_sql('visit')}) > {_ON} THEN 'yes' ELSE 'no' END AS pregnant
        FROM (SELECT *, {_BORN} AS born, {_TERM} AS term FROM {_LAST})""",
)
def i20(t: Tables):
    born = F.when(F.col("o_orderstatus") == "F", F.col("appt"))
    term = F.col("o_totalprice") > 400000
    return _last(t).select(
        "o_orderkey",
        dt.breastfeeding_status(born, F.col("appt"), term, "2000-06-30").alias("breastfeeding"),
        dt.pregnant_status(F.col("visit"), born, dt.due_date("visit"), term, "2000-06-30").alias("pregnant"),
    )


@query(
    "i21_reference_month",
    f"SELECT DISTINCT {DAY}::VARCHAR AS as_of, CAST(date_trunc('month', o_orderdate) - INTERVAL 13 MONTH AS DATE)::VARCHAR AS ref FROM orders",
)
def i21(t: Tables):
    days = t.orders.select(day().alias("as_of")).distinct()
    return days.select("as_of", dt.reference_month_last_year(F.col("as_of")).alias("ref"))


@query(
    "i30_extract_digits",
    "SELECT c_custkey, nullif(regexp_extract(c_name, '[0-9]+'), '') AS digits, nullif(regexp_extract(c_mktsegment, '[0-9]+'), '') AS none FROM customer",
)
def i30(t: Tables):
    return t.customer.select("c_custkey", tx.extract_digits("c_name").alias("digits"), tx.extract_digits("c_mktsegment").alias("none"))


@query(
    "i31_clean_username",
    """SELECT s_suppkey, upper(n_name[1]) || lower(n_name[2:]) || ' Site' || s_suppkey AS username FROM supplier
       JOIN nation ON n_nationkey = s_nationkey""",
)
def i31(t: Tables):
    rows = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    mail = F.concat(F.lower("n_name"), F.lit(".site"), F.col("s_suppkey").cast("string"), F.lit("@example.org"))
    return rows.select("s_suppkey", tx.clean_username(mail, "@example.org").alias("username"))


@query(
    "i32_capitalize_first",
    "SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS segment FROM customer",
)
def i32(t: Tables):
    return t.customer.select("c_custkey", tx.capitalize_first("c_mktsegment").alias("segment"))


_RAW_PHONE = """CASE c_custkey % 5 WHEN 0 THEN lpad(c_custkey::VARCHAR, 8, '3') WHEN 1 THEN '509' || lpad(c_custkey::VARCHAR, 8, '4')
    WHEN 2 THEN lpad(c_custkey::VARCHAR, 9, '5') WHEN 3 THEN '(' || lpad(c_custkey::VARCHAR, 4, '2') || ') 12-34'
    ELSE c_custkey::VARCHAR END"""


@query(
    "i33_format_phone",
    f"""SELECT c_custkey, CASE WHEN length(d) = 8 THEN '+509 ' || d[1:4] || ' ' || d[5:8]
          WHEN length(d) = 11 AND d[1:3] = '509' THEN '+509 ' || d[4:7] || ' ' || d[8:11]
          WHEN length(d) BETWEEN 9 AND 10 THEN '+509 ' || d[1:4] || ' ' || d[5:8] ELSE raw END AS phone
        FROM (SELECT c_custkey, raw, regexp_replace(raw, '[^0-9]', '', 'g') AS d FROM (SELECT c_custkey, {_RAW_PHONE} AS raw FROM customer))""",
)
def i33(t: Tables):
    text = F.col("c_custkey").cast("string")
    kind = F.col("c_custkey") % 5
    raw = (
        F.when(kind == 0, F.lpad(text, 8, "3"))
        .when(kind == 1, F.concat(F.lit("509"), F.lpad(text, 8, "4")))
        .when(kind == 2, F.lpad(text, 9, "5"))
        .when(kind == 3, F.concat(F.lit("("), F.lpad(text, 4, "2"), F.lit(") 12-34")))
        .otherwise(text)
    )
    return t.customer.select("c_custkey", tx.format_phone(raw).alias("phone"))


@query(
    "i34_normalize_text",
    r"""SELECT doc_id, md5(regexp_replace(strip_accents(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))), '[^\x00-\x7F]', '', 'g')) AS digest,
               length(text) AS n FROM documents""",
)
def i34(t: Tables):
    return t.documents.select("doc_id", F.md5(tx.normalize_text("text")).alias("digest"), F.length("text").cast("long").alias("n"))


@query(
    "i35_strip_label_code",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
              WHEN '4-NOT SPECIFIED' THEN 'Not Specified' WHEN '5-LOW' THEN 'Low' END AS label FROM orders""",
)
def i35(t: Tables):
    return t.orders.select("o_orderkey", tx.strip_label_code("o_orderpriority").alias("label"))


@query(
    "i36_site_from_code",
    "SELECT s_suppkey, s_name[1:8] AS start, split_part(s_name, '#', 1) AS before, trim(split_part('A ' || s_name, '#', 1)) AS trimmed FROM supplier",
)
def i36(t: Tables):
    return t.supplier.select(
        "s_suppkey",
        tx.site_from_code("s_name").alias("start"),
        tx.site_from_code("s_name", sep="#").alias("before"),
        tx.site_from_code(F.concat(F.lit("A "), "s_name"), sep="#").alias("trimmed"),
    )


ZONES = {"1": "North", "2": "West", "5": "North-West"}


@query(
    "i37_zone_from_prefix",
    """SELECT o_orderkey, CASE o_orderpriority[1] WHEN '1' THEN 'North' WHEN '2' THEN 'West' WHEN '5' THEN 'North-West' ELSE 'Autre' END AS zone FROM orders""",
)
def i37(t: Tables):
    return t.orders.select("o_orderkey", tx.zone_from_prefix("o_orderpriority", ZONES).alias("zone"))


@query(
    "i38_decode_lookup",
    """SELECT c_custkey, CASE c_nationkey WHEN 1 THEN 'male' WHEN 2 THEN 'female' WHEN 3 THEN 'unknown' ELSE c_nationkey::VARCHAR END AS label FROM customer""",
)
def i38(t: Tables):
    label = tx.decode("c_nationkey", {1: "male", 2: "female", 3: "unknown"}, keep_unknown=True)
    return t.customer.select("c_custkey", label.alias("label"))


@query(
    "i39_recode_values",
    "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'O') THEN 'F' ELSE o_orderstatus END AS sex FROM orders",
)
def i39(t: Tables):
    return t.orders.select("o_orderkey", tx.recode_values("o_orderstatus", ["P", "O"], "F").alias("sex"))


_LINE = "l_orderkey, l_linenumber, l_partkey, l_quantity"
_KIND = "CASE l_returnflag WHEN 'R' THEN 'MAS' WHEN 'A' THEN 'MAM' END"


@query(
    "i50_visits_remaining",
    f"""SELECT {_LINE}, GREATEST(raw, 0)::INT AS remaining, raw::INT AS unclipped FROM (SELECT *, CASE
          WHEN {_KIND} = 'MAM' AND l_quantity <= 12 THEN 8 - l_quantity WHEN {_KIND} = 'MAS' AND l_quantity <= 18 THEN 12 - l_quantity ELSE 0 END AS raw
        FROM lineitem)""",
)
def i50(t: Tables):
    kind = F.when(F.col("l_returnflag") == "R", "MAS").when(F.col("l_returnflag") == "A", "MAM")
    return t.lineitem.select(
        *_LINE.split(", "),
        bd.visits_remaining(kind, "l_quantity").alias("remaining"),
        bd.visits_remaining(kind, "l_quantity", clip=False).alias("unclipped"),
    )


@query(
    "i51_health_index",
    f"""SELECT {_LINE}, round(s, 6) AS score, CASE WHEN s <= 3 THEN 'low' WHEN s <= 6 THEN 'moderate' ELSE 'high' END AS risk FROM
        (SELECT *, (l_quantity * 0.25::DOUBLE + l_linenumber * 1.0::DOUBLE) / 22.0::DOUBLE * 10 AS s FROM lineitem)""",
)
def i51(t: Tables):
    score = bd.health_index({"l_quantity": 0.25, "l_linenumber": 1})
    return t.lineitem.select(*_LINE.split(", "), F.round(score, 6).alias("score"), bd.risk_band(score).alias("risk"))


@query(
    "i52_muac_class",
    f"""SELECT {_LINE}, CASE WHEN l_returnflag = 'N' THEN 'n/a' WHEN l_quantity / 2 < 11.5 THEN 'MAS' WHEN l_quantity / 2 < 12.5 THEN 'MAM'
          ELSE 'none' END AS class FROM lineitem""",
)
def i52(t: Tables):
    muac = F.when(F.col("l_returnflag") != "N", F.col("l_quantity") / 2)
    return t.lineitem.select(*_LINE.split(", "), bd.muac_class(muac).alias("class"))


@query(
    "i53_age_band_months",
    "SELECT p_partkey, CASE WHEN p_size * 1.5 < 6 THEN '<6' WHEN p_size * 1.5 < 24 THEN '6-23' WHEN p_size * 1.5 < 60 THEN '24-59' ELSE '60+' END AS band FROM part",
)
def i53(t: Tables):
    return t.part.select("p_partkey", bd.age_band_months(F.col("p_size") * 1.5).alias("band"))


@query(
    "i54_age_band_0_2_12",
    "SELECT p_partkey, CASE WHEN p_size <= 2 THEN '0-2' WHEN p_size <= 12 THEN '2-12' ELSE '+12' END AS band FROM part",
)
def i54(t: Tables):
    return t.part.select("p_partkey", bd.age_band_0_2_12("p_size").alias("band"))


@query(
    "i55_age_band_years",
    """SELECT p_partkey, CASE WHEN p_size < 1 THEN '< 1' WHEN p_size < 5 THEN '1 - 4' WHEN p_size < 10 THEN '5 - 9' WHEN p_size < 15 THEN '10 - 14'
              WHEN p_size < 18 THEN '15 - 17' WHEN p_size < 21 THEN '18 - 20' ELSE '21+' END AS band FROM part""",
)
def i55(t: Tables):
    return t.part.select("p_partkey", bd.age_band_years("p_size").alias("band"))


@query(
    "i56_safe_pct",
    """SELECT n_name, CASE WHEN den > 0 THEN round_even(num * 100.0::DOUBLE / den, 1) ELSE 0 END::DOUBLE AS pct FROM
       (SELECT n_name, COUNT(c_custkey) FILTER (c_acctbal < 0) AS num, COUNT(c_custkey) AS den FROM nation
        LEFT JOIN (SELECT * FROM customer WHERE c_nationkey > 4) ON c_nationkey = n_nationkey GROUP BY 1)""",
)
def i56(t: Tables):
    rows = t.nation.join(t.customer.where("c_nationkey > 4"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    counts = rows.groupBy("n_name").agg(
        F.count_if(F.col("c_acctbal") < 0).alias("num"), F.count("c_custkey").alias("den")
    )
    return counts.select("n_name", bd.safe_pct(F.col("num"), F.col("den")).alias("pct"))


@query(
    "i57_suppressed_flag",
    f"""SELECT {_LINE}, CASE WHEN l_returnflag = 'N' OR v < 1000 THEN 'OUI' WHEN v >= 1000 THEN 'NON' END AS suppressed FROM
        (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_quantity * 50 END AS v FROM lineitem)""",
)
def i57(t: Tables):
    count = F.when(F.col("l_linestatus") == "F", F.col("l_quantity") * 50)
    return t.lineitem.select(*_LINE.split(", "), bd.suppressed_flag(F.col("l_returnflag") == "N", count).alias("suppressed"))


_CASE_COLS = f"""{SHIP} AS shipped, {DAY} AS created, CASE WHEN l_returnflag = 'R' THEN {SHIP} END AS closed,
    CASE WHEN l_returnflag = 'A' THEN {SHIP} END AS graduated, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN {SHIP} END AS inactive,
    CASE WHEN l_linestatus = 'F' THEN 1 END AS is_inactive"""


@query(
    "i58_active_case",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN closed < DATE '1998-01-01' THEN 'no'
          WHEN created > DATE '1999-12-31' THEN 'no' WHEN graduated > DATE '1998-01-01' THEN 'yes' WHEN inactive > DATE '1998-01-01' THEN 'yes'
          WHEN inactive < DATE '1998-01-01' THEN 'no' WHEN graduated < DATE '1998-01-01' THEN 'no'
          WHEN COALESCE(is_inactive, 0) = 0 THEN 'yes' ELSE 'no' END AS active
        FROM (SELECT *, {_CASE_COLS} FROM {_PAIR})""",
)
def i58(t: Tables):
    ship, flag, state = F.to_date("l_shipdate"), F.col("l_returnflag"), F.col("l_linestatus")
    none = F.lit(None)
    active = bd.active_case(
        "1998-01-01",
        "1999-12-31",
        closed=F.when(flag == "R", ship),
        created=day(),
        graduated=F.when(flag == "A", ship),
        abandoned=none.cast("date"),
        inactive=F.when((state == "O") & (flag == "N"), ship),
        is_inactive=F.when(state == "F", 1),
        is_graduated=none.cast("int"),
    )
    return _pairs(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", active.alias("active"))


@query(
    "i58_active_group",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_returnflag IN ('X', 'A') THEN 'no' WHEN closed < DATE '1998-01-01' THEN 'no'
          WHEN created > DATE '1999-12-31' THEN 'no' WHEN inactive > DATE '1998-01-01' THEN 'yes' WHEN inactive < DATE '1998-01-01' THEN 'no'
          WHEN COALESCE(is_inactive, 0) = 0 THEN 'yes' ELSE 'no' END AS active
        FROM (SELECT *, {_CASE_COLS} FROM {_PAIR})""",
)
def i58_group(t: Tables):
    ship, flag, state = F.to_date("l_shipdate"), F.col("l_returnflag"), F.col("l_linestatus")
    active = bd.active_group(
        "1998-01-01",
        "1999-12-31",
        office=flag,
        excluded=["X", "A"],
        closed=F.when(flag == "R", ship),
        created=day(),
        graduated=F.when(flag == "A", ship),
        inactive=F.when((state == "O") & (flag == "N"), ship),
        is_inactive=F.when(state == "F", 1),
        is_graduated=F.lit(None).cast("int"),
    )
    return _pairs(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", active.alias("active"))


@query(
    "i59_period_eligible",
    f"""SELECT o_orderkey, {_yn(f"o_custkey IN (1, 5, 6) AND {DAY} BETWEEN DATE '1997-05-01' AND DATE '2000-10-30'")} AS eligible FROM orders""",
)
def i59(t: Tables):
    eligible = bd.period_eligible("o_custkey", "o_orderdate", [1, 5, 6], "1997-05-01", "2000-10-30")
    return t.orders.select("o_orderkey", eligible.alias("eligible"))


@query(
    "i60_pick_reason",
    """SELECT o_orderkey, CASE WHEN r > 0 THEN 'returned' WHEN a > 0 THEN 'accepted' WHEN n > 0 THEN 'none' ELSE 'no_info' END AS reason FROM orders
       LEFT JOIN (SELECT l_orderkey, COUNT(*) FILTER (l_returnflag = 'R') AS r, COUNT(*) FILTER (l_returnflag = 'A') AS a,
                  COUNT(*) FILTER (l_returnflag = 'N') AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def i60(t: Tables):
    counts = t.lineitem.groupBy("l_orderkey").agg(
        *[F.count_if(F.col("l_returnflag") == f).alias(f.lower()) for f in ("R", "A", "N")]
    )
    rows = t.orders.join(counts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.select("o_orderkey", bd.pick_reason({"returned": "r", "accepted": "a", "none": "n"}).alias("reason"))
