"""Missing values, tie breaks, bounds and argument checks on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldcohort.functions import bands, dates, nulls, text
from fieldcohort.operators import aggregate, clean, filters, joins, latest
from fieldcohort.plans import viral_load

D = dt.date


def values(df, col):
    return [r[col] for r in df.orderBy(*df.columns).collect()]


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def lit_date(s):
    return F.lit(s).cast("date")


def test_r1_r2_r3_exclusions_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert set(values(filters.not_equal_keep_null(df, "c", "a"), "c")) == {"b", None}
    assert set(values(filters.exclude_values(df, "c", ["a"]), "c")) == {"b", None}
    assert values(filters.exclude_on_alias(df, c=["a"]), "c") == ["b"]


def test_r5_null_keys_form_no_group(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, v int")
    rows = {r.k: r.n for r in aggregate.count_by(df, "k").collect()}
    assert rows == {"a": 2, "Total": 2}
    assert [r.k for r in aggregate.conditional_counts(df, "k", {"n": F.col("v") > 0}).collect()] == ["a"]


def test_r6_null_keys_match_only_on_request(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert sorted(r.w for r in joins.equi_join(left, right, "k").collect()) == [20]
    assert sorted(r.w for r in joins.equi_join(left, right, "k", null_safe=True).collect()) == [10, 20]
    assert set(values(joins.anti_join(left, right, "k"), "k")) == {None}


def test_r7_first_skips_null_in_declared_order(spark):
    df = spark.createDataFrame(
        [("k", D(2020, 1, 2), "late", 1), ("k", D(2020, 1, 1), None, 2), ("k", D(2020, 1, 1), "early", 3)],
        "k string, d date, t string, n int",
    )
    row = aggregate.collapse_keep_all(df, "k", ["d", "n"]).first()
    assert (row.t, row.n, row.d) == ("early", 6, D(2020, 1, 2))


def test_r8_dedupe_first_and_last(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 2, "y"), (None, 3, "z")], "k string, n int, t string")
    assert sorted(values(latest.dedupe_keep(df, "k", ["n"]), "t")) == ["x", "z"]
    assert sorted(values(latest.dedupe_keep(df, "k", ["n"], "last"), "t")) == ["y", "z"]
    with pytest.raises(ValueError):
        latest.dedupe_keep(df, "k", ["n"], "any")


def test_r10_row_max_skips_null(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), None), (None, None)], "a date, b date")
    assert set(values(clean.row_max_date(df, "m", "a", "b"), "m")) == {D(2020, 1, 1), None}


def test_r11_half_even_ages(spark):
    assert one(spark, F.bround(F.lit(2.5))) == 2
    assert one(spark, dates.age_years_rounded(lit_date("2018-01-01"), "2021-01-01")) == 3
    assert one(spark, dates.age_years_rounded(F.lit(None).cast("date"), "2021-01-01")) == 0
    assert one(spark, dates.age_months_rounded(F.lit(None).cast("date"), "2021-01-01")) == 0


def test_r12_complete_months(spark):
    pairs = {("2024-01-31", "2024-02-29"): 0, ("2024-01-31", "2024-03-31"): 2, ("2024-03-31", "2024-01-31"): -2, ("2024-02-29", "2024-01-31"): 0}
    for (a, b), months in pairs.items():
        assert one(spark, dates.complete_months(lit_date(a), lit_date(b))) == months


def test_r13_weeks_start_on_monday_across_new_year(spark):
    assert one(spark, dates.week_start(lit_date("2025-01-01"))) == D(2024, 12, 30)
    assert one(spark, dates.week_start(lit_date("2024-12-30"))) == D(2024, 12, 30)


def test_r15_last_day_counts_in_full(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59),), (dt.datetime(2024, 2, 1),), (None,)], "ts timestamp")
    assert filters.between_dates(df, "ts", "2024-01-01", "2024-01-31").count() == 1
    assert filters.last_n_days(df, "ts", 7, "2024-01-31").count() == 1
    assert filters.future_rows(df, "ts", "2024-01-31").count() == 1


@pytest.mark.parametrize(
    "as_of, name, lo, hi",
    [
        ("2024-02-29", "previous_month", D(2024, 1, 1), D(2024, 1, 31)),
        ("2024-01-31", "previous_month", D(2023, 12, 1), D(2023, 12, 31)),
        ("2024-12-31", "current_month", D(2024, 12, 1), D(2024, 12, 31)),
        ("2024-01-01", "current_week", D(2024, 1, 1), D(2024, 1, 7)),
        ("2024-01-01", "previous_week", D(2023, 12, 25), D(2023, 12, 31)),
        ("2024-02-29", "last_3_months", D(2023, 11, 1), D(2024, 1, 31)),
        ("2024-02-29", "all", D(2020, 1, 1), D(2024, 2, 29)),
    ],
)
def test_period_bounds(spark, as_of, name, lo, hi):
    start, end = dates.period_bounds(name, as_of)
    assert (one(spark, start), one(spark, end)) == (lo, hi)


def test_period_bounds_unknown_name():
    with pytest.raises(ValueError, match="unknown period"):
        dates.period_bounds("fortnight", "2024-01-01")


def test_dates_from_dirty_text(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("---",), ("",), (None,)], "d string")
    assert set(values(clean.to_date_coerce(df, ["d"]), "d")) == {D(2024, 2, 29), None}
    assert one(spark, dates.to_date_or_null(F.lit("31/01/2024"), "dd/MM/yyyy")) == D(2024, 1, 31)
    assert one(spark, dates.to_date_or_null(F.lit("31/13/2024"), "dd/MM/yyyy")) is None


def test_blank_marks(spark):
    df = spark.createDataFrame([(x,) for x in ("---", "//", "", "0", "0000-00-00", "ok", None)], "c string")
    assert [v for v in values(clean.sentinel_to_null(df, ["c"]), "c") if v] == ["ok"]
    assert one(spark, nulls.blank_to_null(F.lit("x"), ["x"])) is None


def test_fill_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None)], "d date, n int, t string, x double")
    row = clean.fill_missing_by_type(df).first()
    assert tuple(row) == (D(1901, 1, 1), 0, "no_info", 0.0)


def test_due_date_clamps_at_month_end(spark):
    assert one(spark, dates.due_date(lit_date("2024-05-31"))) == D(2025, 3, 7)
    assert one(spark, dates.due_date(F.lit(None).cast("date"))) is None


def test_fiscal_calendar(spark):
    for day, year, quarter in (("2024-09-30", 2024, 4), ("2024-10-01", 2025, 1), ("2025-01-01", 2025, 2)):
        assert one(spark, dates.fiscal_year(lit_date(day))) == year
        assert one(spark, dates.fiscal_quarter(lit_date(day))) == quarter


def test_unknowns_stay_unknown(spark):
    null_date = F.lit(None).cast("date")
    assert one(spark, dates.period_status(null_date)) is None
    assert one(spark, dates.appointment_gap_bucket(null_date, lit_date("2024-01-01"))) is None
    assert one(spark, dates.trimester(null_date, "2024-01-01")) == "Inconnu"
    assert one(spark, bands.suppressed_flag(F.lit(None).cast("boolean"), F.lit(None).cast("int"))) is None
    assert one(spark, dates.age_flag(null_date, "2024-01-01")) == "no"
    assert one(spark, bands.muac_class(F.lit(None).cast("double"))) == "n/a"


def test_bands_at_their_edges(spark):
    muac = {11.4: "MAS", 11.5: "MAM", 12.4: "MAM", 12.5: "none"}
    assert {k: one(spark, bands.muac_class(F.lit(k))) for k in muac} == muac
    years = {0.5: "< 1", 1: "1 - 4", 17: "15 - 17", 20: "18 - 20", 21: "21+"}
    assert {k: one(spark, bands.age_band_years(F.lit(k))) for k in years} == years
    assert one(spark, bands.age_band_years(F.lit(None).cast("int"))) is None


def test_visits_remaining_clip(spark):
    kind, done = F.lit("MAM"), F.lit(10)
    assert one(spark, bands.visits_remaining(kind, done)) == 0
    assert one(spark, bands.visits_remaining(kind, done, clip=False)) == -2
    assert one(spark, bands.visits_remaining(F.lit(None).cast("string"), done)) == 0


def test_active_case_first_rule_wins(spark):
    null_date, null_int = F.lit(None).cast("date"), F.lit(None).cast("int")
    base = dict(closed=null_date, created=null_date, graduated=null_date, abandoned=null_date, inactive=null_date, is_inactive=null_int, is_graduated=null_int)

    def active(**kw):
        return one(spark, bands.active_case("2024-01-01", "2024-12-31", **{**base, **kw}))

    assert active() == "yes"
    assert active(closed=lit_date("2023-12-31"), graduated=lit_date("2024-05-01")) == "no"
    assert active(graduated=lit_date("2024-05-01"), inactive=lit_date("2023-01-01")) == "yes"
    assert active(inactive=lit_date("2023-01-01")) == "no"
    assert active(is_inactive=F.lit(1)) == "no"


def test_text_functions(spark):
    assert one(spark, text.normalize_text(F.lit("  Élève  DÉJÀ\tvu — 漢 "))) == "eleve deja vu  "
    assert one(spark, text.normalize_text(F.lit("éte"), ascii_only=False)) == "ete"
    assert one(spark, text.extract_digits(F.lit("agent12b3"))) == "12"
    assert one(spark, text.extract_digits(F.lit("agent"))) is None
    assert one(spark, text.clean_username(F.lit("marie.paul@x.org"), "@x.org")) == "Marie Paul"
    assert one(spark, text.strip_label_code(F.lit("12-not_specified"))) == "Not Specified"
    assert one(spark, text.zone_from_prefix(F.lit(None).cast("string"), {"1": "N"})) == "Autre"
    phones = {"34567890": "+509 3456 7890", "50934567890": "+509 3456 7890", "345678901": "+509 3456 7890", "123": "123"}
    assert {k: one(spark, text.format_phone(F.lit(k))) for k in phones} == phones


def test_columns_and_names(spark):
    df = spark.createDataFrame([(1, 2)], ["form.a b", "form.c"])
    assert clean.strip_name_prefix(df, "form.").columns == ["a_b", "c"]
    assert clean.select_existing(df, ["form.c", "ghost"]).columns == ["form.c"]
    with pytest.raises(ValueError, match="missing columns: x, y"):
        clean.require_columns(df, ["form.c", "x", "y"])
    with pytest.raises(ValueError, match="operator"):
        clean.flag_threshold(df, "form.c", "f", 1, op="~")


def test_rows_are_the_form_for_many_values(spark, monkeypatch):
    monkeypatch.setattr(clean, "WIDE", 3)
    wide = spark.createDataFrame([(i, f"V {i % 5}" if i else None, "a b a aucun" if i else "aucun") for i in range(10)], "id int, v string, t string")
    with pytest.raises(ValueError, match="more than 3 values"):
        clean.one_hot(wide, "v")
    assert clean.vocabulary(wide, "t") == ["a b a aucun", "aucun"]
    long = clean.one_hot(wide, "v", dummy_null=True, as_rows=True).collect()
    assert {(r.id, r.flag) for r in long} == {(i, f"v_v_{i % 5}" if i else "v_null") for i in range(10)}
    words = spark.createDataFrame([(1, "x1 x2 x2"), (2, "x3 x4"), (3, "aucun"), (4, "aucun x1"), (5, None)], "id int, t string")
    flags = {(r.id, r.flag) for r in clean.multi_label_flags(words, "t", as_rows=True).collect()}
    assert flags == {(1, "x1"), (1, "x2"), (2, "x3"), (2, "x4"), (3, "aucun"), (4, "x1"), (5, None)}


def test_undeclared_values_are_counted_as_other(spark):
    rows = [("jan", "x", "f", 1), ("jan", "y", "g", 2), ("jan", "z", "f", 3), ("feb", "z", "g", 4), ("feb", None, "f", 5)]
    df = spark.createDataFrame(rows, "m string, c string, s string, v int")
    table = {r.m: r for r in aggregate.crosstab(df, F.col("m"), "m", "c", ["x", "y"]).collect()}
    assert (table["feb"].other, table["feb"].total, table["Total"].total, table["Total"].other) == (1, 1, 4, 2)
    pivot = {r.m: r for r in aggregate.pivot_margins(df, F.col("m"), "m", [("c", ["x", "y"]), ("s", ["f"])]).collect()}
    assert (pivot["jan"].x_f, pivot["jan"].other, pivot["feb"].total, pivot["Total"].total) == (1, 2, 1, 4)
    heat = {r.m: r.other for r in aggregate.heatmap_matrix(df, "m", "c", ["x"], F.col("v")).collect()}
    assert heat == {"jan": 5, "feb": 9}
    bands = {r.band: (r.f, r.other) for r in aggregate.age_pyramid(df, F.when(F.col("v") < 3, "low"), "s", ["f"]).collect()}
    assert bands == {"low": (1, 1), "other": (2, 1)}


def test_two_values_of_one_name_are_refused(spark):
    df = spark.createDataFrame([("A-b",), ("a b",)], "v string")
    with pytest.raises(ValueError, match="same column name: v_a_b"):
        clean.one_hot(df, "v")
    with pytest.raises(ValueError, match="same column name"):
        aggregate.crosstab(df, F.col("v"), "total", "v", ["x"])


def test_one_hot_and_labels_find_their_values(spark):
    df = spark.createDataFrame([("fever cough",), ("Aucun",), ("aucun fever",), (None,)], "s string")
    rows = {r.s: (r.aucun, r.cough, r.fever) for r in clean.multi_label_flags(df, "s").collect()}
    assert rows == {"fever cough": (0, 1, 1), "Aucun": (1, 0, 0), "aucun fever": (0, 0, 1), None: (0, 0, 0)}
    hot = clean.one_hot(df, "s", ["Aucun"], dummy_null=True)
    assert {(r.s, r.s_aucun, r.s_null) for r in hot.collect()} >= {("Aucun", 1, 0), (None, 0, 1)}


def test_probe_counts_without_a_job(spark):
    df, seen = clean.probe(spark.range(10).where("id > 3"), "step")
    df.collect()
    assert seen.get["rows"] == 6


def test_match_flag_repeats_only_without_dedupe(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, n int")
    assert joins.match_flag_join(left, right, "k", "m").count() == 4
    one_each = joins.match_flag_join(left, right, "k", "m", dedupe_right=[F.col("n").desc()])
    assert {(r.k, r.n, r.m) for r in one_each.collect()} == {("a", 2, "yes"), ("b", None, "no"), (None, None, "no")}


def test_partition_is_complete_and_disjoint(spark):
    people = spark.range(20).withColumnRenamed("id", "k")
    out = joins.status_partition(people, "k", [("a", people.where("k < 8")), ("b", people.where("k < 12"))], "c")
    assert {r.status: r["count"] for r in out.groupBy("status").count().collect()} == {"a": 8, "b": 4, "c": 8}


def test_attrition_never_grows(spark):
    df = spark.range(100)
    steps = [("even", F.col("id") % 2 == 0), ("unknown", F.when(F.col("id") > 10, True)), ("small", F.col("id") < 50)]
    left = [r.rows_left for r in filters.attrition(df, steps).orderBy("step").collect()]
    assert left == sorted(left, reverse=True)
    assert left[-1] == filters.sequential_filter(df, steps).count()


def test_pivot_total_is_the_sum_of_its_parts(spark):
    df = spark.range(100).selectExpr("cast(id % 7 as string) r", "cast(id % 3 as string) c", "id % 2 f")
    table = aggregate.pivot_margins(df, F.col("r"), "r", [("c", ["0", "1", "2"]), ("f", [0, 1])]).collect()
    total = next(r for r in table if r.r == "Total")
    for col in table[0].__fields__[1:]:
        assert total[col] == sum(r[col] for r in table if r.r != "Total")
    assert all(r.total == sum(r[c] for c in table[0].__fields__[1:-1]) for r in table)


def test_hot_key_statistics(spark):
    # one key has a third of all rows, the others a few each
    df = spark.range(6000).selectExpr("if(id % 3 = 0, -1, id) k", "id v")
    out = latest.count_over_key(df, "k", "n")
    assert out.count() == 6000
    assert {r.n for r in out.where("k = -1").select("n").distinct().collect()} == {2000}
    assert {r.n for r in out.where("k <> -1").select("n").distinct().collect()} == {1}


def test_hot_and_missing_keys_keep_their_rows(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 1), ("b", 2)], "k string, v int")
    rows = latest.with_key_stats(df, "k", {"n": F.count("v")}).collect()
    assert len(rows) == 52
    assert {(r.k, r.n) for r in rows} == {("a", 50), ("b", 1), (None, None)}


def test_ranking_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 5 k", "id v")
    plan = latest.latest_per_key(df, "k", [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_cascade_stages_are_nested(spark):
    rows = [
        (5, D(2000, 1, 1), D(2001, 6, 1), "OUI", "NO"),
        (5, D(2000, 1, 1), D(2001, 6, 1), None, "YES"),
        (5, D(2000, 1, 1), None, "OUI", "NO"),
        (5, None, D(2001, 6, 1), "OUI", "NO"),
        (40, D(2000, 1, 1), D(2001, 6, 1), "OUI", "NO"),
    ]
    df = spark.createDataFrame(rows, "age int, arv_start_date date, last_viral_load_collection_date date, suppressed string, eligibility string")
    for split in (False, True):
        out = viral_load.viral_load_cascade(df, "2001-12-01", split_no_result=split).orderBy("step").collect()
        n = [r.n for r in out]
        assert n == sorted(n, reverse=True) and n[0] == 4
        assert n == ([4, 3, 1, 1] if split else [4, 3, 2, 1])


def test_sibling_stages_are_nested(spark):
    rows = [
        ("c1", "3", 5, "1", "positif", "1"),
        ("c1", "3", 6, "2", None, "1"),
        ("c2", "3", 7, "2", None, None),
        ("c3", "3", 8, "1", None, "1"),
        ("c4", "1", 8, "1", "positif", "1"),
        ("c5", "3", 30, "1", "positif", "1"),
        ("c6", "3", 3, "2", None, "0"),
    ]
    df = spark.createDataFrame(rows, "caseid string, infant_relationship string, age_in_year int, hiv_test string, hiv_test_result string, is_accepted string")
    n = {r.stage: r.n for r in viral_load.sibling_testing_cascade(df).collect()}
    assert n == {"total": 4, "tested": 2, "negative": 0, "unknown": 1, "positive": 1, "untested": 1}


def test_period_compare_and_empty_base(spark):
    df = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 8, 9, 10)], "d date")
    row = aggregate.period_compare(df, "d", "2024-01-08", "2024-01-14").first()
    assert (row.current_n, row.previous_n, row.pct_change) == (3, 2, 50.0)
    row = aggregate.period_compare(df, "d", "2024-01-01", "2024-01-07").first()
    assert (row.current_n, row.previous_n, row.pct_change) == (2, 0, 0.0)


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(D(2020, 1, 1),), (D(2030, 1, 1),), (None,)], "d date")
    out = clean.clamp_dates(df, "d", "2021-01-01", "2022-12-31")
    assert set(values(out, "d")) == {D(2021, 1, 1), D(2022, 12, 31), None}


def test_later_rule_overrides(spark):
    df = spark.range(3)
    out = clean.case_last_wins(df, "x", [(F.col("id") >= 0, "a"), (F.col("id") >= 1, "b")], "none")
    assert values(out, "x") == ["a", "b", "b"]
