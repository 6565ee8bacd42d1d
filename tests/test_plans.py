"""What the plans promise: pushed filters, pruned columns, one scan, early cuts."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fieldcohort.operators import aggregate, filters, joins, latest, partials, skew

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Scans in the optimized plan, before any reuse."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


def test_date_windows_reach_the_scan(orders):
    text = plan(filters.between_dates(orders, "o_orderdate", "1997-01-01", "1997-12-31").select("o_orderkey"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", text)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_optional_filters_read_only_their_columns(orders):
    text = plan(filters.dashboard_filter(orders, office=("o_orderstatus", "F")).select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text and "o_totalprice" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize("n", [1, 2])
def test_ranking_cuts_before_the_exchange(orders, n):
    text = plan(latest.top_n_per_key(orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey")], n, "r"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_totals_do_not_read_or_expand_the_detail(orders):
    table = aggregate.crosstab(orders, F.col("o_orderpriority"), "priority", "o_orderstatus", ["F", "O", "P"])
    assert scans(table) == 1
    text = plan(table)
    assert text.index("Expand") < text.rindex("Exchange")
    assert scans(aggregate.count_by(orders, "o_orderpriority")) == 1


def test_sources_on_one_table_are_read_once(spark, orders):
    sources = {
        "all": (orders, "o_orderdate", None),
        "urgent": (orders, "o_orderdate", F.col("o_orderpriority") == "1-URGENT"),
    }
    matrix = joins.presence_matrix(None, "o_custkey", sources, {"y": ("1997-01-01", "1997-12-31")})
    assert scans(matrix) == 1


def test_only_bounded_sides_are_hinted(spark):
    """Broadcast hints stand only where a bound is proven."""
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "fieldcohort")
    hinted = []
    for folder, _, files in os.walk(root):
        for name in files:
            if name.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    hinted += [line.strip() for line in f if "broadcast(" in line]
    bounded = (
        "F.broadcast(large)",  # at most a thousand groups
        "F.broadcast(across)",  # at most a thousand keys, and as many the other way
        "mark = F.broadcast(often",  # at most a thousand keys
        "F.broadcast(filters)",  # one row of 4 kB per bucket
    )
    assert len(hinted) == len(bounded) and all(any(b in line for line in hinted) for b in bounded)


@pytest.mark.parametrize("name", ["k13_session_detail", "f07_first_last_at_levels", "l01_exact_duplicate_groups"])
def test_no_window_over_whole_groups(spark, name):
    text = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"^[\s:+|-]*Window \[(.*)", text, re.M)
    assert all("row_number" in w or "_n" in w for w in windows)


@pytest.fixture
def hot(spark, monkeypatch):
    """Persons 0 and 1 hold most episodes and events; parts are small."""
    monkeypatch.setattr(skew, "PART_ROWS", 20)
    episodes = spark.sql("select id, if(id % 3 < 2, id % 2, id) person, date_add('2024-01-01', cast(id % 200 as int)) start from range(150)")
    events = spark.sql("select id event, if(id % 4 < 3, id % 2, id) person, date_add('2024-01-01', cast(id * 7 % 260 as int)) day from range(400)")
    loose = "select id, cast(null as bigint) person, date('2024-01-01') start from range(1000, 1003) union all select id, 0L, cast(null as date) from range(1003, 1005)"
    return episodes.unionByName(spark.sql(loose)), events.unionByName(spark.sql("select 900L event, 0L person, cast(null as date) day"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join_of_hot_people_equals_the_plain_join(hot, how):
    episodes, events = hot
    window = (F.col("start"), F.date_add("start", 40))
    assert not skew.frequent_keys(events, ["person"], "parts").isEmpty()
    found = joins.interval_join(episodes, events, "person", "day", windows=[window, window], how=how)
    plain = episodes.join(events, (episodes.person == events.person) & F.col("day").between(*window), how).drop(events.person)
    rows = lambda df: sorted(map(str, df.select("id", "person", "start", "event", "day").collect()))
    assert rows(found) == rows(plain) and found.count() > 1000


def test_daily_totals_meet_as_the_events_do(hot):
    episodes, events = hot
    window = (F.col("start"), F.date_add("start", 1))
    events = events.withColumn("value", F.when(F.col("event") % 5 > 0, F.col("event") * 1.0)).withColumn("day", F.when(F.col("event") % 9 > 0, F.date_add(F.lit("2024-01-03"), F.col("event").cast("int") % 2)))
    measures = [F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0.0)).alias("total")]
    single = joins.interval_join(episodes, events, "person", "day", windows=[window])
    plain = single.groupBy("id").agg(F.count("value").alias("n"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))
    daily = joins.daily_totals(events, "person", "day", n=F.count("value"), total=F.sum("value"))
    met = joins.interval_join(episodes, daily, "person", "day", windows=[window])
    assert sorted(map(tuple, met.groupBy("id").agg(*measures).collect())) == sorted(map(tuple, plain.collect()))
    assert met.count() <= 2 * episodes.count() and single.count() > 3 * met.count() / 2


def test_a_person_of_many_episodes_is_joined_by_bins(hot, monkeypatch):
    episodes, events = hot
    few = events.where("event < 24")
    assert skew.frequent_keys(few, ["person"], "parts").isEmpty()
    met = []
    binned = joins.binned_join
    monkeypatch.setattr(joins, "binned_join", lambda *a: met.append(a) or binned(*a))
    window = (F.col("start"), F.date_add("start", 40))
    found = joins.interval_join(episodes, few, "person", "day", windows=[window])
    plain = episodes.join(few, (episodes.person == few.person) & F.col("day").between(*window), "left").drop(few.person)
    rows = lambda df: sorted(map(str, df.select("id", "person", "start", "event", "day").collect()))
    assert met and rows(found) == rows(plain)


def test_grid_join_leaves_no_large_cell(hot):
    episodes, events = hot
    met = skew.grid_join(episodes.drop("start"), events.drop("day"), "person")
    plain = episodes.drop("start").join(events.drop("day"), "person")
    assert sorted(map(tuple, met.select("id", "person", "event").collect())) == sorted(map(tuple, plain.select("id", "person", "event").collect()))
    text = plan(met)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    parts = skew.frequent_keys(events, ["person"], "parts").collect()
    assert {r.person for r in parts} == {0, 1} and all(r.parts >= 5 for r in parts)


def test_pairs_are_counted_without_making_them(hot):
    episodes, events = hot
    found = {r.person: r.n for r in joins.pair_counts(episodes, events, F.col("person"), F.col("person"), "person", "n").collect()}
    plain = episodes.join(events, "person").groupBy("person").count().collect()
    assert found == {r.person: r["count"] for r in plain}


def test_a_second_period_set_reads_no_detail(spark, tmp_path):
    events = spark.sql("select id, id % 37 - 5 user, if(id % 11 = 0, null, date_add('2024-01-01', cast(id % 90 as int))) day, id % 3 = 0 bad, cast(id % 2 as string) office from range(2000)")
    path = f"{tmp_path}/daily"
    distinct = {"users": (F.col("user"), None), "bad_users": (F.col("user") * 40_000, F.col("bad"))}
    partials.write_partials(partials.daily_partials(events, "day", {"n": F.lit(True), "bad": F.col("bad")}, distinct, by=F.col("office")), path)
    daily = partials.read_partials(spark, path)
    for spans in ({"jan": ("2024-01-01", "2024-01-31"), "all": None}, {"one": ("2024-02-03", "2024-02-03"), "two": ("2024-02-01", "2024-03-10")}):
        found = partials.period_measures(daily, spans, ["by"])
        text = plan(found)
        assert "Range" not in text and path.split("/")[-2] in text
        want = set()
        for name, span in spans.items():
            rows = events if span is None else events.where(F.col("day").between(*span))
            for r in rows.groupBy("office").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), F.count_distinct("user").alias("users"), F.count_distinct(F.when(F.col("bad"), F.col("user"))).alias("bad_users")).collect():
                want |= {(name, r.office, m, r[m]) for m in ("n", "bad", "users", "bad_users")}
        assert {(r.period, r.by, r.measure, r.n) for r in found.collect()} - {x for x in want if x[3] == 0} <= want
        assert {x for x in want if x[3]} <= {(r.period, r.by, r.measure, r.n) for r in found.collect()}
    none = partials.daily_partials(events.limit(0), "day", {"n": F.lit(True)}, distinct)
    assert partials.period_measures(none, {"all": None}).count() == 0
