"""Files in and out, snapshots, and incremental jobs with late and repeated rows."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcohort import session
from fieldcohort.operators import aggregate, latest
from fieldcohort.plans import dashboards
from fieldcohort.sources import tables
from fieldcohort.streaming import buckets, jobs

EVENT = "id BIGINT, ts TIMESTAMP, k STRING, v INT"


def events(spark, rows):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(ts), k, v) for i, ts, k, v in rows], EVENT)


def test_newest_dated_file_up_to_the_run_date(spark, tmp_path):
    for day in ("2024-01-31", "2024-02-29", "2024-03-05"):
        tables.write_table(spark.createDataFrame([(day,)], "d string"), f"{tmp_path}/case list {day}.parquet")
    assert tables.load_latest_dated(spark, str(tmp_path), "case list", "2024-03-01").first().d == "2024-02-29"
    with pytest.raises(FileNotFoundError):
        tables.load_latest_dated(spark, str(tmp_path), "case list", "2023-01-01")
    with pytest.raises(FileNotFoundError):
        tables.load_latest_dated(spark, str(tmp_path), "other", "2024-03-01")


def test_feed_pages_are_read_whole_and_once(spark, tmp_path):
    pages = [[{"id": 1, "name": "a"}, {"id": 2, "name": "b"}], [{"id": 2, "name": "b"}, {"id": 3}], []]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps({"value": page, "@odata.nextLink": f"p{i}"}, indent=1))
    record = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    rows = tables.read_paged_json(spark, str(tmp_path), record, "id", ["name"]).collect()
    assert sorted((r.id, r.name) for r in rows) == [(1, "a"), (2, "b"), (3, None)]


FEED = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def land(folder, link, ids, then=None, delta=None):
    page = {"link": link, "value": [{"id": i, "name": f"n{i}"} for i in ids], "@odata.nextLink": then, "@odata.deltaLink": delta}
    (folder / f"page {link}.json").write_text(json.dumps({k: v for k, v in page.items() if v is not None}, indent=1))


def test_new_pages_are_read_once_and_missing_ones_named(spark, tmp_path):
    folder, ledger = tmp_path / "feed", f"{tmp_path}/ledger"
    folder.mkdir()

    def run():
        return sorted(r.id for r in tables.read_new_pages(spark, str(folder), FEED, "id", ["name"], "a", ledger).collect())

    land(folder, "a", [1, 2], then="b")
    land(folder, "c", [4], delta="d")
    with pytest.raises(ValueError, match="missing: b"):
        run()
    assert tables.page_ledger(spark, ledger).count() == 0
    land(folder, "b", [2, 3], then="c")
    assert run() == [1, 2, 3, 4]
    assert run() == []
    for page in folder.iterdir():  # old pages are not opened again
        page.write_text("no json")
    land(folder, "e", [7], delta="f")
    with pytest.raises(ValueError, match="no link leads to these pages: e"):
        run()
    land(folder, "d", [5, 6], then="e")
    assert run() == [5, 6, 7]
    assert {(r.link, r.records) for r in tables.page_ledger(spark, ledger).collect()} == {("a", 2), ("b", 2), ("c", 1), ("d", 2), ("e", 1)}


def test_only_committed_snapshots_are_read(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/snap"
    frame = lambda n: spark.createDataFrame([(i,) for i in range(n)], "n int")
    assert tables.snapshot_write(frame(3), path, "2024-01-01")
    # a writer that dies before its commit leaves files that nobody reads
    real = tables.commits.write
    monkeypatch.setattr(tables.commits, "write", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.snapshot_write(frame(9), path, "2024-01-09")
    monkeypatch.setattr(tables.commits, "write", real)
    assert tables.snapshot_read_latest(spark, path).count() == 3
    # another writer of the day commits while this one writes
    def late(*args, **options):
        monkeypatch.setattr(tables.commits, "write", real)
        assert tables.snapshot_write(frame(5), path, "2024-01-09")
        return real(*args, **options)

    monkeypatch.setattr(tables.commits, "write", late)
    assert not tables.snapshot_write(frame(4), path, "2024-01-09")
    assert tables.snapshot_read_latest(spark, path).count() == 5
    assert tables.snapshot_read_all(spark, path).groupBy("snapshot_date").count().count() == 2
    # a day in between takes its place
    assert tables.snapshot_write(frame(7), path, "2024-01-05", min_days=1)
    assert [tables.snapshot_read_latest(spark, path, d).count() for d in ("2024-01-08", "2024-01-04", "2024-02-01")] == [7, 3, 5]
    assert tables.snapshot_read_all(spark, path).count() == 15


def test_snapshots_wait_for_their_interval(spark, tmp_path):
    path = f"{tmp_path}/snap"
    df = spark.createDataFrame([(1,)], "n int")
    days = ("2024-01-01", "2024-01-07", "2024-01-08", "2024-01-08")
    assert [tables.snapshot_write(df, path, d) for d in days] == [True, False, True, False]
    assert not tables.snapshot_write(df, path, "2024-01-08", min_days=0)
    assert tables.snapshot_read_latest(spark, path).first().snapshot_date == dt.date(2024, 1, 8)
    assert tables.snapshot_read_latest(spark, path, "2024-01-05").first().snapshot_date == dt.date(2024, 1, 1)
    with pytest.raises(FileNotFoundError):
        tables.snapshot_read_latest(spark, f"{tmp_path}/none")


def test_report_parameters_are_not_spliced(spark):
    df = spark.createDataFrame([("a",), ("x' OR '1'='1",)], "c string")
    out = tables.run_report_sql(spark, "SELECT * FROM {t} WHERE c = :v", {"v": "x' OR '1'='1"}, t=df)
    assert out.count() == 1


def test_csv_keeps_types_and_quotes(spark, tmp_path):
    schema = "a string, n int, d date"
    df = spark.createDataFrame([('x, "y"', 1, dt.date(2024, 2, 29)), (None, None, None)], schema)
    tables.write_csv(df, f"{tmp_path}/c")
    assert set(tables.read_csv(spark, f"{tmp_path}/c", schema).collect()) == set(df.collect())


def test_report_manifest_counts_what_was_written(spark, tmp_path):
    sheets = {"One": ("First", spark.range(3)), "two b": ("Second", spark.range(0))}
    rows = tables.write_report(sheets, str(tmp_path)).collect()
    assert {(r.name, r.title, r.rows) for r in rows} == {("One", "First", 3), ("two b", "Second", 0)}


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    assert session.shared_folder(Session(spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        session.shared_folder(Session(spark_master="spark://host:1"))


def test_weeks_are_written_once_complete(spark, tmp_path):
    folder, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    schema = "week_start DATE, n BIGINT"

    def run(rows):
        events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        jobs.stream_time_buckets(jobs.read_arriving(spark, folder, EVENT), "ts", out, mark)
        return {(str(r.week_start), r.n) for r in spark.read.schema(schema).parquet(out).collect()}

    # Sunday evening and Monday morning fall in different weeks
    assert run([(1, "2024-01-07 23:59:00", "a", 1), (2, "2024-01-08 00:01:00", "a", 1)]) == set()
    assert run([(3, "2024-01-09 12:00:00", "a", 1)]) == {("2024-01-01", 1)}
    # too late for its week, which is complete
    assert run([(4, "2024-01-02 00:00:00", "a", 1), (5, "2024-01-17 00:00:00", "a", 1)]) == {("2024-01-01", 1), ("2024-01-08", 2)}


def test_forms_sent_again_in_a_later_run_are_dropped(spark, tmp_path):
    folder, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    for rows in ([(1, "2024-01-01 00:00:00", "a", 1), (1, "2024-01-01 00:00:00", "a", 1)], [(1, "2024-01-01 00:00:00", "a", 1), (2, "2024-01-02 00:00:00", "b", 1)]):
        events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        jobs.stream_dedupe_forms(jobs.read_arriving(spark, folder, EVENT), "id", "ts", out, mark)
    assert sorted(r.id for r in spark.read.schema(EVENT).parquet(out).collect()) == [1, 2]


def test_newest_row_per_key_equals_the_batch_result(spark, tmp_path):
    folder, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    order = [F.col("ts").desc(), F.col("id").desc()]
    everything = []
    batches = (
        [(1, "2024-01-01 00:00:00", "a", 1), (2, "2024-01-05 00:00:00", "b", 2)],
        [(3, "2024-01-03 00:00:00", "a", 3), (4, "2024-01-04 00:00:00", "b", 4)],
        [(5, "2024-01-03 00:00:00", "a", 5), (6, "2024-01-01 00:00:00", "c", 6)],
    )
    for rows in batches:
        everything += rows
        events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        jobs.stream_latest_per_key(jobs.read_arriving(spark, folder, EVENT), "k", order, out, mark)
        got = {r.k: r.id for r in jobs.read_latest_version(spark, out, EVENT).collect()}
        assert got == {r.k: r.id for r in latest.latest_per_key(events(spark, everything), "k", order).collect()}
    assert got == {"a": 5, "b": 2, "c": 6}


def test_open_weeks_equal_the_batch_counts_after_every_run(spark, tmp_path):
    folder, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    everything = []
    for rows in ([(1, "2024-01-07 23:59:00", "a", 1), (2, "2024-01-08 00:01:00", "a", 1)], [(3, "2024-01-09 12:00:00", "a", 1), (4, "2023-01-02 00:00:00", "a", 1)], [(5, "2024-01-01 00:00:00", "a", 1)]):
        everything += rows
        events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        jobs.stream_bucket_counts(jobs.read_arriving(spark, folder, EVENT), "ts", "week", out, mark)
        want = aggregate.time_bucket_counts(events(spark, everything), "ts", "week").select("bucket", "n").collect()
        assert sorted(jobs.read_bucket_counts(spark, out).collect()) == sorted(want)


def test_repeated_batches_and_old_versions_leave_no_trace(spark, tmp_path):
    out = f"{tmp_path}/out"
    add = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    batch = lambda *rows: spark.createDataFrame(rows, "k string, n long")
    state = lambda: {r.k: r.n for r in buckets.read_state(spark, out, "k string, n long").collect()}
    buckets.upsert(batch(("a", 1), ("b", 1)), 0, out, "k", add)
    for _ in range(2):
        buckets.upsert(batch(("a", 5)), 1, out, "k", add)
        assert state() == {"a": 6, "b": 1}
    for n in range(2, 9):
        buckets.upsert(batch(("a", 1), ("b", 1)), n, out, "k", add)
    assert state() == {"a": 13, "b": 8}
    assert len([n for n in os.listdir(f"{out}/pointers") if n[0] != "."]) == 2
    assert len([n for n in os.listdir(out) if n.startswith("version=")]) <= 3


def test_forms_come_once_however_late(spark, tmp_path):
    out = f"{tmp_path}/out"
    order = [F.col("ts"), F.col("v")]
    rows = lambda *r: events(spark, r)
    state = lambda: sorted((r.id is None, r.id, r.v) for r in buckets.read_first_rows(spark, out, EVENT).collect())
    first = [(i, "2023-01-01 00:00:00", "a", i) for i in range(40)]
    buckets.first_of_each_key(rows(*first, (1, "2023-01-01 00:00:00", "a", 99), (None, "2023-01-01 00:00:00", "a", 7)), 0, out, "id", order, buckets=8)
    assert state() == [(False, i, i) for i in range(40)] + [(True, None, 7)]
    again = [(3, "2024-06-01 00:00:00", "a", 0), (100, "2024-06-01 00:00:00", "a", 100)]
    for _ in range(2):
        buckets.first_of_each_key(rows(*again), 1, out, "id", order, buckets=8)
        assert state() == sorted([(False, i, i) for i in (*range(40), 100)] + [(True, None, 7)])
    for n in range(2, 14):
        buckets.first_of_each_key(rows((100 + n, "2024-06-02 00:00:00", "a", 0), (n, "2024-06-02 00:00:00", "a", 0)), n, out, "id", order, buckets=8)
    assert [x[1] for x in state() if x[1] is not None] == [*range(40), 100, *range(102, 114)]


def test_rows_are_ranked_behind_a_shuffle(spark, tmp_path):
    # as one task reads a file of any number of rows, none may be sorted before they are dealt out
    batch = events(spark, [(i % 50, "2023-01-01 00:00:00", "a", i) for i in range(200)])
    batch.coalesce(1).write.parquet(f"{tmp_path}/in")
    ranked = latest.latest_per_key(buckets.spread(spark.read.schema(EVENT).parquet(f"{tmp_path}/in"), "id"), "id", [F.col("v")])
    lines = [x.strip(" :+-*()0123456789") for x in ranked._jdf.queryExecution().sparkPlan().toString().split("\n")]
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x)
    below = [x for x in lines[:scan] if "Exchange" in x or "Sort" in x or "Limit" in x or "Repartition" in x]
    assert re.match("Exchange|Repartition", below[-1]) and any("WindowGroupLimit" in x for x in below)
    assert sorted((r.id, r.v) for r in ranked.collect()) == [(i, i) for i in range(50)]


def test_only_buckets_that_may_hold_a_key_are_opened(spark, tmp_path):
    out = f"{tmp_path}/out"
    rows = lambda ids: events(spark, [(i, "2023-01-01 00:00:00", "a", 1) for i in ids])
    buckets.first_of_each_key(rows(range(30)), 0, out, "id", [F.col("v")], buckets=64)
    keyed = rows([4, 5000, 5001]).select("id", buckets.bucket_of("id", 64))
    filters = spark.read.parquet(f"{out}/filters/version=0")
    own = {r.bucket for r in keyed.where("id = 4").collect()}
    assert buckets.possible_buckets(keyed, "id", filters) == own
    for name in os.listdir(f"{out}/keys/version=0"):
        if name.startswith("bucket=") and int(name[7:]) not in own:
            for part in os.listdir(f"{out}/keys/version=0/{name}"):
                with open(f"{out}/keys/version=0/{name}/{part}", "w") as f:
                    f.write("not parquet")
    buckets.first_of_each_key(rows([4, 5000, 5001]), 1, out, "id", [F.col("v")], buckets=64)
    assert buckets.read_first_rows(spark, out, EVENT).count() == 32


def test_alerts_of_every_run_are_kept(spark, tmp_path):
    folder, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    for i in (1, 2):
        events(spark, [(i, "2024-01-01 00:00:00", "a", 10 * i), (i + 10, "2024-01-01 00:00:00", "a", 0)]).write.mode("append").parquet(folder)
        jobs.stream_alerts(jobs.read_arriving(spark, folder, EVENT), F.col("v") > 5, out, mark)
    assert sorted(r.id for r in spark.read.schema(EVENT).parquet(f"{out}/batch=*").collect()) == [1, 2]


def test_activity_pack_counts_a_row_in_every_period_it_lies_in(spark):
    far = [(dt.date(2015, 5, 1),), (dt.date(2025, 1, 1),), (None,)]
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 10, 17, 18)] + far, "d date")
    rows = dashboards.activity_pack(df, "d", "2024-01-18", {"n": F.count(F.lit(1)), "none": F.count_if(F.lit(False))}).collect()
    assert {(r.period, r.indicator, r.n) for r in rows} == {
        ("current_week", "n", 2), ("previous_week", "n", 1), ("current_month", "n", 4), ("all", "n", 7),
    }


def test_action_lists_name_a_person_once_per_list(spark):
    df = spark.createDataFrame([(1, "CAP", None, True, True), (2, None, None, False, None)], "k int, o string, d date, x boolean, y boolean")
    lists = dashboards.action_lists(df, "k", "o", "d", {"x": F.col("x"), "y": F.col("y")})
    assert {(r.list, r.key) for r in lists.collect()} == {("x", 1), ("y", 1)}
    assert {(r.list, r.office, r.n, r.pct) for r in dashboards.action_list_counts(lists).collect()} == {("x", "CAP", 1, 100.0), ("y", "CAP", 1, 100.0)}
