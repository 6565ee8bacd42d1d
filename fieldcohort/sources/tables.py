"""Readers and writers for exports, feeds, reports and dated snapshots."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import quoted, safe_name
from ..operators.latest import dedupe_keep
from ..session import delete_path
from . import commits

DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def load_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """Read one export, only the listed columns."""
    reader = spark.read.format(fmt).options(**options)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return df.select(*[quoted(c) for c in columns]) if columns else df


def load_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Relational source; credentials come from the caller's options."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def list_paths(spark: SparkSession, pattern: str) -> DataFrame | None:
    """File paths under a pattern, listed without reading any content."""
    try:
        return spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def latest_date_in_names(spark: SparkSession, pattern: str, name: str, as_of: str | date) -> date | None:
    """Newest date, not after ``as_of``, that follows ``name`` in the file paths."""
    paths = list_paths(spark, pattern)
    if paths is None:
        return None
    plain = F.url_decode("path")
    day = F.regexp_extract(plain, re.escape(name).replace(r"\ ", " ") + DATE_IN_NAME, 1).try_cast("date")
    newest = paths.select(day.alias("d")).where(F.col("d") <= F.lit(str(as_of)).cast("date")).agg(F.max("d"))
    return newest.first()[0]


def load_latest_dated(spark: SparkSession, folder: str, base: str, as_of: str | date) -> DataFrame:
    """The newest ``<base> YYYY-MM-DD.parquet`` up to the run date."""
    day = latest_date_in_names(spark, f"{folder}/{base} *.parquet", f"{base} ", as_of)
    if day is None:
        raise FileNotFoundError(f"no dated file {base!r} up to {as_of} in {folder}")
    return spark.read.parquet(f"{folder}/{base} {day}.parquet")


def run_report_sql(spark: SparkSession, text: str, params: Mapping, **tables: DataFrame) -> DataFrame:
    """A report query with named markers (``:start_date``) over named tables."""
    return spark.sql(text, args=dict(params), **tables)


def read_paged_json(spark: SparkSession, folder: str, record: T.StructType, key: str, order: Sequence[str]) -> DataFrame:
    """All records of landed feed pages, one per key.

    A page is ``{"value": [records], "@odata.nextLink": ...}``. A record that
    appears on two pages is kept once, the first in the given order.
    """
    page = T.StructType([T.StructField("value", T.ArrayType(record))])
    rows = spark.read.schema(page).json(folder, multiLine=True).select(F.inline("value"))
    return dedupe_keep(rows, key, order)


def _same_path(path: str) -> Column:
    """A file's path in one form, however the reader spells it."""
    return F.regexp_replace(F.coalesce(F.try_url_decode(F.col(path)), F.col(path)), r"^(\w+:)/+", "$1/")


def _page_schema(record: T.StructType) -> T.StructType:
    texts = [T.StructField(c, T.StringType()) for c in ("link", "@odata.nextLink", "@odata.deltaLink")]
    return T.StructType([*texts, T.StructField("value", T.ArrayType(record))])


def _require_whole_chain(pages: DataFrame, first: str) -> None:
    """Every page that a next link leads to is there, and a link leads to every page."""
    begin = pages.sparkSession.createDataFrame([(first,)], "link string")
    next_links = begin.unionByName(pages.where("next is not null").select(F.col("next").alias("link")))
    missing = [r.link for r in next_links.distinct().join(pages, "link", "left_anti").orderBy("link").limit(20).collect()]
    if missing:
        raise ValueError(f"pages are missing: {', '.join(missing)}")
    every = next_links.unionByName(pages.where("delta is not null").select(F.col("delta").alias("link")))
    loose = [str(r.link) for r in pages.join(every, "link", "left_anti").select("link").orderBy("link").limit(20).collect()]
    if loose:
        raise ValueError(f"no link leads to these pages: {', '.join(loose)}")


def read_new_pages(spark: SparkSession, folder: str, record: T.StructType, key: str, order: Sequence[str], first: str, ledger: str) -> DataFrame:
    """Records of the feed pages that no earlier run has read, one per key.

    A page is ``{"link": its own, "value": [records], "@odata.nextLink": ...}``.
    The feed begins with the link ``first``; the last page of a run has no next
    link, but a ``@odata.deltaLink`` with which a later run may go on. The
    ledger in the folder ``ledger`` holds the links, the number of records and
    the file of every page read. A run opens only files that the ledger does not
    know. If a next link has no page, or no link leads to a page, an error names
    it and nothing is committed. No new pages give no rows.
    """
    done = commits.read(spark, f"{ledger}/newest.json") or {"parts": []}
    files = list_paths(spark, f"{folder}/*.json")
    if files is None:
        raise FileNotFoundError(f"no pages in {folder}")
    known = page_ledger(spark, ledger)
    unknown = files.select("path", _same_path("path").alias("file")).join(known.select("file"), "file", "left_anti")
    paths = [r.path for r in unknown.collect()]
    if not paths:
        return spark.createDataFrame([], record)
    pages = spark.read.schema(_page_schema(record)).json(paths, multiLine=True).withColumn("file", F.col("_metadata.file_path")).withColumn("file", _same_path("file"))
    part = f"part-{len(done['parts'])}-{uuid.uuid4().hex[:8]}"
    links = [F.col("link"), F.col("`@odata.nextLink`").alias("next"), F.col("`@odata.deltaLink`").alias("delta")]
    pages.select(*links, F.coalesce(F.size("value"), F.lit(0)).alias("records"), "file").write.parquet(f"{ledger}/{part}")
    _require_whole_chain(known.unionByName(spark.read.schema(LEDGER).parquet(f"{ledger}/{part}")), first)
    commits.write(spark, f"{ledger}/newest.json", {"parts": [*done["parts"], part]})
    return dedupe_keep(pages.select(F.inline("value")), key, order)


LEDGER = "link string, next string, delta string, records int, file string"


def page_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(link, next, delta, records, file) of all pages that runs have read."""
    done = commits.read(spark, f"{ledger}/newest.json")
    if not done:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(*[f"{ledger}/{p}" for p in done["parts"]])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, **options)


def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").csv(path, header=True, **options)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_report(tables: Mapping[str, tuple[str, DataFrame]], folder: str) -> DataFrame:
    """Several named tables as one report: a dataset each plus a manifest.

    The manifest (name, title, rows) counts what was written.
    """
    spark = next(iter(tables.values()))[1].sparkSession
    parts = []
    for name, (title, df) in tables.items():
        path = f"{folder}/{safe_name(name)}"
        df.write.mode("overwrite").parquet(path)
        written = spark.read.schema(df.schema).parquet(path)
        parts.append(
            written.agg(F.lit(name).alias("name"), F.lit(title).alias("title"), F.count(F.lit(1)).alias("rows"))
        )
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def write_partitioned(df: DataFrame, group: str, path: str, spread: Column | None = None) -> None:
    """One block per group value.

    Rows are not moved together first, so a large group is written by many
    tasks; ``spread`` may name a column to gather small groups by.
    """
    rows = df if spread is None else df.repartition(quoted(group), spread)
    rows.write.mode("overwrite").partitionBy(group).parquet(path)


def _commit_path(path: str, day: str) -> str:
    return f"{path}/_commits/{day}.json"


def _newest_snapshot(spark: SparkSession, path: str, as_of: str | date = "9999-12-31") -> dict | None:
    """The commit of the newest snapshot up to a day, found from the newest one back along the chain of commits."""
    top = commits.read(spark, f"{path}/_commits/newest.json")
    day = top["day"] if top else None
    while day is not None and day > str(as_of):
        day = commits.read(spark, _commit_path(path, day))["previous"]
    return commits.read(spark, _commit_path(path, day)) if day else None


def snapshot_write(df: DataFrame, path: str, as_of: str | date, min_days: int = 7) -> bool:
    """Write a dated snapshot unless the newest one is younger than ``min_days``
    or of the same day. Says whether it was written.

    Rows are written to a folder of this attempt; a commit written last names
    its files and rows. Of two writers of a day the first to commit stays, and
    the other's files are removed. A snapshot of a day before the newest one is
    put in its place in the chain of commits.
    """
    spark = df.sparkSession
    run_day = date.fromisoformat(str(as_of))
    newest = _newest_snapshot(spark, path, as_of)
    if newest is not None and (run_day - date.fromisoformat(newest["day"])).days < max(min_days, 1):
        return False
    place = f"{path}/snapshot_date={run_day}/attempt-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(place)
    commit = {"day": str(run_day), "previous": newest["day"] if newest else None, "rows": seen.get["rows"], "files": commits.files_below(spark, place)}
    if not commits.write(spark, _commit_path(path, str(run_day)), commit, replace=False):
        delete_path(spark, place)
        return False
    _link(spark, path, str(run_day))
    return True


def _link(spark: SparkSession, path: str, day: str) -> None:
    """Make the newest commit, or the next later one, lead to the commit of ``day``."""
    top = commits.read(spark, f"{path}/_commits/newest.json")
    if top is None or top["day"] < day:
        commits.write(spark, f"{path}/_commits/newest.json", {"day": day})
        return
    later = commits.read(spark, _commit_path(path, top["day"]))
    while later["previous"] is not None and later["previous"] > day:
        later = commits.read(spark, _commit_path(path, later["previous"]))
    if later["day"] != day:
        commits.write(spark, _commit_path(path, later["day"]), later | {"previous": day})


def _snapshot(spark: SparkSession, commit: dict) -> DataFrame:
    rows = spark.read.parquet(*commit["files"])
    return rows.withColumn("snapshot_date", F.lit(commit["day"]).cast("date"))


def snapshot_read_latest(spark: SparkSession, path: str, as_of: str | date = "9999-12-31") -> DataFrame:
    """The newest snapshot up to a day: the files that its commit names, and no others."""
    commit = _newest_snapshot(spark, path, as_of)
    if commit is None:
        raise FileNotFoundError(f"no snapshot below {path}")
    return _snapshot(spark, commit)


def snapshot_read_all(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots that were committed, with their days."""
    commit = _newest_snapshot(spark, path)
    if commit is None:
        raise FileNotFoundError(f"no snapshot below {path}")
    parts = [_snapshot(spark, commit)]
    while commit["previous"] is not None:
        commit = commits.read(spark, _commit_path(path, commit["previous"]))
        parts.append(_snapshot(spark, commit))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
