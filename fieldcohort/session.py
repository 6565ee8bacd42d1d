"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter sets these."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fieldcohort")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local session without that setting uses a folder of its warehouse; a
    cluster without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


_MADE: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def cut_lineage(df: DataFrame, label: str = "step", compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors and has a one-step plan, which keeps
    iterative jobs from growing their lineage. ``release`` removes it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _forget() -> None:
    """At the end of a local session's process its own warehouse scratch goes."""
    for path in _MADE:
        if path.startswith("file:") and "/_scratch/" in path:
            shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)


atexit.register(_forget)


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(*frames: DataFrame) -> None:
    """Remove what ``cut_lineage`` wrote for these; nothing may read them later."""
    for df in frames:
        delete_path(df.sparkSession, df._scratch)
        _MADE.remove(df._scratch)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage, upon which Spark deletes the shuffle files of finished jobs.

    Spark keeps them until then, and a driver with memory to spare seldom does.
    Its listeners hold the last query they were told of, and with it that
    query's shuffles, so an empty one takes its place first.
    For long chains of ``cut_lineage``, after the steps that shuffle much.
    """
    spark.sql("select 1").collect()
    spark.sparkContext._jvm.System.gc()


def sweep(spark: SparkSession) -> None:
    """Remove all intermediate data of this process, once its results are read."""
    while _MADE:
        delete_path(spark, _MADE.pop())
