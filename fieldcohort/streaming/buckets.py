"""State of incremental jobs: rows in buckets by the hash of their key, in a shared folder.

A batch opens and writes only the buckets its keys lie in. What belongs to the
state is named by a pointer, a small commit written last, so a batch that
failed or is run again starts from the pointer before it and changes nothing
twice. Two pointers are kept; what neither of them names is removed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, delete_path, release
from ..sources import commits

#: Bits of one bitmap aggregate of Spark; a bucket's filter has so many.
BITS = 32_768
#: Bits that a key sets.
MARKS = 4
#: Versions of which a bucket's keys may be spread before it is written anew as one.
LAYERS = 8


def pointer(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, dict]:
    """(number, content) of the newest pointer, or of the newest below ``before``; -1 and nothing without one."""
    found = [int(n.removesuffix(".json")) for n in commits.names(spark, f"{path}/pointers") if n.endswith(".json") and not n.startswith(".")]
    found = [n for n in found if before is None or n < before]
    if not found:
        return -1, {}
    return max(found), commits.read(spark, f"{path}/pointers/{max(found)}.json")


def point(spark: SparkSession, path: str, number: int, content: dict, before: int) -> None:
    """Make ``content`` the state after batch ``number``; of the older pointers only ``before`` stays."""
    commits.write(spark, f"{path}/pointers/{number}.json", content)
    for name in commits.names(spark, f"{path}/pointers"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < before:
            delete_path(spark, f"{path}/pointers/{name}")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _places(path: str, versions: dict[int, list[int]]) -> list[str]:
    return [f"{path}/version={v}/bucket={b}" for b, held in sorted(versions.items()) for v in held]


def _versions(content: dict) -> dict[int, list[int]]:
    return {int(b): held for b, held in content.get("versions", {}).items()}


def _tidy(spark: SparkSession, path: str, *kept: dict[int, list[int]]) -> None:
    """Remove the buckets of versions that no kept pointer names."""
    named = {(v, b) for versions in kept for b, held in versions.items() for v in held}
    for name in commits.names(spark, path):
        if name.startswith("version="):
            version = int(name.removeprefix("version="))
            if not any(v == version for v, _ in named):
                delete_path(spark, f"{path}/{name}")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt to tasks by key and origin before they are sorted.

    A task that reads a file may get millions of narrow rows. What it sends on
    it need not hold, whereas a ranking holds and sorts all rows of its task,
    and tasks behind a shuffle are kept to a fixed size. Copies of one key from several tasks
    stay apart, so none gets all of them.
    """
    return rows.repartition(F.col(key), F.spark_partition_id())


def upsert(batch: DataFrame, number: int, path: str, key: str, merge: Callable[[DataFrame], DataFrame], buckets: int = 16) -> None:
    """Merge a batch into the state: ``merge`` reduces old and new rows together to one row per key.

    ``batch`` is reduced first, so only one row per key meets the state. The
    merge must give rows of the same columns as it gets.
    """
    spark = batch.sparkSession
    last, content = pointer(spark, path, before=number)
    before = _versions(content)
    new = cut_lineage(merge(batch).select("*", bucket_of(key, buckets)), "batch")
    touched = {r.bucket for r in new.select("bucket").distinct().collect()}
    if touched:
        held = _places(path, {b: v for b, v in before.items() if b in touched})
        rows = new.drop("bucket")
        if held:
            rows = merge(rows.unionByName(spark.read.schema(rows.schema).parquet(*held)))
        rows.select("*", bucket_of(key, buckets)).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={number}")
    after = before | {b: [number] for b in touched}
    point(spark, path, number, {"versions": after}, last)
    _tidy(spark, path, before, after)
    release(new)


def read_state(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that the newest pointer names."""
    places = _places(path, _versions(pointer(spark, path)[1]))
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*places)


def _marks(key: str) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(BITS)) for i in range(MARKS)])


def key_filters(rows: DataFrame, key: str) -> DataFrame:
    """(bucket, bits): a Bloom filter of the keys of each bucket, built with map-side combine."""
    return rows.select("bucket", F.explode(_marks(key)).alias("mark")).groupBy("bucket").agg(F.bitmap_construct_agg("mark").alias("bits"))


def _is_set(bits: Column, mark: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(mark / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), F.pmod(mark, F.lit(8)))).cast("int") % 2 == 1


def possible_buckets(rows: DataFrame, key: str, filters: DataFrame) -> set[int]:
    """Buckets that may hold one of the keys; there are only so many."""
    known = rows.select("bucket", _marks(key).alias("marks")).join(F.broadcast(filters), "bucket")
    return {r.bucket for r in known.where(F.forall("marks", lambda m: _is_set(F.col("bits"), m))).select("bucket").distinct().collect()}


def first_of_each_key(batch: DataFrame, number: int, path: str, key: str, order: Sequence[Column], buckets: int = 256) -> None:
    """Append the rows whose key no earlier batch had, however long ago, to ``path``/rows.

    Of a key's rows in one batch the first in ``order`` stays; rows without a
    key all stay. The keys lie in ``path``/keys. Each bucket has a Bloom filter,
    so a bucket is opened only if it may hold a key of the batch; its filter and
    place are in the pointer's version, whose size is bounded by the buckets.
    """
    from ..operators.latest import latest_per_key

    spark = batch.sparkSession
    last, content = pointer(spark, path, before=number)
    before = _versions(content)
    old = spark.read.schema("bucket INT, bits BINARY").parquet(f"{path}/filters/version={last}") if content.get("filters") else None
    keyed = latest_per_key(spread(batch.where(F.col(key).isNotNull()), key), key, order)
    keyed = cut_lineage(keyed.select("*", bucket_of(key, buckets)), "batch")
    opened = possible_buckets(keyed, key, old) if old is not None else set()
    fresh = keyed
    key_schema = keyed.select(key).schema
    if opened:
        known = spark.read.schema(key_schema).parquet(*_places(f"{path}/keys", {b: before[b] for b in opened}))
        fresh = keyed.join(known, key, "left_anti").select(keyed.columns)
    fresh = cut_lineage(fresh, "fresh")
    whole = fresh.drop("bucket").unionByName(batch.where(F.col(key).isNull()))
    whole.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    new = fresh.select(key, "bucket")
    touched = {r.bucket for r in new.select("bucket").distinct().collect()}
    merged = {b for b in touched if b in opened or len(before.get(b, [])) >= LAYERS}
    again = _places(f"{path}/keys", {b: before[b] for b in merged if b in before})
    if again:
        held = spark.read.schema(key_schema).parquet(*again).select("*", bucket_of(key, buckets))
        new = new.unionByName(held)
    if touched:
        new.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/keys/version={number}")
    filters = key_filters(fresh, key)
    filters = filters if old is None else filters.unionByName(old).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    filters.coalesce(1).write.mode("overwrite").parquet(f"{path}/filters/version={number}")
    after = before | {b: [number] if b in merged else [*before.get(b, []), number] for b in touched}
    done = [*[n for n in content.get("batches", []) if n < number], number]
    point(spark, path, number, {"versions": after, "filters": True, "batches": done}, last)
    _tidy(spark, f"{path}/keys", before, after)
    for name in commits.names(spark, f"{path}/filters"):
        if int(name.removeprefix("version=")) not in (last, number):
            delete_path(spark, f"{path}/filters/{name}")
    release(keyed, fresh)


def read_first_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all batches that the newest pointer names."""
    done = pointer(spark, path)[1].get("batches", [])
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/rows/batch={n}" for n in done])
