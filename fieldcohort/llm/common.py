"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A side of a join is sent to every executor up to this many rows of a few
#: numbers each; beyond it the join is left to shuffle.
BROADCAST_ROWS = 500_000

#: Words are runs of anything but these: space, tab, line feed, vertical tab, form feed, return.
SPACES = "[ \\t\\n\\x0B\\f\\r]+"


def numbered_rows(docs: DataFrame, label: str = "rows") -> DataFrame:
    """(row, uid): every row with all its own columns in the struct ``row``.

    Written once, so ``uid`` stays the same however often it is read, and the
    names inside ``row`` cannot clash with those of an operator.
    """
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return cut_lineage(docs.select(packed, F.monotonically_increasing_id().alias("uid")), label, "zstd")


def inside(name: str) -> Column:
    """A column of ``row``."""
    return F.col(f"row.`{name}`")


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if a count shows that it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def once(value: Column) -> Column:
    """``value`` as a column that is computed once per row.

    Spark pastes the definition of a column into its uses, inside lambda
    functions and pushed-down filters too, and would compute it there for every
    element. It leaves alone what depends on the partition id.
    """
    return F.when(F.spark_partition_id() >= 0, value)


#: Bytes of texts that a Python worker gets at once.
BATCH = "8m"


def text_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, so that workers on whole texts stay small; a setting of the user's is kept."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, BATCH)


def words(text: Column) -> Column:
    """Array of the words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % modulus


def text_slices(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, pa.Array]]:
    """(from, to, texts) of consecutive rows holding about ``limit`` bytes; a longer text comes alone."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i, column[start:i]
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes), column[start:]
