"""A reproducible shuffle of all rows into shards whose places can be computed.

Rows get global numbers in a declared order; a Feistel network over the numbers,
with cycle walking, permutes them. Shard and slot follow from the permuted
number, and the inverse finds the row of any shard and slot, without a table.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import tokens
from .tokens import _stream, mix

for _module in (sys.modules[__name__], tokens):
    cloudpickle.register_pickle_by_value(_module)

ROUNDS = 6


class Shuffle:
    """A permutation of 0 .. count - 1 that a seed fixes.

    The network permutes the smallest 2 ** (2 * half) that holds ``count``; a
    value outside the count is permuted again until it falls inside. Fewer than
    four tries are expected, as the domain is at most four times the count.
    """

    def __init__(self, count: int, seed: int = 0):
        self.count, self.half = count, np.uint64(max(1, -(-max(count - 1, 1).bit_length() // 2)))
        self.keys = _stream(seed ^ 0x5EED, ROUNDS)
        self.mask = np.uint64((1 << int(self.half)) - 1)

    def _once(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in keys:
            if back:
                left, right = right ^ (mix(left ^ key) & self.mask), left
            else:
                left, right = right, left ^ (mix(right ^ key) & self.mask)
        return left << self.half | right

    def _walk(self, values: np.ndarray, back: bool) -> np.ndarray:
        out = np.asarray(values).astype(np.uint64)
        keys = self.keys[::-1] if back else self.keys
        todo = np.arange(len(out))
        while len(todo):
            out[todo] = self._once(out[todo], keys, back)
            todo = todo[out[todo] >= self.count]
        return out.astype(np.int64)

    def forward(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def inverse(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, True)

    def row_of(self, shard: int, slot: int, shards: int) -> int:
        """The row number that lies in a slot of a shard."""
        return int(self.inverse(np.array([slot * shards + shard]))[0])


def global_numbers(df: DataFrame, order: list[Column], label: str = "ordered") -> tuple[DataFrame, int]:
    """(df with ``number``, count): rows numbered from 0 in the order; ties by input order.

    Rows are sorted by range, so no task holds more than a range of them; a key
    that many rows share is divided by input order. Only one count per
    partition is summed up.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(f"o{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("input"))
    keys = [f"o{i}" for i in range(len(order))] + ["input"]
    ordered = packed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = cut_lineage(ordered.select("row", F.monotonically_increasing_id().alias("at")), label)
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r.part: r.held for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("held")).collect()}
    before, starts = 0, []
    for key in sorted(sizes):
        starts.append((key, before))
        before += sizes[key]
    offsets = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
    numbered = placed.withColumn("part", part).join(offsets, "part").select("row", (F.col("start") + inside).alias("number"))
    return numbered, before


def assign(df: DataFrame, shards: int, order: list[Column], seed: int = 0) -> DataFrame:
    """(row, number, shard, slot): every row in one of ``shards``, whose sizes differ by one row at most.

    Slots are gapless from 0 in each shard. The same rows, order and seed give
    the same places. Equal rows are interchangeable. Nulls in the order come
    first; no rows give no places.
    """
    numbered, count = global_numbers(df, order)
    shuffle = Shuffle(count, seed)

    @F.arrow_udf(T.LongType())
    def permuted(numbers: pa.Array) -> pa.Array:
        return pa.array(shuffle.forward(numbers.to_numpy(zero_copy_only=False)))

    place = numbered.withColumn("place", permuted("number"))
    return place.select("row", "number", (F.col("place") % shards).cast("int").alias("shard"), F.floor(F.col("place") / shards).alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """The rows as one folder per shard, each file sorted by slot."""
    spread = placed.repartition("shard").sortWithinPartitions("shard", "slot")
    spread.select("row.*", "shard", "slot").write.partitionBy("shard").parquet(path)
