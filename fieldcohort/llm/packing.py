"""Packing of tokenised examples into sequences, as vector bin packing.

A sequence has three limits at once: tokens, segments and loss-bearing tokens.
A sequence is filled by the piece whose demand has the largest dot product with
what is left of the limits, until none fits. Packing runs in many groups of
bounded size, which Spark deals out; pieces that fill a sequence alone need none.
"""

from __future__ import annotations

import base64
import functools
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import common
from .common import text_batches, text_slices

for _module in (sys.modules[__name__], common):
    cloudpickle.register_pickle_by_value(_module)

TOKENS, SEGMENTS = 1024, 64
#: Pieces packed together; a group's unfilled last sequences are all that packing apart costs.
GROUP = 2048
END_ID = 0
#: A text with a longer run without a change between space and non-space goes to the slower encoder, which has no limit.
LONG_RUN = 2000


def tokenizer_files() -> tuple[str, str]:
    """The vocabulary as JSON and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def _slow_encoder(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    return found, tuple(str(token) for token in found.get_added_tokens_decoder().values())


@functools.lru_cache(maxsize=2)
def _fast_encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, files: tuple[str, str]) -> np.ndarray:
    """The ids that the JSON file's encoder gives; a text without any of its added tokens may take the faster one."""
    raw = text.encode()
    slow, added = _slow_encoder(files[0])
    longest = max(map(len, raw.split()), default=0)
    if longest > LONG_RUN or len(raw) > LONG_RUN and _long_space(raw) or any(token in text for token in added):
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    return np.array(_fast_encoder(files[1]).encode_ordinary(text), np.uint32)


def _long_space(raw: bytes) -> bool:
    import re

    return re.search(rb"[\x00-\x20\x80-\xff]{%d}" % LONG_RUN, raw) is not None


def _cutter(files: tuple[str, str], size: int, keep_ids: bool):
    def cut(batches):
        for batch in batches:
            for low, high, texts in text_slices(batch.column("text")):
                source, start, length, total, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(texts.to_pylist(), low):
                    found = np.append(encode(text, files), np.uint32(END_ID)).astype("<u4")
                    for at in range(0, len(found), size):
                        piece = found[at : at + size]
                        source.append(i)
                        start.append(at)
                        length.append(len(piece))
                        total.append(len(found))
                        crc.append(zlib.crc32(piece.tobytes()))
                        if keep_ids:
                            ids.append(piece.view(np.int32))
                numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                kept = [pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []
                names = ["row", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids]
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(source, pa.int64())), *numbers, *kept], names)

    return cut


def tokenised_pieces(docs: DataFrame, text: str = "text", size: int = TOKENS, files: tuple[str, str] | None = None, keep_ids: bool = False) -> DataFrame:
    """(row, start, length, ids_crc32, doc_tokens[, ids]): the ids of every text and a closing id, cut at multiples of ``size``.

    ``row`` holds the other columns of the document. A null or empty text is
    the closing id alone.
    """
    text_batches(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    packed = docs.select(F.struct(*others).alias("row"), F.col(f"`{text}`").alias("text"))
    fields = [packed.schema["row"], *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return packed.mapInArrow(_cutter(files or tokenizer_files(), size, keep_ids), T.StructType(fields))


def fill(demands: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The sequence number of each demand; every demand must fit the limits by itself.

    Ties go to the demand that comes first.
    """
    share = demands / limits
    placed = np.full(len(demands), -1, np.int64)
    waiting = np.arange(len(demands))
    number = 0
    while len(waiting):
        left = np.ones(demands.shape[1])
        while len(waiting):
            fits = (share[waiting] <= left + 1e-12).all(axis=1)
            if not fits.any():
                break
            best = np.argmax(np.where(fits, share[waiting] @ left, -1.0))
            placed[waiting[best]] = number
            left -= share[waiting[best]]
            waiting = np.delete(waiting, best)
        number += 1
    return placed


def _pack_group(limits: tuple[int, int, int]):
    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "loss", "piece"], ascending=[False, False, True], ignore_index=True)
        demands = np.stack([pieces["length"], np.ones(len(pieces)), pieces["loss"]], axis=1).astype(float)
        pieces["bin"] = fill(demands, np.array(limits, float))
        pieces["offset"] = pieces.groupby("bin")["length"].cumsum() - pieces["length"]
        return pieces[["piece", "group", "bin", "offset"]]

    return pack


def place(pieces: DataFrame, limits: tuple[int, int, int], length: str = "length", loss: str = "loss") -> DataFrame:
    """(piece, sequence_id, offset) for every row of (piece, length, loss), ``piece`` a unique long.

    Offsets in a sequence are gapless from 0. A piece over a limit by itself
    gets a sequence of its own, as does one that no other can join.
    """
    alone = (F.col(length) >= limits[0]) | (F.col(loss) >= limits[2]) | F.lit(limits[1] <= 1)
    narrow = pieces.select("piece", F.col(length).alias("length"), F.col(loss).alias("loss"), alone.alias("alone"))
    count = narrow.where("not alone").count()
    groups = max(1, -(-count // GROUP))
    shared = narrow.where("not alone").withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    packed = shared.select("piece", "length", "loss", "group").groupBy("group").applyInPandas(_pack_group(limits), "piece long, group long, bin long, offset long")
    packed = packed.select("piece", (2 * (F.col("group") * (1 << 21) + F.col("bin"))).alias("sequence_id"), "offset")
    single = narrow.where("alone").select("piece", (2 * F.col("piece") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(single)


def pack(docs: DataFrame, text: str = "text", tokens: int = TOKENS, segments: int = SEGMENTS, loss_tokens: int = TOKENS, files: tuple[str, str] | None = None, keep_ids: bool = False) -> DataFrame:
    """(row, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset): every piece of every document in its sequence.

    Loss-bearing are all ids but the first of a document, which nothing
    predicts. Repeated rows are packed one by one; without rows there are no
    pieces.
    """
    pieces = tokenised_pieces(docs, text, min(tokens, loss_tokens), files, keep_ids)
    pieces = cut_lineage(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    loss = F.col("length") - (F.col("start") == 0).cast("long")
    placed = place(pieces.select("piece", "length", loss.alias("loss")), (tokens, segments, loss_tokens))
    return pieces.join(placed, "piece").drop("piece")


def padded(lengths: pd.Series, tokens: int = TOKENS) -> pd.Series:
    """Lengths of sequences after padding: to ``tokens``, except at a power of two."""
    exact = (lengths > 0) & ((lengths & (lengths - 1)) == 0)
    return lengths.where(exact, tokens)
