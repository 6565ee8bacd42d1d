"""Quality rules for documents, with the frequency of lines across the documents of a host.

A line that many different documents of one host carry is furniture of the site
and is removed; a document that loses most of its words that way is rejected.
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
from . import common, tokens
from .common import BROADCAST_ROWS, inside, once, text_batches, text_slices, words
from .tokens import IS_SPACE, raw_bytes, run_hashes, runs, windows, word_hashes

for _module in (sys.modules[__name__], common, tokens):
    cloudpickle.register_pickle_by_value(_module)

#: A line is furniture from this many different documents of its host on ...
LEAST_DOCUMENTS = 20
#: ... if they are also this share of the host's different documents.
LEAST_SHARE_PCT = 10
#: A document is rejected when less than this share of its words remains.
REMAINING_PCT = 50
#: Fixed values of the base rules: fewest words, and the largest share of words in repeated windows.
FEWEST_WORDS, REPEATED_PCT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of True values of each row."""
    before = np.concatenate([[0], np.cumsum(mask)])
    return before[offsets[1:]] - before[offsets[:-1]]


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> list[int]:
    """For each row, the words that lie in a three-word window found twice or more."""
    every, out = windows(hashes, 3), []
    for low, high in zip(first[:-1], first[1:]):
        count = 0
        if high - low > 3:
            _, index, held = np.unique(every[low : high - 2], return_inverse=True, return_counts=True)
            if (held > 1).any():
                inside_any = np.zeros(high - low, bool)
                for place in range(3):
                    inside_any[place : high - low - 2 + place] |= held[index] > 1
                count = int(inside_any.sum())
        out.append(count)
    return out


def _repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row, the lines with a word that equal an earlier line."""
    within = data != 10
    starts, first = runs(within, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    if not len(starts):
        return np.zeros(len(offsets) - 1, np.int64)
    hashes = run_hashes(data, within, starts)
    wordy = np.add.reduceat((~IS_SPACE[data]).astype(np.int64), starts) > 0
    row, hashes = row[wordy], hashes[wordy]
    order = np.lexsort((hashes, row))
    same = (np.diff(hashes[order]) == 0) & (np.diff(row[order]) == 0)
    return np.bincount(row[order][1:][same], minlength=len(offsets) - 1)


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text of a large_string array without nulls."""
    data, offsets = raw_bytes(texts)
    hashes, first = word_hashes(texts, lower=False)
    return {
        "n_words": np.diff(first),
        "word_chars": _per_row(~IS_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
        "n_dup_lines": _repeated_lines(data, offsets),
        "n_repeat_words": np.array(_repeated_words(hashes, first), np.int64),
    }


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def counted(texts: pa.Array) -> pa.Array:
    parts = [base_counts(part) for _, _, part in text_slices(texts)]
    columns = [np.concatenate([p[c] for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64) for c in COUNTS]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], list(COUNTS))


def line_key(line: Column) -> Column:
    """A hash of the line in lower case, with digits made equal and white space evened out."""
    even = F.regexp_replace(F.lower(line), "[0-9]", "0")
    return F.xxhash64(F.btrim(F.regexp_replace(even, "[ \\t\\r]+", " ")))


def frequent_lines(rows: DataFrame, host: str, text: str, least: int = LEAST_DOCUMENTS, share_pct: float = LEAST_SHARE_PCT) -> DataFrame:
    """(host, key): the lines above both limits of their host.

    Documents with equal texts count once, so copies of a document do not make
    its lines furniture; they are left to deduplication.
    """
    distinct = rows.select(inside(host).alias("host"), F.xxhash64(inside(text)).alias("same"), inside(text).alias("text"))
    keys = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda l: F.length(F.btrim(l, F.lit(" \t\r"))) > 0), line_key))
    lines = distinct.select("host", "same", F.explode(keys).alias("key"))
    held = lines.groupBy("host", "key", "same").agg(F.lit(1)).groupBy("host", "key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= least)
    sizes = distinct.select("host", "same").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("size"))
    above = held.join(sizes, held.host.eqNullSafe(sizes.host)).where(F.col("held") * 100 >= F.col("size") * share_pct)
    return above.select(held.host, "key")


def judge(docs: DataFrame, host: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, share_pct: float = LEAST_SHARE_PCT, remaining_pct: float = REMAINING_PCT) -> DataFrame:
    """Every row of ``docs`` (struct ``row``) with the base counts, base_failed, n_removed, n_left, kept and clean.

    - n_removed: lines removed as furniture; n_left: words that remain.
    - clean: the text without those lines; the text itself where none is.
    - kept: false if the base rules fail or less than half of the words remains.
    - Null text counts as empty: no words, so the base rules fail. A null host
      is a host of its own. Repeated rows are judged alike.

    The texts are read twice and never shuffled. Every furniture line of a host
    is in a tenth of its documents, so a host has at most ten times the mean
    number of lines of them; they travel as one array per host, broadcast if
    their number shows that they are few.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    frequent = cut_lineage(frequent_lines(rows, host, text, least, share_pct), "frequent")
    by_host = frequent.groupBy("host").agg(F.collect_list("key").alias("furniture"))
    if frequent.count() <= BROADCAST_ROWS:
        by_host = F.broadcast(by_host)
    found = rows.join(by_host, inside(host).eqNullSafe(F.col("host")), "left").drop("host")

    found = found.withColumn("lines", once(F.when(F.col("furniture").isNotNull(), F.split(inside(text), "\n"))))
    found = found.withColumn("keys", once(F.transform("lines", line_key)))
    found = found.withColumn("hit", once(F.array_intersect("keys", "furniture"))).drop("furniture")
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    gone = F.filter(places, lambda i: F.array_contains("hit", F.get("keys", i)))
    found = found.withColumn("gone", once(F.when(F.size("hit") > 0, gone))).drop("hit", "keys")
    stay = F.array_except(places, F.col("gone"))
    pick = lambda spots: F.array_join(F.transform(spots, lambda i: F.get("lines", i)), "\n")
    found = found.withColumn("clean", F.when(F.col("gone").isNull(), inside(text)).otherwise(pick(stay)))
    found = found.withColumn("lost", F.when(F.col("gone").isNotNull(), F.size(words(pick(F.col("gone"))))).otherwise(0)).drop("lines")
    found = found.withColumn("n", counted(inside(text)))

    n_words = F.col("n.n_words")
    failed = (n_words < FEWEST_WORDS) | (100 * F.col("n.n_repeat_words") > REPEATED_PCT * n_words)
    left = n_words - F.col("lost")
    kept = ~failed & (100 * left >= remaining_pct * n_words)
    removed = F.greatest(F.size("gone"), F.lit(0)).cast("long")
    return found.select("row", "n.*", failed.alias("base_failed"), removed.alias("n_removed"), left.alias("n_left"), kept.alias("kept"), "clean")


def good_documents(docs: DataFrame, host: str = "source", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that are kept, without the furniture of their hosts; ``n_chars`` is counted anew."""
    changed = {text: F.col("clean"), n_chars: F.length("clean").cast("long")}
    return judge(docs, host, text).where("kept").select(*[changed.get(c, inside(c)).alias(c) for c in docs.columns])
