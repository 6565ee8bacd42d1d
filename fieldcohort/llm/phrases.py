"""Collocations of two and three words per language, counted by a multikey quicksort.

Every word occurrence is a suffix: the word and the two after it in its piece. A
first pass over the texts counts words and measures how many suffixes each slot
of leading words holds. A second pass sends the suffixes of each chunk, equal
ones collapsed, to the bucket of their two leading words, so the suffixes of a
phrase meet in one task. There a three-way quicksort on one word after the other
partitions pointers to the suffixes. The size of an equal partition is the count
of its phrase; a partition with fewer suffixes than a candidate needs is
abandoned at once. A slot that holds far more than the others is split by the
third word, and its counts of two words are added up afterwards.
"""

from __future__ import annotations

import sys
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from . import common, tokens
from .common import text_batches, text_slices
from .tokens import LOWER, _stream, mix, raw_bytes, run_hashes, runs

for _module in (sys.modules[__name__], common, tokens):
    cloudpickle.register_pickle_by_value(_module)

LEAST = 10
#: A phrase goes if a longer candidate around it has this share of its occurrences.
COVERED_PCT = 50
TOP = 2000
WORDS = 3

#: Bytes of text whose equal suffixes are collapsed before they are sent.
CHUNK = 8 << 20
#: Suffixes that a bucket holds on average.
BUCKET = 1 << 19
#: Slots of leading words whose load is measured, and the multiple of the mean from which one is split.
SLOTS, CROWDED = 1 << 14, 8

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9]] = True
#: A piece ends at one of these characters.
IS_END = np.zeros(256, bool)
IS_END[list(b".,;:!?\n\x0b\x0c\r")] = True


def _seeded(seed: int) -> np.ndarray:
    """A permutation of the byte values, so that each seed hashes words differently; 0 leaves them."""
    return np.arange(256, dtype=np.uint8) if seed == 0 else np.argsort(_stream(seed + 100, 256)).astype(np.uint8)


class _Words:
    """The words of a slice of texts: hash (with the language), piece, and where the bytes of each lie."""

    def __init__(self, texts: pa.Array, langs: np.ndarray, seed: int):
        self.data, offsets = raw_bytes(texts)
        self.data = LOWER[self.data]
        ends = IS_END[self.data]
        self.inside = ~(IS_SPACE[self.data] | ends)
        self.starts, first = runs(self.inside, offsets)
        self.row = np.repeat(np.arange(len(texts)), np.diff(first))
        pieces = np.cumsum(ends)[self.starts] if len(self.starts) else np.zeros(0, np.int64)
        self.piece = pieces + self.row
        known, at = np.unique(langs, return_inverse=True)
        marks = np.array([int.from_bytes(blake2b(f"{seed} {x}".encode(), digest_size=8).digest(), "little") for x in known], np.uint64)
        self.lang = at[self.row] if len(self.row) else np.zeros(0, np.int64)
        self.names = known
        self.hashes = mix(run_hashes(_seeded(seed)[self.data], self.inside, self.starts) + marks[self.lang]) if len(self.starts) else np.zeros(0, np.uint64)
        self.hashes = np.where(self.hashes == 0, np.uint64(1), self.hashes)

    def spelled(self, which: np.ndarray) -> list[bytes]:
        outside = np.flatnonzero(~self.inside)
        stops = np.append(outside, len(self.data))[np.searchsorted(outside, self.starts[which])]
        edges = np.append(self.starts, len(self.data))[which + 1]
        held = self.data.tobytes()
        return [held[a:b] for a, b in zip(self.starts[which], np.minimum(stops, edges))]

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hash of each word and of the two after it in its piece, 0 where it has ended."""
        h, p = self.hashes, self.piece
        out = [h]
        for k in (1, 2):
            later = np.zeros_like(h)
            if len(h) > k:
                later[:-k] = np.where(p[k:] == p[:-k], h[k:], 0)
            out.append(later)
        return tuple(out)


def _slices(batches, seed: int):
    for batch in batches:
        langs = pc.fill_null(batch.column("lang"), "und").to_numpy(zero_copy_only=False)
        for low, high, texts in text_slices(batch.column("text")):
            yield texts.nbytes, _Words(texts, langs[low:high], seed)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(3) + second)


def slot_of(pair: np.ndarray) -> np.ndarray:
    return (pair >> np.uint64(50)).astype(np.int64)


def _vocabulary(seed: int):
    """Rows (lang, word, hash, n) of the words of each chunk, and rows (slot, n) of its suffixes by slot."""
    names = ["lang", "word", "hash", "n", "slot"]

    def rows(found: dict) -> pa.RecordBatch:
        values = list(found.values())
        columns = [pa.array([v[0] for v in values], pa.string()), pa.array([v[1] for v in values], pa.binary()).cast(pa.string()), pa.array(list(found), pa.uint64()).view(pa.int64()), pa.array([v[2] for v in values], pa.int64()), pa.nulls(len(values), pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names)

    def count(batches):
        load, found, size = np.zeros(SLOTS, np.int64), {}, 0
        for held, w in _slices(batches, seed):
            if size + held > CHUNK and found:
                yield rows(found)
                found, size = {}, 0
            size += held
            h0, h1, _ = w.suffixes()
            load += np.bincount(slot_of(_pair(h0, h1)[h1 != 0]), minlength=SLOTS)
            hashes, where, n = np.unique(w.hashes, return_index=True, return_counts=True)
            fresh = np.array([h not in found for h in hashes.tolist()], bool) if len(hashes) else np.zeros(0, bool)
            new = iter(w.spelled(where[fresh]))
            for h, lang, many, is_new in zip(hashes.tolist(), w.names[w.lang[where]] if len(where) else (), n.tolist(), fresh):
                if is_new:
                    found[h] = [lang, next(new), many]
                else:
                    found[h][2] += many
        if found:
            yield rows(found)
        full = np.flatnonzero(load)
        nothing = lambda kind: pa.nulls(len(full), kind)
        yield pa.RecordBatch.from_arrays([nothing(pa.string()), nothing(pa.string()), nothing(pa.int64()), pa.array(load[full]), pa.array(full.astype(np.int32))], names)

    return count


def vocabulary(texts: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """((lang, word, hash, n), load of each slot, seed) with a different hash for each word of a language.

    Should two words ever have the same hash, all are hashed anew with the next seed.
    """
    seed = 0
    while True:
        counted = cut_lineage(texts.mapInArrow(_vocabulary(seed), "lang string, word string, hash long, n long, slot int"), "counted", "zstd")
        load = np.zeros(SLOTS, np.int64)
        for r in counted.where("slot is not null").groupBy("slot").agg(F.sum("n").alias("n")).collect():
            load[r.slot] = r.n
        words = cut_lineage(counted.where("slot is null").groupBy("hash", "lang", "word").agg(F.sum("n").alias("n")), "words")
        release(counted)
        if words.groupBy("hash").agg(F.count(F.lit(1)).alias("held")).where("held > 1").isEmpty():
            return words, load, seed
        release(words)
        seed += 1


class Route:
    """Which bucket a suffix goes to; decided by the load of the slots, whose number is fixed."""

    def __init__(self, load: np.ndarray):
        total = int(load.sum())
        self.buckets = max(1, -(-total // BUCKET))
        mean = max(1, total // SLOTS)
        self.parts = np.where(load > CROWDED * mean, -(-load // (CROWDED * mean)), 1).astype(np.uint64)

    def split(self, h0: np.ndarray, h1: np.ndarray) -> np.ndarray:
        """In how many parts the slot of two words is cut."""
        return self.parts[slot_of(_pair(h0, h1))]

    def bucket(self, h0: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        pair = _pair(h0, h1)
        part = mix(h2 + np.uint64(5)) % self.parts[slot_of(pair)]
        return (mix(pair + part) % np.uint64(self.buckets)).astype(np.int64)


def _pack(*columns: np.ndarray) -> bytes:
    return pa.compress(b"".join(c.tobytes() for c in columns), codec="zstd", asbytes=True)


def _routed(seed: int, route: Route):
    """Rows (bucket, words, size, suffixes): the different suffixes of a chunk that go to a bucket, with their counts."""
    names = ["bucket", "words", "size", "suffixes"]

    def rows(parts: list):
        h = [np.concatenate([p[k] for p in parts]) for k in range(WORDS)]
        lexicon, at = np.unique(h[0], return_inverse=True)
        lexicon, at = np.append(np.uint64(0), lexicon), at.astype(np.uint64) + np.uint64(1)
        places = [at, *[np.searchsorted(lexicon, x).astype(np.uint64) for x in h[1:]]]
        keep = places[1] > 0
        width = np.uint64(len(lexicon))
        if int(width) ** 3 < 1 << 64:
            packed, n = np.unique((places[0][keep] * width + places[1][keep]) * width + places[2][keep], return_counts=True)
            p2, rest = packed % width, packed // width
            p0, p1 = rest // width, rest % width
        else:
            order = np.lexsort([p[keep] for p in reversed(places)])
            p0, p1, p2 = (p[keep][order] for p in places)
            edge = np.flatnonzero(np.append(True, (p0[1:] != p0[:-1]) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])))
            p0, p1, p2, n = p0[edge], p1[edge], p2[edge], np.diff(np.append(edge, len(p0)))
        bucket = route.bucket(*(lexicon[p.astype(np.int64)] for p in (p0, p1, p2)))
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(route.buckets + 1))
        out = ([], [], [], [])
        for b in np.flatnonzero(np.diff(edges)):
            take = order[edges[b] : edges[b + 1]]
            used, local = np.unique(np.concatenate([p0[take], p1[take], p2[take]]), return_inverse=True)
            local = local.astype("<u4").reshape(WORDS, -1)
            out[0].append(int(b))
            out[1].append(lexicon[used.astype(np.int64)].astype("<u8").tobytes())
            out[2].append(len(take))
            out[3].append(_pack(np.diff(local[0], prepend=np.uint32(0)), local[1], local[2], n[take].astype("<u4")))
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())], names)

    def send(batches):
        parts, size = [], 0
        for held, w in _slices(batches, seed):
            if size + held > CHUNK and parts:
                yield rows(parts)
                parts, size = [], 0
            if len(w.hashes):
                parts.append(w.suffixes())
                size += held
        if parts:
            yield rows(parts)

    return send


def multikey_quicksort(keys: list[np.ndarray], weight: np.ndarray, least: np.ndarray):
    """Yields (depth, pointer, count) of the equal partitions: one suffix of each and the sum of their weights.

    ``least`` holds, by depth, the smallest sum that matters; a partition below
    it is abandoned unsorted. A key of 0 ends a suffix and heads no partition.
    All partitions of a depth are worked on together: each pass compares every
    pointer with the pivot of its partition and moves it behind the smaller,
    with the equal, or before the larger ones.
    """
    pointers = np.flatnonzero(keys[0])
    starts = np.zeros(min(1, len(pointers)), np.int64)
    for depth, key in enumerate(keys):
        equal = []
        while len(pointers):
            sizes = np.diff(np.append(starts, len(pointers)))
            value = key[pointers]
            three = np.stack([value[starts], value[starts + sizes // 2], value[starts + sizes - 1]])
            pivot = np.repeat(np.sort(three, axis=0)[1], sizes)
            side = np.where(value < pivot, 0, np.where(value == pivot, 1, 2))
            segment = np.repeat(np.arange(len(starts)), sizes)
            group = segment * 3 + side
            held = np.bincount(group, minlength=3 * len(starts))
            sums = np.bincount(group, weights=weight[pointers], minlength=3 * len(starts)).astype(np.int64)
            kept = sums >= least[depth]
            place = np.empty(len(pointers), np.int64)
            offset = np.concatenate([[0], np.cumsum(held)[:-1]])
            for s in range(3):
                mine = side == s
                before = np.cumsum(mine) - mine
                place[mine] = (offset[group] + before - before[starts][segment])[mine]
            moved = np.empty_like(pointers)
            moved[place] = pointers
            owner = np.repeat(np.arange(3 * len(starts)), held)
            same = kept & (np.arange(3 * len(starts)) % 3 == 1) & (held > 0)
            for_next = same[owner]
            ends = np.flatnonzero(same)
            yield depth, moved[offset[ends]], sums[ends]
            if depth + 1 < len(keys):
                equal.append((moved[for_next], held[ends]))
            unequal = kept & ~same & (np.arange(3 * len(starts)) % 3 != 1) & (held > 0)
            pointers = moved[unequal[owner]]
            starts = np.concatenate([[0], np.cumsum(held[unequal])[:-1]]).astype(np.int64) if unequal.any() else np.zeros(0, np.int64)
        if depth + 1 < len(keys):
            pointers = np.concatenate([p for p, _ in equal]) if equal else pointers
            sizes = np.concatenate([s for _, s in equal]) if equal else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            alive = keys[depth + 1][pointers] > 0
            sizes = np.bincount(owner[alive], minlength=len(sizes))
            pointers, sizes = pointers[alive], sizes[sizes > 0]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)


def _counted(route: Route, least: int):
    """Counts of the phrases of a bucket from the suffixes that all chunks sent."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for words, size, packed in zip(rows["words"], rows["size"], rows["suffixes"]):
            lexicon = np.frombuffer(words, "<u8")
            local = np.frombuffer(pa.decompress(packed, decompressed_size=16 * int(size), codec="zstd"), "<u4").reshape(4, -1)
            first = np.cumsum(local[0], dtype=np.uint32)
            parts.append((lexicon[first], lexicon[local[1]], lexicon[local[2]], local[3].astype(np.int64)))
        *keys, weight = (np.concatenate([p[k] for p in parts]) for k in range(4))
        whole = route.split(keys[0], keys[1]) == 1
        found = []
        for these, enough in ((whole, least), (~whole, 1)):
            own = [k[these] for k in keys]
            for depth, at, n in multikey_quicksort(own, weight[these], np.array([enough, enough, least])):
                if depth:
                    found.append([own[0][at], own[1][at], own[2][at] if depth == 2 else np.zeros(len(at), np.uint64), n])
        out = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64) for k in range(4)]
        return pd.DataFrame({"h0": out[0].view(np.int64), "h1": out[1].view(np.int64), "h2": out[2].view(np.int64), "n": out[3].astype(np.int64)})

    return count


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of up to 38 digits."""
    wide = lambda c, digits: f"cast({c} as decimal({digits},0))"
    return F.expr(f"(1000000 * {wide(a, 15)} * {wide(a, 15)}) div ({wide(left, 19)} * {wide(right, 18)})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int | None = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of each language.

    - Texts are lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line
      ends, pieces into words at space and tab. Null and empty texts have none;
      a null ``lang`` counts as ``und``. Repeated rows count as often as they occur.
    - Candidates are phrases of two or three words with at least ``least``
      occurrences inside pieces. score, l and r come from the cut with the
      lowest score, of equal ones the first; all arithmetic is exact.
    - A phrase inside a longer candidate with ``COVERED_PCT`` of its occurrences goes.
    - The first ``top`` of a language by score and occurrences, falling, then by
      the bytes of the phrase; None reports all. No candidates give no rows.
    """
    text_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    words, load, seed = vocabulary(texts)
    route = Route(load)
    sent = texts.mapInArrow(_routed(seed, route), "bucket long, words binary, size long, suffixes binary")
    spread = sent.groupBy("bucket").applyInPandas(_counted(route, least), "h0 long, h1 long, h2 long, n long")
    found = cut_lineage(spread, "phrases")
    pairs = cut_lineage(found.where("h2 = 0").groupBy("h0", "h1").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "pairs")
    triples = cut_lineage(found.where("h2 <> 0").groupBy("h0", "h1", "h2").agg(F.sum("n").alias("a")).where(F.col("a") >= least), "triples")

    release(found)

    around = triples.selectExpr("h0", "h1", "a").unionByName(triples.selectExpr("h1 h0", "h2 h1", "a"))
    covered = around.groupBy("h0", "h1").agg(F.max("a").alias("longer"))
    open_pairs = pairs.join(covered, ["h0", "h1"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED_PCT * F.col("a"))).drop("longer")
    often = words.where(F.col("n") >= least)
    spelled = lambda k: often.select(F.col("hash").alias(f"h{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}"), *(["lang"] if k == 0 else []))
    part = lambda first, name: pairs.select(F.col("h0").alias(f"h{first}"), F.col("h1").alias(f"h{first + 1}"), F.col("a").alias(name))

    two = open_pairs.join(spelled(0), "h0").join(spelled(1), "h1")
    two = two.select("lang", F.concat_ws(" ", "w0", "w1").alias("phrase"), "a", F.col("n0").alias("l"), F.col("n1").alias("r"), _score("a", "n0", "n1").alias("score"))
    three = triples.join(part(0, "n01"), ["h0", "h1"]).join(part(1, "n12"), ["h1", "h2"]).join(spelled(0), "h0").join(spelled(1), "h1").join(spelled(2), "h2")
    three = three.withColumn("one", _score("a", "n0", "n12")).withColumn("two", _score("a", "n01", "n2"))
    early = F.col("one") <= F.col("two")
    either = lambda a, b, name: F.when(early, F.col(a)).otherwise(F.col(b)).alias(name)
    three = three.select("lang", F.concat_ws(" ", "w0", "w1", "w2").alias("phrase"), "a", either("n0", "n01", "l"), either("n12", "n2", "r"), either("one", "two", "score"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
