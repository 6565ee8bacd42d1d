"""A toxicity classifier whose scores do not depend on which group a text mentions.

Logistic regression on the words of a text and their beginnings. For labelled
texts that mention a group, the term is swapped for another of its kind and a
change of the score is penalised, so a neutral mention of a group that labels
often meet in toxic texts does not become evidence itself.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens
from .common import text_batches, text_slices
from .tokens import LOWER, _stream, raw_bytes, run_hashes, runs

for _module in (sys.modules[__name__], common, tokens):
    cloudpickle.register_pickle_by_value(_module)

#: At most about so many labelled rows are learnt from; of more, those with the smallest hash of the id.
SAMPLE = 20_000
#: Words and beginnings used: those that tell most about the label, met in at least so many texts.
FEATURES, LEAST_TEXTS = 4096, 3
#: Bytes of a word's beginning; 0 is the whole word.
BEGINNINGS = (0, 4, 5, 6, 7)
#: A word or beginning is one feature more from each of these numbers of occurrences.
LEVELS = (1, 2, 4)
_LEVEL = _stream(7, len(LEVELS)).view(np.int64)
RIDGE, SWAP_PENALTY, STEPS = 0.3, 5.0, 400

# Identity terms, by kind.
IDENTITIES = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "african", "european", "american", "latino", "arab", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual", "homosexual"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"),
    ("immigrant", "citizen", "refugee", "foreigner", "native"), ("immigrants", "citizens", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic"), ("old", "young", "elderly"),
)
TERMS = tuple(t for group in IDENTITIES for t in group)

#: Letters and digits of ASCII and everything beyond it belong to words.
_INSIDE = np.zeros(256, bool)
_INSIDE[128:] = True
_INSIDE[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True


def feature_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and beginning in every text, as often as it occurs."""
    data, offsets = raw_bytes(texts)
    data = LOWER[data]
    inside = _INSIDE[data]
    starts, first = runs(inside, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    if not len(starts):
        return row, np.zeros(0, np.int64)
    place = np.arange(len(data), dtype=np.int64)
    place -= np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(starts, append=len(data)))])
    out = []
    for size in BEGINNINGS:
        within = inside & (place < size) if size else inside
        out.append((run_hashes(data, within, starts) ^ np.uint64(size * 0x9E3779B97F4A7C1)).view(np.int64))
    return np.tile(row, len(BEGINNINGS)), np.concatenate(out)


def _lists(row: np.ndarray, values: np.ndarray, count: int) -> pa.Array:
    """The values of each row as lists; rows are sorted."""
    ends = np.searchsorted(row, np.arange(count + 1))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _levels(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, sorted by row: each value at each level that its occurrences reach."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (np.diff(row) != 0) | (np.diff(value) != 0)
    starts = np.flatnonzero(fresh)
    held = np.diff(starts, append=len(row))
    rows = [row[starts][held >= level] for level in LEVELS]
    values = [value[starts][held >= level] ^ mark for level, mark in zip(LEVELS, _LEVEL)]
    rows, values = np.concatenate(rows), np.concatenate(values)
    order = np.argsort(rows, kind="stable")
    return rows[order], values[order]


@F.arrow_udf(T.ArrayType(T.LongType()))
def all_features(texts: pa.Array) -> pa.Array:
    parts = [pa.array([], pa.list_(pa.int64()))]
    for _, _, part in text_slices(texts):
        parts.append(_lists(*_levels(*feature_hashes(part)), len(part)))
    return pa.concat_arrays(parts)


class Known:
    """Finds features among a sorted list of hashes; most words are ruled out by a bitmap of their leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.maybe = np.zeros(1 << 16, bool)
        for mark in _LEVEL:
            self.maybe[self._lead(hashes ^ mark)] = True

    @staticmethod
    def _lead(hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) >> np.uint64(48)).astype(np.int64)

    def find(self, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, place in the list) of the features in the list, sorted by row."""
        hit = np.flatnonzero(self.maybe[self._lead(hashes)])
        row, hashes = _levels(row[hit], hashes[hit])
        if not len(self.hashes):
            return row[:0], row[:0]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        same = self.hashes[at] == hashes
        return row[same], at[same]


def known_features(hashes: np.ndarray):
    known = Known(hashes)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def find(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.list_(pa.int64()))]
        for _, _, part in text_slices(texts):
            parts.append(_lists(*known.find(*feature_hashes(part)), len(part)))
        return pa.concat_arrays(parts)

    return find


def scorer(hashes: np.ndarray, weights: np.ndarray, bias: float):
    known = Known(hashes)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, _, part in text_slices(texts):
            row, at = known.find(*feature_hashes(part))
            logit = bias + np.bincount(row, weights=weights[at], minlength=len(part))
            out.append(1 / (1 + np.exp(-np.clip(logit, -500, 500))))
        return pa.array(np.concatenate(out))

    return score


def term_features() -> list[np.ndarray]:
    """The hashes of each identity term's features, the whole word first."""
    row, hashes = feature_hashes(pa.array(TERMS, pa.large_string()))
    hashes = hashes ^ _LEVEL[0]
    return [hashes[row == i] for i in range(len(TERMS))]


def _counts(row: np.ndarray, values: np.ndarray, wanted: np.ndarray, rows: int) -> np.ndarray:
    """How often each of the sorted ``wanted`` hashes occurs in each text."""
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    hit = wanted[at] == values
    return np.bincount(row[hit] * len(wanted) + at[hit], minlength=rows * len(wanted)).reshape(rows, len(wanted))


def swap_changes(hashes: np.ndarray):
    """For each text, the sentence with an identity term swapped for another of its kind, for every such pair.

    Given as what changes: how many others the kind has, then the places among
    ``hashes`` of the features that come (place + 1) or go (-place - 1), of all
    levels. A pair that changes no known feature is left out.
    """
    row, own = feature_hashes(pa.array(TERMS, pa.large_string()))
    terms = [own[row == i] for i in range(len(TERMS))]
    wanted = np.unique(own)
    spots = [np.searchsorted(wanted, t) for t in terms]
    place = {}
    for number, (level, mark) in enumerate(zip(LEVELS, _LEVEL)):
        at = np.minimum(np.searchsorted(hashes, wanted ^ mark), max(len(hashes) - 1, 0))
        for k in np.flatnonzero(hashes[at] == (wanted ^ mark)) if len(hashes) else ():
            place[int(k), number] = int(at[k])
    kinds, start = {}, 0
    for group in IDENTITIES:
        kinds |= {t: [o for o in range(start, start + len(group)) if o != t] for t in range(start, start + len(group))}
        start += len(group)

    def changes(held: np.ndarray) -> list[list[int]]:
        out = []
        for t, others in kinds.items():
            times = held[spots[t][0]]
            if not times:
                continue
            for other in others:
                after = held.copy()
                np.subtract.at(after, spots[t], times)
                np.add.at(after, spots[other], times)
                moved = [len(others)]
                for k in np.flatnonzero(after != held).tolist():
                    for number, level in enumerate(LEVELS):
                        if (k, number) in place and (held[k] >= level) != (after[k] >= level):
                            moved.append((place[k, number] + 1) * (1 if after[k] >= level else -1))
                if len(moved) > 1:
                    out.append([moved[0], *sorted(moved[1:])])
        return out

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.LongType())))
    def swapped(texts: pa.Array) -> pa.Array:
        found = []
        for _, _, part in text_slices(texts):
            held = _counts(*feature_hashes(part), wanted, len(part))
            found += [changes(h) for h in held]
        return pa.array(found, pa.list_(pa.list_(pa.int64())))

    return swapped


def bare_swaps(hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Each term alone swapped for each other of its kind, once for each kind's term."""
    terms = [np.searchsorted(hashes, t) for t in term_features()]
    out, start = [], 0
    for group in IDENTITIES:
        for t in range(start, start + len(group)):
            for other in range(start, start + len(group)):
                change = np.zeros(len(hashes))
                change[terms[t]] -= 1
                change[terms[other]] += 1
                columns = np.flatnonzero(change)
                if len(columns):
                    out.append((columns, change[columns], 1 / (len(group) - 1)))
        start += len(group)
    return out


def train(row: np.ndarray, column: np.ndarray, label: np.ndarray, width: int, differences: list[tuple[np.ndarray, np.ndarray, float]], penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, float]:
    """(weights, bias) of the regularised regression, by accelerated gradient steps.

    Minimises the log loss plus RIDGE |w|^2 / 2 plus, for each difference
    (columns, signs, times), penalty * times * (change of the logit)^2 / 2.
    """
    held = np.bincount(row, minlength=len(label))
    base = float(np.clip(label.mean() if len(label) else 0.5, 1e-3, 1 - 1e-3))
    point = np.concatenate([np.zeros(width), [np.log(base / (1 - base))]])
    many = np.array([len(columns) for columns, _, _ in differences], int)
    pair = np.repeat(np.arange(len(differences)), many)
    moved = np.concatenate([columns for columns, _, _ in differences]) if len(many) else np.zeros(0, int)
    sign = np.concatenate([signs for _, signs, _ in differences]) if len(many) else np.zeros(0)
    cost = penalty * np.array([times for _, _, times in differences])
    extra = np.bincount(moved, weights=(cost * many)[pair], minlength=width)
    # a diagonal bound of the curvature: each row spreads a quarter over its columns
    spread = np.bincount(column, weights=0.25 * (held[row] + 1.0), minlength=width)
    step_sizes = 1 / np.concatenate([spread + RIDGE + extra, [max(1.0, 0.25 * float((held + 1).sum()))]])
    now, ahead, pace = point.copy(), point.copy(), 1.0
    for _ in range(STEPS):
        logit = ahead[width] + np.bincount(row, weights=ahead[column], minlength=len(label))
        off = 1 / (1 + np.exp(-np.clip(logit, -500, 500))) - label
        gradient = np.concatenate([np.bincount(column, weights=off[row], minlength=width) + RIDGE * ahead[:width], [off.sum()]])
        change = np.bincount(pair, weights=ahead[moved] * sign, minlength=len(many))
        gradient[:width] += np.bincount(moved, weights=(cost * change)[pair] * sign, minlength=width)
        after = ahead - step_sizes * gradient
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = after + (pace - 1) / faster * (after - now)
        now, pace = after, faster
    return now[:width], float(now[width])


def informative(features: DataFrame, rows: int, positive: int) -> np.ndarray:
    """The hashes of the features that tell most about the label, by the G statistic; ``features``: (feature, label)."""
    counts = features.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")).where(F.col("n") >= LEAST_TEXTS)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = positive / rows
    n, k = F.col("n"), F.col("k")
    other = part(F.lit(positive) - k, (F.lit(rows) - n) * share) + part(F.lit(rows - positive) - (n - k), (F.lit(rows) - n) * (1 - share))
    told = part(k, n * share) + part(n - k, n * (1 - share)) + other
    best = counts.withColumn("told", told).orderBy(F.desc("told"), "feature").limit(FEATURES)
    return best.select("feature").toPandas()["feature"].to_numpy(np.int64)


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, np.ndarray, float]:
    """(hashes, weights, bias) from the labelled rows of ``docs`` for which ``learn_from`` holds.

    A document with several labels is toxic if one says so; null labels and ids
    are left out. With labels of one value only, or none, nothing but the bias
    is learnt.
    """
    text_batches(docs.sparkSession)
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where("id is not null and label is not null")
    known = known.groupBy("id").agg(F.max("label").alias("label")).withColumnRenamed("id", doc_id).where(learn_from).withColumnRenamed(doc_id, "id")
    count = known.count()
    kept = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / max(1, count))))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(kept), "id")
    each = texts.select("label", F.explode(all_features(F.col("text"))).alias("feature"))
    rows, positive = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    chosen = informative(each, rows, positive) if 0 < positive < rows else np.zeros(0, np.int64)
    terms = term_features()
    hashes = np.unique(np.concatenate([chosen, *terms]))
    found = texts.select("label", known_features(hashes)(F.col("text")).alias("features")).toPandas()
    target = found["label"].to_numpy(float)
    sizes = np.array([len(f) for f in found["features"]], int)
    row = np.repeat(np.arange(len(found)), sizes)
    column = np.concatenate([np.asarray(f, int) for f in found["features"]]) if len(found) else np.zeros(0, int)
    if not 0 < positive < rows:
        return hashes, np.zeros(len(hashes)), 0.0 if not rows else float(np.log((positive + 1) / (rows - positive + 1)))

    pairs = texts.select(F.explode(swap_changes(hashes)(F.col("text"))).alias("change"))
    differences = bare_swaps(hashes)
    for r in pairs.groupBy("change").agg(F.count(F.lit(1)).alias("times")).collect():
        moved = np.array(r.change[1:])
        differences.append((np.abs(moved) - 1, np.sign(moved).astype(float), r.times / r.change[0]))
    weights, bias = train(row, column, target, len(hashes), differences, penalty)
    return hashes, weights, bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text") -> DataFrame:
    """Every row's other columns (struct ``row``) with ``score``, from 0 to 1.

    Whole texts are read; null and empty ones get the score of the bias. Equal
    texts get equal scores. The model has a fixed size, whatever it learnt from.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(F.struct(*others).alias("row"), scorer(*model)(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("score"))
