"""Text similarity of pairs, worked out for a whole Arrow batch at once.

A batch of pairs becomes arrays of code points, and every step of the two
measures is one array operation over all pairs of a slice. Splitting into tokens
and everything that has a closed form stays in the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .nulls import as_col

# Executors get these functions with the task and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of the table of two texts that are held at once, over all pairs of a slice.
CELLS = 1 << 21
#: Second texts from this length on leave out their popular characters when a block is searched.
POPULAR_FROM = 200


class _Texts:
    """Texts as code points in one array."""

    def __init__(self, texts: Sequence[str]):
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(self.sizes) - self.sizes

    def window(self, which: np.ndarray, low: np.ndarray, size: np.ndarray, width: int, fill: int) -> np.ndarray:
        """Characters low .. low + size of the chosen texts, filled up to ``width``."""
        at = np.arange(width)
        place = (self.first[which] + low)[:, None] + at
        inside = at < size[:, None]
        if not len(self.codes):
            return np.full((len(which), width), fill, np.int32)
        return np.where(inside, self.codes[np.minimum(place, len(self.codes) - 1)], fill)


def _slices(wide: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of similar width in slices whose table fits ``CELLS``."""
    order = np.argsort(wide, kind="stable")
    start = 0
    while start < len(order):
        stop = len(order)
        while stop - start > 1 and (stop - start) * int(wide[order[stop - 1]]) > CELLS:
            stop = start + max(1, (stop - start) // 2)
        yield order[start:stop]
        start = stop


def _popular(b: _Texts) -> np.ndarray:
    """Marks characters that make up over a hundredth of a long text."""
    marks = np.zeros(len(b.codes), bool)
    for i in np.flatnonzero(b.sizes >= POPULAR_FROM):
        own = slice(b.first[i], b.first[i] + b.sizes[i])
        _, place, count = np.unique(b.codes[own], return_inverse=True, return_counts=True)
        marks[own] = (count > b.sizes[i] // 100 + 1)[place]
    return marks


def matched_lengths(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Characters in the matching blocks of each pair.

    The longest common block comes first (of equal ones that which starts
    earliest in the left text, then in the right), then the longest ones on
    either side of it, and so on. All blocks of a step are searched together.
    """
    a, b = _Texts(left), _Texts(right)
    marks = _popular(b)
    whole = _Texts.__new__(_Texts)
    whole.codes, whole.sizes, whole.first = np.where(marks, -3, b.codes).astype(np.int32), b.sizes, b.first
    total = np.zeros(len(left), np.int64)
    pair = np.flatnonzero((a.sizes > 0) & (b.sizes > 0))
    todo = np.stack([pair, np.zeros_like(pair), a.sizes[pair], np.zeros_like(pair), b.sizes[pair]], axis=1)
    while len(todo):
        found = []
        for rows in _slices(todo[:, 4] - todo[:, 3]):
            who, alo, ahi, blo, bhi = todo[rows].T
            size, i, j = _longest(a, whole, who, alo, ahi, blo, bhi)
            if marks.any():
                size, i, j = _stretched(a, b, who, alo, ahi, blo, bhi, size, i, j)
            np.add.at(total, who, size)
            before = np.stack([who, alo, i, blo, j], axis=1)
            after = np.stack([who, i + size, ahi, j + size, bhi], axis=1)
            both = np.concatenate([before[size > 0], after[size > 0]])
            found.append(both[(both[:, 2] > both[:, 1]) & (both[:, 4] > both[:, 3])])
        todo = np.concatenate(found)
    return total


def _longest(a: _Texts, b: _Texts, who, alo, ahi, blo, bhi):
    wa, wb = int((ahi - alo).max()), int((bhi - blo).max())
    x, y = a.window(who, alo, ahi - alo, wa, -1), b.window(who, blo, bhi - blo, wb, -2)
    run = np.zeros((len(who), wb + 1), np.int32)
    size, i, j = np.zeros(len(who), np.int64), alo.copy(), blo.copy()
    rows = np.arange(len(who))
    for k in range(wa):
        run[:, 1:] = np.where(y == x[:, k : k + 1], run[:, :-1] + 1, 0)
        end = run.argmax(axis=1)
        here = run[rows, end]
        better = here > size
        size = np.where(better, here, size)
        i, j = np.where(better, alo + k + 1 - here, i), np.where(better, blo + end - here, j)
    return size, i, j


def _stretched(a: _Texts, b: _Texts, who, alo, ahi, blo, bhi, size, i, j):
    """Blocks grown by equal characters on both ends, popular ones too."""
    at = lambda t, place: t.codes[np.clip(t.first[who] + place, 0, len(t.codes) - 1)]
    while (more := (i > alo) & (j > blo) & (at(a, i - 1) == at(b, j - 1))).any():
        i, j, size = i - more, j - more, size + more
    while (more := (i + size < ahi) & (j + size < bhi) & (at(a, i + size) == at(b, j + size))).any():
        size = size + more
    return size, i, j


def common_lengths(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    a, b = _Texts(left), _Texts(right)
    out = np.zeros(len(left), np.int64)
    for rows in _slices(b.sizes):
        wa, wb = int(a.sizes[rows].max()), int(b.sizes[rows].max())
        none = np.zeros_like(rows)
        x, y = a.window(rows, none, a.sizes[rows], wa, -1), b.window(rows, none, b.sizes[rows], wb, -2)
        best = np.zeros((len(rows), wb + 1), np.int32)
        for k in range(wa):
            best[:, 1:] = np.maximum(best[:, 1:], best[:, :-1] + (y == x[:, k : k + 1]))
            np.maximum.accumulate(best, axis=1, out=best)
        out[rows] = best[:, -1]
    return out


def _of_pairs(measure, a: pd.Series, b: pd.Series) -> np.ndarray:
    """``measure`` of the pairs without a null, NaN for the others."""
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[known] = measure(a[known].tolist(), b[known].tolist())
    return out


@F.pandas_udf(T.DoubleType())
def _matched(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_of_pairs(matched_lengths, a, b))


@F.pandas_udf(T.DoubleType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_of_pairs(common_lengths, a, b))


def _ratio(shared: Column, a: Column, b: Column) -> Column:
    size = F.length(a) + F.length(b)
    return F.when(size == 0, 100.0).otherwise(200.0 * shared / size)


def sequence_ratio(a: str | Column, b: str | Column) -> Column:
    """Matching-block ratio of two texts times 100; null if one is missing."""
    left, right = as_col(a), as_col(b)
    return F.when(left.isNotNull() & right.isNotNull(), _ratio(_matched(left, right), left, right))


def _tokens(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")))


def token_set_ratio(a: str | Column, b: str | Column) -> Column:
    """Best similarity of the shared tokens and each side's tokens, times 100; null if one text is missing.

    Shared tokens against a whole side have a closed form, as the side begins
    with them; only the two whole sides are compared character by character.
    """
    left, right = as_col(a), as_col(b)
    x, y = _tokens(left), _tokens(right)
    both = F.array_intersect(x, y)
    core = F.array_join(both, " ")
    text_a, text_b = (F.array_join(F.concat(both, F.array_except(s, both)), " ") for s in (x, y))
    sides = _ratio(_common(text_a, text_b), text_a, text_b)
    n = F.length(core)
    inside = F.when(n > 0, F.greatest(*[200.0 * n / (n + F.length(s)) for s in (text_a, text_b)])).otherwise(0.0)
    score = F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).when((n > 0) & ((F.size(both) == F.size(x)) | (F.size(both) == F.size(y))), 100.0).otherwise(F.greatest(sides, inside))
    return F.when(left.isNotNull() & right.isNotNull(), score)


#: Characters of a text that fit the bits of one number.
BITS = 64


def common_table(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Length of the longest common subsequence of every left text, of at most ``BITS`` characters, with every right one.

    A left text is a row of bits. Each character of the right texts is one step
    for all pairs, in which the lowest set bit of every run between matches
    moves to the match; cleared bits are common characters.
    """
    a, b = _Texts(left), _Texts(right)
    rows, columns = np.arange(len(left)), np.arange(len(right))
    x = a.window(rows, np.zeros_like(rows), a.sizes, int(a.sizes.max(initial=0)), -1)
    y = b.window(columns, np.zeros_like(columns), b.sizes, int(b.sizes.max(initial=0)), -2)
    letters, y = np.unique(y, return_inverse=True)
    y = y.reshape(len(right), -1)
    masks = np.zeros((len(left), len(letters)), np.uint64)
    for k in range(x.shape[1]):
        place = np.minimum(np.searchsorted(letters, x[:, k]), len(letters) - 1)
        masks[rows, place] |= np.where(letters[place] == x[:, k], np.uint64(1) << np.uint64(k), np.uint64(0))
    masks[:, letters == -2] = 0
    bits = np.full((len(left), len(right)), ~np.uint64(0))
    for k in range(y.shape[1]):
        hit = bits & masks[:, y[:, k]]
        bits = (bits + hit) | (bits - hit)
    return np.bitwise_count(~bits).astype(np.int64)


def best_token_sets(names: Sequence[str], others: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(score, place) of the best of the other token sets for every name, the first of equal ones.

    Both are texts of distinct sorted tokens; scores are those of ``token_set_ratio``.
    """
    size_a, size_b = (np.fromiter(map(len, texts), np.int64, len(texts)) for texts in (names, others))
    total = size_a[:, None] + size_b[None, :]
    score = np.zeros((len(names), len(others)))
    short = np.flatnonzero(size_a <= BITS)
    if len(short):
        score[short] = 200.0 * common_table([names[i] for i in short], others) / total[short]
    for i in np.flatnonzero(size_a > BITS):
        score[i] = 200.0 * common_lengths([names[i]] * len(others), others) / total[i]
    tokens = [o.split(" ") for o in others]
    holders: dict[str, list[int]] = {}
    for j, held in enumerate(tokens):
        for w in held:
            holders.setdefault(w, []).append(j)
    where, texts_a, texts_b, core = [], [], [], []
    for i, name in enumerate(names):
        mine = name.split(" ")
        for j in {j for w in mine for j in holders.get(w, ())}:
            theirs = set(tokens[j])
            both = [w for w in mine if w in theirs]
            if len(both) in (len(mine), len(theirs)):
                score[i, j] = 100.0
                continue
            known = set(both)
            where.append((i, j))
            texts_a.append(" ".join([w for w in mine if w not in known]))
            texts_b.append(" ".join([w for w in tokens[j] if w not in known]))
            core.append(sum(map(len, both)) + len(both) - 1)
    if where:
        # both texts begin with the shared tokens and a blank
        n, at = np.array(core), tuple(np.array(where).T)
        common = common_lengths(texts_a, texts_b) + n + 1
        inside = np.maximum(200.0 * n / (n + size_a[at[0]]), 200.0 * n / (n + size_b[at[1]]))
        score[at] = np.maximum(200.0 * common / total[at], inside)
    place = score.argmax(axis=1)
    return score[np.arange(len(names)), place], place


BEST = T.ArrayType(T.StructType([T.StructField("s", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("best_match", T.StringType())]))


@F.arrow_udf(BEST)
def best_of_blocks(names: pa.Array, others: pa.Array) -> pa.Array:
    """For each row the best of ``others`` (best_match, o) for every one of ``names``, with the score."""
    kind = pa.list_(pa.struct([("s", pa.string()), ("score", pa.float64()), ("best_match", pa.string())]))
    out = []
    for mine, theirs in zip(names, others):
        block, rows = mine.as_py(), theirs.as_py()
        score, place = best_token_sets(block, [r["o"] for r in rows])
        out.append([{"s": s, "score": float(v), "best_match": rows[j]["best_match"]} for s, v, j in zip(block, score, place)])
    return pa.array(out, kind)


def lowest_sequence_ratio(left: Column, right: Column) -> Column:
    """Smallest ratio over the paired texts of two arrays."""

    @F.pandas_udf(T.DoubleType())
    def lowest(a: pd.Series, b: pd.Series) -> pd.Series:
        counts = a.str.len().to_numpy().astype(np.int64)
        x, y = [t for row in a for t in row], [t for row in b for t in row]
        size = np.fromiter(map(len, x), np.int64, len(x)) + np.fromiter(map(len, y), np.int64, len(y))
        each = np.where(size > 0, 200.0 * matched_lengths(x, y) / np.maximum(size, 1), 100.0)
        return pd.Series(np.minimum.reduceat(each, np.cumsum(counts) - counts) if len(each) else each)

    return lowest(left, right)
