"""Candidates for a similarity join of short texts, by prefix filtering.

Two texts of la and lb characters with a similarity of at least t share a common
subsequence of m >= t * (la + lb) / 2 characters. Every other character breaks at
most q of the character runs of length q (grams) of its own text, and q - 1 of
the other's where it is put in. So the texts share a known number of grams, and
when the grams of a text are ordered by how rare they are, two such texts have
one in common among the first few of each: all but as many as they must share.
A text is found under those alone, at most one key for each of its characters.
Where even the rarest gram that two texts share is frequent, the next one is
too, and with one place more of each both are among the first. So frequent grams
are no keys, but each two of them are: no key of one gram has many texts, and
pairs grow with the number of texts and not with its square.

The length of the grams follows from la + lb, which both sides agree on: the
longest for which at least two must be shared. Texts that may have partners on
both sides of such a border have keys of both lengths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .latest import join_group_rows

#: Longest grams first, with the least share of both texts that shared grams must make up.
LENGTHS = ((3, 0.2), (2, 0.1), (1, 0.0))
#: A gram of more texts is frequent.
CROWD = 64
EPS = 1e-9


def _share(q: int, t: float | Column):
    """Shared grams for each character of both texts together."""
    return t * ((2 * q - 1) / 2) - (q - 1)


def _usable(t: float) -> list[tuple[int, int]]:
    """(q, least la + lb) of the gram lengths for a threshold, longest first."""
    if not 0 < t <= 1:
        raise ValueError("the threshold must be over 0 and at most 100")
    return [(q, 1 if q == 1 else math.floor(q / _share(q, t)) + 1) for q, least in LENGTHS if _share(q, t) > least]


def shortest_partner(length: Column, t: float | Column) -> Column:
    return F.greatest(F.ceil(length * t / (2 - t) - EPS), F.lit(1))


def longest_partner(length: Column, t: float | Column) -> Column:
    return F.floor(length * (2 - t) / t + EPS)


def similar_lengths(la: Column, lb: Column, t: float | Column) -> Column:
    return 2 * F.least(la, lb) >= t * (la + lb) - EPS


def similar_places(la: Column, lb: Column, pa: Column, pb: Column, t: float) -> Column:
    """Can a gram at these places lie in both texts' common subsequence?"""
    m = F.ceil(t * (la + lb) / 2 - EPS)
    return (pa - pb <= la - m) & (pb - pa <= lb - m)


def _grams(text: Column, length: Column, spaces: bool) -> Column:
    """array<struct<q, g, p>>: all grams and where they begin; without ``spaces`` none with a space is taken, but single characters."""

    def of(q: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), length - q), lambda i: F.struct(F.lit(q).alias("q"), F.substr(text, i + 1, F.lit(q)).alias("g"), i.alias("p")))
        each = each if spaces or q == 1 else F.filter(each, lambda x: ~x["g"].contains(" "))
        return F.when(length >= q, each).otherwise(F.array().cast("array<struct<q:int,g:string,p:int>>"))

    return F.concat(*[of(q) for q, _ in LENGTHS])


def ordered_grams(texts: DataFrame, among: DataFrame, keep: list[str], spaces: bool = True) -> DataFrame:
    """(id, keep, text, len, grams) of the texts, grams sorted by length and rarity in ``among``.

    Both have the columns id, group and text; grams of different groups are
    different. Grams are counted with map-side combine, and their counts meet
    them again without piling up a frequent one in one task.
    """
    each = lambda df: df.select("id", "group", F.explode(_grams(F.col("text"), F.length("text"), spaces)).alias("x")).select("id", "group", "x.*")
    held = each(among).groupBy("group", "q", "g").agg(F.count(F.lit(1)).alias("n"))
    counted = join_group_rows(each(texts), held.withColumn("held", F.col("n")), ["group", "q", "g"], "held")
    sorted_grams = F.sort_array(F.collect_list(F.struct("q", F.coalesce("n", F.lit(0)).alias("n"), "g", "p")))
    gathered = counted.groupBy("id").agg(sorted_grams.alias("grams"))
    return cut_lineage(texts.select("id", "group", *keep, "text", F.length("text").alias("len")).join(gathered, "id"), "grams")


def _of_length(q: int) -> Column:
    return F.filter("grams", lambda x: x["q"] == q)


def prefix(ordered: DataFrame, t: float, own: Column | None = None) -> DataFrame:
    """``ordered`` with ``keys``: array<struct<key, p>> of the grams under which a text is found.

    Two texts of a group with a similarity of at least ``t`` have a key in
    common. ``own`` may ask for a higher similarity of single rows.
    """
    threshold = F.lit(t) if own is None else own
    la, usable = F.col("len"), _usable(t)
    low, high = la + shortest_partner(la, threshold), la + longest_partner(la, threshold)

    def upto(mine: Column, size: Column) -> Column:
        last = F.get(mine, size - 1)
        near = F.filter(mine, lambda x: (x["n"] < last["n"]) | (x["n"] == last["n"]) & (x["g"] <= last["g"]))
        return F.when(last.isNull(), mine).otherwise(near)

    def place(*grams: Column) -> Column:
        key = F.concat_ws("\x1f", F.col("group").cast("string"), grams[0]["q"].cast("string"), *[x["g"] for x in grams])
        return F.struct(key.alias("key"), grams[0]["p"].alias("p"))

    def take(q: int, both: Column) -> Column:
        mine = _of_length(q)
        size = F.greatest(F.floor(la - _share(q, threshold) * both + 1 + EPS), F.lit(1)).cast("int")
        single = F.filter(upto(mine, size), lambda x: (x["n"] <= CROWD) | (F.size(mine) - size + 1 < 2))
        crowded = F.filter(upto(mine, size + 1), lambda x: x["n"] > CROWD)
        two = F.flatten(F.transform(crowded, lambda x, i: F.transform(F.slice(crowded, i + 2, F.size(crowded)), lambda y: place(x, y))))
        return F.concat(F.transform(single, lambda x: place(x)), two)

    found = []
    for i, (q, least) in enumerate(usable):
        first = F.greatest(low, F.lit(least))
        active = first <= (F.least(high, F.lit(usable[i - 1][1] - 1)) if i else high)
        found.append(F.when(active, take(q, first)))
        if q > 1:  # too few grams to be sure of a shared one: single characters as well
            few = F.size(_of_length(q)) < la - _share(q, threshold) * first + 1 - EPS
            found.append(F.when(active & few, take(1, first)))
    empty = F.array().cast("array<struct<key:string,p:int>>")
    return ordered.withColumn("keys", F.array_distinct(F.concat(*[F.coalesce(f, empty) for f in found])))
