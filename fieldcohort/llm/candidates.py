"""Rounds of candidate pairs and exact verification, as DataFrame operations only.

Two rounds compare members of a region (an LSH bucket) with a bounded number of
others: their neighbours in the region's order and the region's first member.
They link most copies, and what is linked need not be compared again. The last
round is exact: of the members of regions that are still mixed it finds every
pair that can have the similarity. Regions whose members were all neighbours are
done, those of a bounded size are compared pair by pair, and the others by the
rarest elements of their members' sets. Members without sets are compared in the
leaves of their region instead, which bounds the pairs and may miss some.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_shuffles, release
from .common import small
from .components import relabel

#: A test of two members, given their columns by name.
Fits = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]

#: A region with more members is cut by its deeper order, once more for each doubling of this.
CROWD = 512
#: A part is compared when its members outside the largest component, times all its members, are at most the square of this.
LEAF = 32


def crowded_regions(rows: DataFrame, deepen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(region, part, ord, node, n, first) of the regions that hold at least two nodes.

    ``ord``, an array of longs, holds the deeper levels of the region's order;
    ``deepen`` adds it where ``rows`` have none. A region of more than ``CROWD`` members is divided by as many levels
    as its size calls for: depth adapts to each region. Regions are counted
    with map-side combine and the counts joined back, so none is gathered here.
    """
    held = cut_lineage(rows.groupBy("region").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "held")
    drop_shuffles(rows.sparkSession)
    kept = rows.join(small(held), "region")
    kept = deepen(kept) if deepen else kept
    depth = F.ceil(F.log2(F.col("held") / CROWD))
    depth = F.greatest(F.least(depth, F.size("ord")), F.lit(1)).cast("int")
    deeper = F.when(F.col("held") > CROWD, F.xxhash64("region", F.slice("ord", F.lit(1), depth)))
    placed = cut_lineage(kept.select("region", F.coalesce(deeper, F.lit(0).cast("long")).alias("part"), "ord", "node", "n", "first"), "regions")
    drop_shuffles(rows.sparkSession)
    # parts that their order does not divide: the first member still meets all
    full = placed.where("part <> 0").groupBy("region", "part").agg(F.count(F.lit(1)).alias("full")).where(F.col("full") > 2 * CROWD)
    full = cut_lineage(full, "full")
    share = F.pmod(F.xxhash64("node"), F.ceil(F.col("full") / CROWD))
    spread = placed.join(small(full), ["region", "part"], "left").withColumn("part", F.when(F.col("full").isNull(), F.col("part")).otherwise(F.xxhash64("part", share)))
    found = cut_lineage(spread.drop("full"), "regions")
    release(held, placed, full)
    return found


def neighbour_pairs(members: DataFrame, reach: int, fits: str) -> DataFrame:
    """Pairs (a, b), a < b, of neighbours with different labels; ``fits`` is SQL over the sizes n and m."""
    place = Window.partitionBy("region", "part").orderBy("ord", "node")
    me = ["node", "label", "n"]
    others = [F.lag(F.struct(*me), k).over(place) for k in range(1, reach + 1)]
    head = members.groupBy("region").agg(F.min(F.struct(*me)).alias("head"))
    beside = members.select(*me, F.array(*others).alias("others")).select(*me, F.explode("others").alias("other"))
    led = members.join(head, "region").select(*me, F.col("head").alias("other"))
    pairs = beside.unionByName(led).where("other is not null and other.label <> label")
    pairs = pairs.selectExpr("least(node, other.node) a", "greatest(node, other.node) b", "n", "other.n m").where(fits)
    return pairs.select("a", "b").distinct()


def leaf_pairs(members: DataFrame, fits: Fits) -> DataFrame:
    """Pairs (a, b), a < b, of members of a leaf with different labels that ``fits`` lets pass.

    Every member stands in the parts of its region of all depths. A leaf is the
    largest part whose members outside its main component make few pairs with
    each other and the main component's: at most the square of ``LEAF``. So no
    member is compared with more than ``LEAF`` others on average. A part that
    no depth divides, so that even the whole order is equal, has its outside
    members meet the first member of the main component and the first outside of
    it. This is for members without sets: pairs of different parts are not met.
    """
    mixed = members.groupBy("region").agg((F.min("label") < F.max("label")).alias("mixed")).where("mixed").select("region")
    keys = F.transform(F.sequence(F.lit(0), F.size("ord")), lambda depth: F.xxhash64("region", depth, F.slice("ord", F.lit(1), depth)))
    rows = members.join(mixed, "region").select("node", "label", "n", keys.alias("keys"), F.size("ord").alias("last"))
    rows = rows.select("node", "label", "n", "last", F.posexplode("keys").alias("depth", "key"), "keys").withColumn("above", F.get("keys", F.col("depth") - 1)).drop("keys")
    rows = cut_lineage(rows, "parts")
    labels = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("held"), F.min("node").alias("head"), F.first("above").alias("above"), F.first(F.col("depth") == F.col("last")).alias("ends"))
    sides = labels.groupBy("key").agg(F.max_by(F.struct("label", "head"), F.struct("held", "label")).alias("main"), (F.sum("held") - F.max("held")).alias("outer"), F.sum("held").alias("all"), F.first("above").alias("above"), F.first("ends").alias("ends"))
    few = (F.col("outer") * F.col("all") <= LEAF * LEAF).alias("small")
    sides = cut_lineage(sides.where("outer > 0").select("key", F.col("main.label").alias("main"), F.col("main.head").alias("head"), "above", "ends", few), "sides")
    crowded = sides.where(~F.col("small")).select("key")
    open_parts = sides.where(F.col("above").isNull()).unionByName(sides.join(crowded.select(F.col("key").alias("above")), "above", "left_semi"))
    leaves = cut_lineage(open_parts.where(F.col("small") | F.col("ends")).select("key", "main", "head", "small"), "leaves")

    now = rows.join(small(leaves), "key")
    own = ["node", "label", "n"]
    outside = now.where("label <> main")
    out = outside.where("small").select("key", *[F.col(c).alias(f"a_{c}") for c in own])
    whole = now.where("small").select("key", (F.col("label") == F.col("main")).alias("inside"), *[F.col(c).alias(f"b_{c}") for c in own])
    agree = fits(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"))
    met = out.join(whole, "key").where((F.col("a_label") != F.col("b_label")) & (F.col("inside") | (F.col("a_node") < F.col("b_node"))) & agree).selectExpr("a_node x", "b_node y")
    first = outside.where("not small").groupBy("key").agg(F.min("node").alias("second"))
    led = outside.where("not small").join(first, "key").select(F.col("node").alias("x"), F.explode(F.array("head", "second")).alias("y")).where("x <> y")
    pairs = cut_lineage(met.unionByName(led).selectExpr("least(x, y) a", "greatest(x, y) b").distinct(), "remaining")
    release(rows, sides, leaves)
    return pairs


def rare_pairs(members: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Pairs (a, b), a < b, with different labels that can have the similarity, of all members of mixed regions.

    ``sets`` gives the distinct elements (node, token) of the nodes it gets. With
    elements in one order, the rarest first, the first common element of two sets
    A and B with 100 * intersection >= percent * union has at most
    |B| - percent * |B| / 100 elements of B before it, and of the smaller set A at
    most |A| - 2 * percent * |A| / (100 + percent); from it on both hold enough
    for the intersection. So no pair is lost, however large a region is. An
    element's members outside its main component meet all others, those of the
    main component only the ones outside.
    """
    mixed = members.groupBy("region").agg((F.min("label") < F.max("label")).alias("mixed")).where("mixed").select("region")
    nodes = cut_lineage(members.join(mixed, "region").select("node", "label").distinct(), "open")
    held = cut_lineage(sets(nodes.select("node")), "tokens")
    drop_shuffles(members.sparkSession)
    shared = held.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    ranked = held.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("tokens"))
    sized = held.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    # elements that no other member has come first and need no place
    alone = F.col("n") - F.size("tokens")
    known = ranked.join(sized, "node").join(nodes, "node").withColumn("alone", alone)
    first = known.withColumn("begin", F.expr(f"slice(tokens, 1, cast(greatest(n - ({percent} * n + 99) div 100 + 1 - alone, 0) as int))"))
    placed = first.select("node", "label", "n", "alone", F.posexplode("begin").alias("k", "token"))
    placed = placed.select("node", "label", "n", F.col("token.token").alias("token"), (F.col("n") - F.col("alone") - F.col("k")).alias("behind"))
    placed = cut_lineage(placed, "postings")
    release(held)
    drop_shuffles(members.sparkSession)
    index = F.expr(f"{100 + percent} * behind >= {2 * percent} * n")
    labels = placed.groupBy("token", "label").agg(F.count(F.lit(1)).alias("held"), F.max(index).alias("index"))
    sides = labels.groupBy("token").agg(F.max_by("label", F.struct("held", "label")).alias("main"), F.count(F.lit(1)).alias("labels"), F.max("index").alias("index"))
    sides = sides.where("labels > 1 and index").select("token", "main")
    now = cut_lineage(placed.join(sides, "token").withColumn("outside", F.col("label") != F.col("main")).drop("main"), "postings")
    small_side = now.where(index).selectExpr("token", "node x", "label lx", "n nx", "behind bx", "outside ox")
    large_side = now.selectExpr("token", "node y", "label ly", "n ny", "behind b_y", "outside oy")
    reach = f"lx <> ly and (nx < ny or nx = ny and x < y) and 100 * nx >= {percent} * ny and {100 + percent} * least(bx, b_y) >= {percent} * (nx + ny)"
    met = small_side.where("ox").join(large_side, "token").where(reach).unionByName(small_side.where("not ox").join(large_side.where("oy"), "token").where(reach))
    pairs = cut_lineage(met.selectExpr("least(x, y) a", "greatest(x, y) b").distinct(), "remaining")
    release(nodes, placed, now)
    return pairs


def open_pairs(members: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int, reach: int, whole: int, fits: str) -> DataFrame:
    """Pairs (a, b), a < b, with different labels that can have the similarity, of regions not compared as a whole yet.

    All members of an undivided region of at most ``reach`` + 1 were neighbours
    and met in the round before. Regions of up to ``whole`` members make all their
    pairs, at most half of ``whole`` a member; larger ones go to ``rare_pairs``.
    """
    held = members.groupBy("region").agg(F.count(F.lit(1)).alias("held"), (F.min("label") < F.max("label")).alias("mixed"), (F.min("part") < F.max("part")).alias("divided"))
    left = cut_lineage(held.where(f"mixed and (divided or held > {reach + 1})").select("region", (F.col("divided") | (F.col("held") > whole)).alias("large")), "left")
    pairs = None
    if not left.where("not large").isEmpty():
        now = members.join(small(left.where("not large")), "region")
        one = now.selectExpr("region", "node a", "label la", "n")
        two = now.selectExpr("region", "node b", "label lb", "n m")
        pairs = one.join(two, "region").where(f"a < b and la <> lb and ({fits})").select("a", "b").distinct()
    if pairs is None or not left.where("large").isEmpty():
        rare = rare_pairs(members.join(small(left.where("large")), "region"), sets, percent)
        pairs = rare if pairs is None else pairs.unionByName(rare).distinct()
    found = cut_lineage(pairs, "remaining")
    release(left)
    return found


def link_rounds(members: DataFrame, verify: Callable[[DataFrame], DataFrame], fits: str, agree: Fits | None = None, reach: int = 8, sets: Callable[[DataFrame], DataFrame] | None = None, percent: int = 100, whole: int = 0) -> DataFrame | None:
    """(node, root) of all nodes with a verified link; None without any.

    ``fits`` is SQL over the sizes n and m of a pair. The last round is
    ``open_pairs`` of the ``sets``, with links at ``percent``; without them it is
    ``leaf_pairs`` with the test ``agree``.

    ``members``: region, part, ord, node, n and ``first``, true for the regions
    that the cheap first round uses. ``verify`` keeps the pairs that are links.
    """
    labels, checked = None, []
    for step in ("quick", "near", "all"):
        now = members.where("first") if step == "quick" else members
        if labels is None:
            now = now.withColumn("label", F.col("node"))
        else:
            now = now.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
        if step == "near" and labels is not None:
            mixed = now.groupBy("region").agg((F.min("label") < F.max("label")).alias("mixed")).where("mixed")
            now = now.join(mixed.select("region"), "region")
        met = None
        if step == "all":
            met = open_pairs(now, sets, percent, reach, whole, fits) if sets else leaf_pairs(now, agree)
        found = neighbour_pairs(now, 1 if step == "quick" else reach, fits) if met is None else met
        for old in checked:
            found = found.join(old, ["a", "b"], "left_anti")
        pairs = cut_lineage(found, "pairs")
        checked.append(pairs)
        drop_shuffles(members.sparkSession)
        links = cut_lineage(verify(pairs), "verified")
        drop_shuffles(members.sparkSession)
        if met is not None:
            release(met)
        if not links.isEmpty():
            labels = relabel(labels, links)
        release(links)
        drop_shuffles(members.sparkSession)
    release(*checked)
    return labels
