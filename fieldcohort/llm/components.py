"""Connected components of links between numbered nodes, as a distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is its smallest node.

    Each round joins a node and all its neighbours to the smallest of them.
    The smallest is grouped with map-side combine, so a hub is never gathered.
    Rounds go on until the links no longer change; then each node has one link,
    to its root. Null ends and links of a node to itself are ignored. The
    result lies in the shared folder.
    """
    now = cut_lineage(links.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
        if mark == before:
            break
        before = mark
        both = now.unionByName(now.selectExpr("b a", "a b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        starred = both.join(low, "a").selectExpr("b a", "low b").unionByName(low.selectExpr("a", "low b"))
        after = cut_lineage(starred.where("a <> b").distinct(), "links")
        release(now)
        now = after
    roots = now.selectExpr("a node", "b root")
    found = cut_lineage(roots.unionByName(roots.selectExpr("root node", "root").distinct()), "roots")
    release(now)
    return found


def relabel(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after adding links to earlier labels; nodes without links have no row."""
    if labels is None:
        return components(links)
    ends = links
    for end in ("a", "b"):
        ends = ends.join(labels.selectExpr(f"node {end}", f"root _{end}"), end, "left").withColumn(end, F.expr(f"coalesce(_{end}, {end})")).drop(f"_{end}")
    merged = components(ends)
    moved = labels.join(merged.selectExpr("node root", "root top"), "root", "left").selectExpr("node", "coalesce(top, root) root")
    fresh = merged.join(moved.select("node"), "node", "left_anti")
    out = cut_lineage(moved.unionByName(fresh), "labels")
    release(merged, labels)
    return out
