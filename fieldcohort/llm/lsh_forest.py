"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct five-word shingles. Each tree orders all
signatures by its own rotation of the 128 minimum values. Documents that share
a tree's first four values form a region; inside it they are sorted by the next
values, so neighbours have the longest common prefixes, and crowded regions are
divided by deeper values. Neighbours are candidates and become links only after
a comparison of the full sets.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from . import common, tokens
from .candidates import crowded_regions, link_rounds
from .common import inside, numbered_rows, small, text_batches, text_slices
from .tokens import _stream, mix, shingle_sets

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(tokens)

SHINGLE = 5
TREES, TOP = 32, 4
VALUES = TREES * TOP
#: Values after the first ones by which a crowded region is divided.
LEVELS = 16
SIMILARITY_PCT = 75
#: Trees of the first, cheap round.
QUICK_TREES = 4

XOR = (_stream(3, VALUES) >> np.uint64(32)).astype(np.uint32)[:, None]
ODD = ((_stream(4, VALUES) >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]


def minimums(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of 128 permutations of 32 bits."""
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(high), 4096):
        np.minimum(least, ((high[start : start + 4096] ^ XOR) * ODD).min(axis=1), out=least)
    return least


SIGNED = "uid long, n_shingles long, set_a long, set_b long, signature binary"


def _sign(batches):
    names = ["uid", "n_shingles", "set_a", "set_b", "signature"]
    for batch in batches:
        for low, high, texts in text_slices(batch.column("text")):
            sets = list(shingle_sets(texts))
            sizes = np.array([len(s) for s in sets], np.int64)
            marks = np.array([[mix(s).sum(), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            signatures = [minimums(s).astype(">u4").tobytes() if len(s) else None for s in sets]
            columns = [batch.column("uid")[low:high], pa.array(sizes), pa.array(marks[:, 0].copy()), pa.array(marks[:, 1].copy()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)


def _compare(batches):
    """Keeps the pairs whose full sets have the similarity."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        left = batch.column("ta")
        for low, high, texts in text_slices(left):
            other = [s for _, _, part in text_slices(batch.column("tb")[low:high]) for s in shingle_sets(part)]
            for i, (one, two) in enumerate(zip(shingle_sets(texts), other), low):
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep[i] = 100 * both >= SIMILARITY_PCT * (len(one) + len(two) - both) and both > 0
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def _tokens(batches):
    """(node, token): the hash of each distinct shingle."""
    for batch in batches:
        for low, high, texts in text_slices(batch.column("text")):
            sets = list(shingle_sets(texts))
            nodes = np.repeat(batch.column("uid")[low:high].to_numpy(zero_copy_only=False), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(sets).view(np.int64))], ["node", "token"])


def forest(signed: DataFrame) -> DataFrame:
    """(region, node, n, tree, first): one row per tree and document."""
    tree = F.col("tree")
    rows = signed.select(F.col("uid").alias("node"), F.col("n_shingles").alias("n"), "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    top = F.substring("signature", tree * (4 * TOP) + 1, F.lit(4 * TOP))
    return rows.select(F.xxhash64("tree", top).alias("region"), "node", "n", "tree", (tree < QUICK_TREES).alias("first"))


def deeper_levels(signed: DataFrame):
    """Adds the order inside a region: the last bytes of the values that follow the first four in the rotation."""
    twice = signed.select(F.col("uid").alias("node"), F.concat("signature", "signature").alias("twice"))
    value = lambda i: F.substring("twice", F.col("tree") * (4 * TOP) + 4 * (TOP + i) + 4, F.lit(1))

    def add(rows: DataFrame) -> DataFrame:
        return rows.join(twice, "node").withColumn("ord", F.array(*[value(i) for i in range(LEVELS)])).drop("twice")

    return add


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` (struct ``row``) with n_shingles, component_id, root and keep.

    - component_id: the smallest id of all documents reachable over links of
      documents whose sets have 100 * intersection >= 75 * union.
    - keep: true for one row of each component, that with the smallest id; of
      repeated rows with that id the first.
    - Null, empty or wordless text: no shingles, linked with nothing; its own
      component, so its id and a true keep. A null id is never the smallest
      unless all ids of the component are null; the component_id is then null.
    - Equal sets are collapsed to one node before the search, so exact copies
      cost one signature each and no comparison.
    """
    text_batches(docs.sparkSession)
    rows = numbered_rows(docs)
    whole = rows.select("uid", inside(text).alias("text"))
    signed = cut_lineage(whole.mapInArrow(_sign, SIGNED), "signed")
    known = rows.select("uid", inside(doc_id).alias("id")).join(signed.drop("signature"), "uid")
    classes = cut_lineage(signed.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min("uid").alias("node")), "classes")
    heads = signed.join(classes.select(F.col("node").alias("uid")), "uid", "left_semi")
    members = crowded_regions(forest(heads), deeper_levels(heads))
    wanted = members.select(F.col("node").alias("uid")).distinct()
    wanted = cut_lineage(wanted, "wanted")
    texts = cut_lineage(whole.join(small(wanted), "uid", "left_semi"), "texts")

    def verify(pairs: DataFrame) -> DataFrame:
        full = pairs.join(texts.selectExpr("uid a", "text ta"), "a").join(texts.selectExpr("uid b", "text tb"), "b")
        return full.select("a", "b", "ta", "tb").mapInArrow(_compare, "a long, b long")

    def sets(nodes: DataFrame) -> DataFrame:
        return texts.join(small(nodes.selectExpr("node uid")), "uid", "left_semi").mapInArrow(_tokens, "node long, token long")

    labels = link_rounds(members, verify, f"100 * least(n, m) >= {SIMILARITY_PCT} * greatest(n, m)", sets=sets, percent=SIMILARITY_PCT)
    release(members, wanted, texts)
    if labels is not None:
        classes_rooted = classes.join(labels, "node", "left").select("set_a", "set_b", "n_shingles", F.coalesce("root", "node").alias("root"))
    else:
        classes_rooted = classes.select("set_a", "set_b", "n_shingles", F.col("node").alias("root"))
    placed = cut_lineage(known.join(classes_rooted, ["set_a", "set_b", "n_shingles"], "left").select("uid", "id", "n_shingles", F.coalesce("root", "uid").alias("root")), "placed")
    release(signed, classes)
    low = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    named = placed.join(low, "root")
    first = named.where("id <=> component_id").groupBy("root").agg(F.min("uid").alias("first"))
    decided = named.join(first, "root").select("uid", "n_shingles", "component_id", "root", (F.col("uid") == F.col("first")).alias("keep"))
    return rows.select("uid", "row").join(decided, "uid").drop("uid")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates left."""
    return cluster(docs, doc_id, text).where("keep").select("row.*")
