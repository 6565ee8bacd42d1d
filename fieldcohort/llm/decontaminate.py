"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a span of words of which a fixed mask ignores some, so a substituted
word at an ignored place does not lose the hit. Seed hashes of the benchmark
are joined with those of every training position; each hit fixes an alignment
of a document and an item, and the alignment counts only if enough words around
the hit are equal, place by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .common import inside, numbered_rows, small

#: Each mask spans twelve words and looks at six of them. In a passage of 15
#: words some seed survives any two substitutions, and 98 % of all threes.
MASKS = ("101000111001", "101111000001", "100010010111")
SPAN = 12
#: Words compared before and after a seed.
MARGIN = 4
#: An alignment counts from this many equal words, and this share of the words compared.
MIN_EQUAL, MIN_SHARE_PCT = 10, 60

#: Words are parted by white space and ASCII punctuation and compared in lower case.
PARTING = "[\\s\\p{Punct}]+"


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), PARTING), lambda w: w != "")


def _hashes(text: Column) -> Column:
    return F.transform(word_array(text), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, place, seed): one row per mask and place; ``words`` is an array of word hashes."""
    places = F.sequence(F.lit(0), F.size("words") - SPAN)
    spans = rows.where(F.size("words") >= SPAN).select(*keep, "words", F.explode(places).alias("place"))
    keys = []
    for number, mask in enumerate(MASKS):
        seen = [F.get("words", F.col("place") + i) for i, bit in enumerate(mask) if bit == "1"]
        keys.append(F.xxhash64(F.lit(number), *seen))
    return spans.select(*keep, "place", F.explode(F.array(*keys)).alias("seed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(uid, doc_id, item_id, n_equal): documents that hold a passage of an item, one row per pair.

    ``n_equal`` is the largest number of equal words around a hit: of the seed's
    span and up to four words on each side, as far as both texts go. A pair
    counts from ten equal words that are 60 % of those compared. Items with
    fewer than twelve words are too short to be evidence and never match; null
    and empty texts have no words. Repeated rows and items are each reported by
    their own id; null ids stay null.
    """
    return _contaminated(numbered_rows(docs), benchmark, doc_id, text, item_id, item_text)


def _contaminated(rows: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, item_text: str) -> DataFrame:
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), _hashes(F.col(f"`{item_text}`")).alias("words")).distinct()
    items = cut_lineage(items.withColumn("item", F.monotonically_increasing_id()), "items")
    seeds = cut_lineage(_seeds(items, "item").distinct(), "seeds")

    words = rows.select("uid", _hashes(inside(text)).alias("words"))
    hits = _seeds(words, "uid").join(small(seeds.select("seed").distinct()), "seed", "left_semi")
    hits = cut_lineage(hits, "hits")
    aligned = hits.join(seeds.withColumnRenamed("place", "at"), "seed")
    aligned = aligned.groupBy("uid", "item", (F.col("place") - F.col("at")).alias("shift")).agg(F.sort_array(F.collect_set("at")).alias("spots"))

    held = rows.join(small(hits.select("uid").distinct()), "uid", "left_semi")
    held = cut_lineage(held.select("uid", inside(doc_id).alias("doc_id"), _hashes(inside(text)).alias("theirs")), "held")
    full = aligned.join(held, "uid").join(items.select("item", "item_id", F.col("words").alias("ours")), "item")

    def equal_around(at: Column) -> Column:
        first = F.greatest(at - MARGIN, F.lit(0), -F.col("shift"))
        last = F.least(at + SPAN + MARGIN, F.size("ours"), F.size("theirs") - F.col("shift")) - 1
        same = F.filter(F.sequence(first, last), lambda k: F.get("ours", k) == F.get("theirs", k + F.col("shift")))
        count = F.size(same)
        return F.when((count >= MIN_EQUAL) & (100 * count >= MIN_SHARE_PCT * (last - first + 1)), count)

    scored = full.select("uid", "doc_id", "item", "item_id", F.array_max(F.transform("spots", equal_around)).alias("n_equal"))
    found = scored.where("n_equal is not null").groupBy("uid", "doc_id", "item_id").agg(F.max("n_equal").cast("long").alias("n_equal"))
    found = cut_lineage(found, "found")
    release(items, seeds, hits, held)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage."""
    rows = numbered_rows(docs)
    found = _contaminated(rows, benchmark, doc_id, text, item_id, item_text)
    return rows.join(small(found.select("uid").distinct()), "uid", "left_anti").select("row.*")
