"""Finding the same person twice: exact groups, fuzzy groups, name matching.

Exact copies are collapsed before anything else, so a value that holds a
third of all rows is one candidate. Fuzzy candidates come from equality joins
on the rarest grams of each text, so many that no pair over the threshold can be
missed (``similar``).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import best_of_blocks, lowest_sequence_ratio, token_set_ratio
from ..functions.text import normalize_text
from ..session import cut_lineage, release
from .clean import quoted, require_columns
from .latest import dedupe_keep, join_group_rows, latest_per_key
from .similar import ordered_grams, prefix, similar_lengths, similar_places
from .skew import grid_join

MODES = ("uniques", "duplicates", "all")
GROUP_ID, GROUP_SIZE = "duplicate_group_id", "duplicate_group_size"


def _check(df: DataFrame, cols: Sequence[str], mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    if not cols:
        raise ValueError("no columns given")
    require_columns(df, cols)


def _pick(df: DataFrame, mode: str) -> DataFrame:
    if mode == "uniques":
        return df.where(F.col(GROUP_ID) == 0)
    return df.where(F.col(GROUP_ID) > 0) if mode == "duplicates" else df


def compare_text(col: str) -> Column:
    """Normalised text; a missing value is the text ``nan`` and equals another."""
    return F.coalesce(normalize_text(quoted(col).cast("string")), F.lit("nan"))


def _digest(text: Column) -> Column:
    """SHA-256, marked as never null: joins on it then add no null test, which
    would work out the text a second time."""
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def number_densely(keys: DataFrame, key: str, out: str, start: int = 1) -> DataFrame:
    """Consecutive numbers for distinct hexadecimal digests, in digest order.

    Digests spread evenly over 4096 prefixes, so ranking runs per prefix; only
    the 4096 prefix counts meet in one task.
    """
    bucketed = keys.withColumn("_b", F.substring(key, 1, 3))
    counts = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    return (
        bucketed.join(offsets, "_b")
        .withColumn(out, (F.col("_before") + place + (start - 1)).cast("long"))
        .drop("_b", "_before")
    )


def row_digest(cols: Sequence[str]) -> Column:
    """One digest of several normalised columns.

    Each column is digested by itself first, so no text in one column can pass
    for the border between two.
    """
    each = [_digest(compare_text(c)) for c in cols]
    return each[0] if len(each) == 1 else _digest(F.concat(*each))


def exact_duplicate_labels(df: DataFrame, cols: Sequence[str], row_id: str) -> DataFrame:
    """(row_id, group number, group size) of every row; 0 and 1 for a single one.

    Texts are read and normalised once: the narrow rows of id and digest are
    written, and grouped from there. Groups are numbered in the order of their
    digests, which has nothing to do with the order of the keys.
    """
    _check(df, cols, "all")
    keyed = cut_lineage(df.select(quoted(row_id).alias(row_id), row_digest(cols).alias("_k")), "digests")
    return _numbered(keyed)


def _numbered(keyed: DataFrame) -> DataFrame:
    repeated = keyed.groupBy("_k").agg(F.count(F.lit(1)).alias(GROUP_SIZE)).where(F.col(GROUP_SIZE) >= 2)
    numbered = number_densely(repeated, "_k", GROUP_ID).withColumn("_size", F.col(GROUP_SIZE))
    out = join_group_rows(keyed, numbered, "_k", "_size").drop("_k")
    return out.withColumns({GROUP_ID: F.coalesce(GROUP_ID, F.lit(0)), GROUP_SIZE: F.coalesce(GROUP_SIZE, F.lit(1))})


def exact_duplicate_groups(df: DataFrame, cols: Sequence[str], mode: str = "duplicates") -> DataFrame:
    """Group rows whose normalised columns are equal.

    Adds a group number (0 for a single row, else in the order of the digests)
    and the group size. Rows are grouped on a SHA-256 digest, so whole texts
    are compared without being shuffled for it. Where rows have an id,
    ``exact_duplicate_labels`` is cheaper: it reads the texts once.
    """
    _check(df, cols, mode)
    return _pick(_numbered(df.withColumn("_k", row_digest(cols))), mode)


def keep_most_null(groups: DataFrame, row_id: str, mode: str = "duplicates", case_id: str | None = None) -> DataFrame:
    """Of each duplicate group keep the record with the most missing values.

    A tie goes to the smaller row id. The kept records count as unique
    afterwards; with ``case_id`` one row per case is kept at the end.
    """
    data = [c for c in groups.columns if c not in (GROUP_ID, GROUP_SIZE)]
    nulls = sum((quoted(c).isNull().cast("int") for c in data), F.lit(0))
    marked = groups.withColumn("_nulls", nulls)
    singles = marked.where(F.col(GROUP_ID) == 0)
    kept = latest_per_key(marked.where(F.col(GROUP_ID) > 0), GROUP_ID, [F.col("_nulls").desc(), quoted(row_id)])
    parts = {"uniques": singles, "duplicates": kept}
    out = parts.get(mode) if mode != "all" else singles.unionByName(kept)
    if out is None:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    out = out.drop("_nulls").withColumns({GROUP_ID: F.lit(0).cast("long"), GROUP_SIZE: F.lit(1).cast("long")})
    return dedupe_keep(out, case_id, [row_id]) if case_id else out


def remove_known_duplicates(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Drop curated ids; a row without an id stays."""
    return df.join(known.select(key).where(quoted(key).isNotNull()), key, "left_anti")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node.

    Alternating large-star and small-star rounds, each grouped by node
    (combined before the shuffle) and written to the shared folder. They end
    when the links are stars: one link per node, none from a root.
    """
    links = cut_lineage(edges.where("a <> b").selectExpr("greatest(a, b) u", "least(a, b) v").distinct(), "links")
    while True:
        both = links.unionByName(links.selectExpr("v u", "u v"))
        lows = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large, "links")
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = cut_lineage(moved.unionByName(lows.selectExpr("u", "m v")).distinct(), "links")
        release(links, large)
        links = small
        several = links.groupBy("u").count().where("count > 1").select("u")
        inner = links.select("u").join(links.select(F.col("v").alias("u")), "u", "left_semi")
        if several.unionByName(inner).isEmpty():
            roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.selectExpr("root node", "root").distinct())


def _score_pairs(pairs: DataFrame, values: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose lowest column similarity reaches the threshold.

    The earlier row is the first text; when copies of the two values lie in
    both orders, both directions count. Pairs further apart than the threshold
    allows are dropped by length and edit distance before any is scored.
    """
    left = values.select(F.col("vid").alias("a"), F.col("texts").alias("ta"), F.col("last_id").alias("la"))
    right = values.select(F.col("vid").alias("b"), F.col("texts").alias("tb"), F.col("last_id").alias("lb"))
    t = threshold / 100.0
    full = pairs.join(left, "a").join(right, "b")

    def near(x: Column, y: Column) -> Column:
        size = F.length(x) + F.length(y)
        return similar_lengths(F.length(x), F.length(y), t) & (F.levenshtein(x, y) <= (1 - t) * size + 1e-9)

    fits = F.forall(F.zip_with("ta", "tb", near), lambda ok: ok)
    oriented = full.where(fits).select(
        "a",
        "b",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("a") < F.col("lb"), F.struct(F.col("ta").alias("x"), F.col("tb").alias("y"))),
                    F.when(F.col("b") < F.col("la"), F.struct(F.col("tb").alias("x"), F.col("ta").alias("y"))),
                )
            )
        ).alias("p"),
    )
    score = lowest_sequence_ratio(F.col("p.x"), F.col("p.y"))
    return oriented.select("a", "b", score.alias("score")).where(F.col("score") >= threshold).select("a", "b").distinct()


def telling_text(texts: Column, block: int, count: int) -> tuple[Column, Column]:
    """(number, text) of the first column that is not empty, ``block`` before the others.

    Only an empty text is similar to an empty one, so similar values have the same number.
    """
    order = [block, *[i for i in range(count) if i != block]]
    number = F.coalesce(*[F.when(F.get(texts, F.lit(i)) != "", F.lit(i)) for i in order])
    return number, F.get(texts, number)


def fuzzy_keys(values: DataFrame, threshold: float, block: int, count: int) -> DataFrame:
    """(vid, len, key, p): the keys under which the values of ``texts`` meet, at most one for each character."""
    number, text = telling_text(F.col("texts"), block, count)
    filled = values.select(F.col("vid").alias("id"), number.alias("group"), text.alias("text")).where("text is not null")
    found = prefix(ordered_grams(filled, filled, []), threshold / 100.0)
    return cut_lineage(found.select(F.col("id").alias("vid"), "len", F.explode("keys").alias("k")).select("vid", "len", "k.*"), "keys")


def fuzzy_duplicate_groups(
    df: DataFrame,
    cols: Sequence[str],
    row_id: str,
    threshold: float = 90,
    block_on: str | None = None,
    mode: str = "duplicates",
) -> DataFrame:
    """Group rows linked by pairs whose every column has a ratio of at least
    ``threshold``; groups are the connected components of those pairs.

    Nothing is missed and no group is cut. Meant for names and other short
    fields. ``block_on`` is the column that makes candidates, best the most
    telling one; where it is empty the next one does.

    1. Equal values are collapsed.
    2. Candidates share one of their rarest grams. Within a key every value is
       first scored only against two leaders, a linear number of pairs.
    3. Pairs that are already in one component need no score. Where a key still
       holds several components, its values meet ``LEADERS`` more, again a
       linear number, so most of what can be linked is.
    4. Of the rest, a key pairs the values outside its largest component with
       the others, if length and place of the gram allow the similarity, so a
       key that most values share is not squared.
    """
    _check(df, cols, mode)
    t = threshold / 100.0
    texts = F.array(*[compare_text(c) for c in cols])
    rows = df.withColumn("_texts", texts)
    values = cut_lineage(
        rows.groupBy("_texts")
        .agg(F.min(quoted(row_id)).alias("vid"), F.max(quoted(row_id)).alias("last_id"), F.count(F.lit(1)).alias("n"))
        .withColumnRenamed("_texts", "texts"),
        "values",
    )
    keys = fuzzy_keys(values, threshold, list(cols).index(block_on or cols[0]), len(cols))

    heads = keys.groupBy("key").agg(F.min("vid").alias("lo"), F.max("vid").alias("hi"), F.count(F.lit(1)).alias("held")).where("lo < hi")
    led = join_group_rows(keys.select("key", "vid"), heads, "key", "held").select("vid", F.explode(F.array("lo", "hi")).alias("y")).where("vid <> y")
    pairs = led.selectExpr("least(vid, y) a", "greatest(vid, y) b").distinct()
    edges = cut_lineage(_score_pairs(pairs, values, threshold), "edges")
    roots = cut_lineage(connected_components(edges).withColumnRenamed("node", "vid"), "roots")

    for unlinked in (_unlinked_leaders, _unlinked_pairs):
        more = cut_lineage(_score_pairs(unlinked(keys, roots, t), values, threshold), "edges")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            roots = cut_lineage(connected_components(edges).withColumnRenamed("node", "vid"), "roots")

    grouped = values.join(roots, "vid", "left").withColumn("root", F.coalesce("root", "vid"))
    sizes = grouped.groupBy("root").agg(F.sum("n").alias(GROUP_SIZE)).where(F.col(GROUP_SIZE) >= 2)
    numbered = number_densely(sizes.withColumn("_h", _digest(F.col("root").cast("string"))), "_h", GROUP_ID)
    by_value = grouped.select(F.col("texts").alias("_texts"), "root", "n").join(numbered.drop("_h"), "root", "left").drop("root")
    out = join_group_rows(rows, by_value, "_texts", "n").drop("_texts")
    return _pick(
        out.withColumns({GROUP_ID: F.coalesce(GROUP_ID, F.lit(0)), GROUP_SIZE: F.coalesce(GROUP_SIZE, F.lit(1))}),
        mode,
    )


#: Values of a key, chosen by their hash, that its others meet before any pairs by the square are made.
LEADERS = 8


def _labelled(keys: DataFrame, roots: DataFrame) -> DataFrame:
    return cut_lineage(keys.join(roots, "vid", "left").select("key", "vid", "len", "p", F.coalesce("root", "vid").alias("label")), "members")


def _unlinked_leaders(keys: DataFrame, roots: DataFrame, t: float) -> DataFrame:
    """(a, b) of a value and a leader of one of its keys in another component, if length and place allow the similarity."""
    members = _labelled(keys, roots)
    row = F.struct(*[F.col(c).alias(f"{c}_y") for c in ("vid", "len", "p", "label")])
    chosen = [F.min_by(row, F.struct(F.xxhash64("vid", F.lit(i)), "vid", "p")) for i in range(LEADERS)]
    mixed = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.array(*chosen).alias("leaders"), F.count(F.lit(1)).alias("held")).where("low < high")
    led = join_group_rows(members, mixed.select("key", "leaders", "held"), "key", "held").where("leaders is not null")
    met = led.select("vid", "len", "p", "label", F.explode(F.array_distinct("leaders")).alias("y")).select("vid", "len", "p", "label", "y.*").where("label <> label_y")
    fits = similar_lengths(F.col("len"), F.col("len_y"), t) & similar_places(F.col("len"), F.col("len_y"), F.col("p"), F.col("p_y"), t)
    return met.where(fits).selectExpr("least(vid, vid_y) a", "greatest(vid, vid_y) b").distinct()


def _unlinked_pairs(keys: DataFrame, roots: DataFrame, t: float) -> DataFrame:
    """(a, b) of values with a common key and no common component whose lengths and places allow the similarity."""
    members = _labelled(keys, roots)
    sizes = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    major = sizes.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.count(F.lit(1)).alias("labels"), F.sum("n").alias("held"))
    placed = join_group_rows(members, major.where("labels > 1").drop("labels"), "key", "held").where("major is not null")
    placed = cut_lineage(placed.withColumn("main", F.col("label") == F.col("major")).drop("major"), "members")
    left = placed.where("not main").select("key", *[F.col(c).alias(f"{c}_x") for c in ("vid", "len", "p", "label")])
    right = placed.select("key", "main", *[F.col(c).alias(f"{c}_y") for c in ("vid", "len", "p", "label")])
    fits = similar_lengths(F.col("len_x"), F.col("len_y"), t) & similar_places(F.col("len_x"), F.col("len_y"), F.col("p_x"), F.col("p_y"), t)
    met = grid_join(left, right, "key").where("label_x <> label_y and (main or vid_x < vid_y)").where(fits)
    return met.selectExpr("least(vid_x, vid_y) a", "greatest(vid_x, vid_y) b").distinct()


#: Similarities down to which the best match of a name is searched, one after the other, in per cent.
ROUNDS = (70, 55, 40, 25, 10, 1)


def best_name_match(
    reference: DataFrame,
    target: DataFrame,
    name: str = "name",
    threshold: float = 85,
    direction: str = "reference",
) -> DataFrame:
    """Add the best matching name of the other table, the best score, and yes/no.

    Names are compared as token sets without case, accents or extra blanks.
    Every name has the score of its best match, cut to a whole number; the match
    itself is named from the threshold up. A name without letters scores 0, as
    do all names if the other table has none. Equal token sets score 100 and
    need no search; among equal scores the same token set wins, then the
    smaller name.

    Of up to ``ALL_TARGETS`` different names of the other table all are compared.
    Of more the search goes down in rounds: candidates are complete down to the
    round's bound, names whose best score reaches it are done, and only the
    others go on, with the best score they have as a bound of their own.
    """
    if direction not in ("reference", "target"):
        raise ValueError("direction is 'reference' or 'target'")
    require_columns(reference, [name])
    require_columns(target, [name])
    source, other = (reference, target) if direction == "reference" else (target, reference)

    def names(df: DataFrame) -> DataFrame:
        norm = normalize_text(quoted(name), ascii_only=False)
        tokens = F.array_sort(F.array_distinct(F.filter(F.split(norm, " "), lambda x: x != "")))
        return df.withColumn("_set", F.array_join(tokens, " "))

    left_rows = names(source)
    left = left_rows.select(F.col("_set").alias("s")).where("s <> ''").distinct()
    right = cut_lineage(names(other).where("_set <> ''").groupBy(F.col("_set").alias("o")).agg(F.min(quoted(name)).alias("best_match")), "targets")

    same = left.join(right, F.col("s") == F.col("o")).select("s", F.lit(100.0).alias("score"), "best_match")
    todo = left.join(right.select(F.col("o").alias("s")), "s", "left_anti").select(F.col("s").alias("id"))
    scores = [same]
    if right.count() <= ALL_TARGETS:
        scores.append(_best_of_all(todo, right, threshold))
    else:
        scores += _best_in_rounds(todo, right, threshold)
    found = functools.reduce(DataFrame.unionByName, scores).withColumnRenamed("s", "_set")
    out = left_rows.join(found, "_set", "left").drop("_set")
    return out.withColumn("score", F.floor(F.coalesce("score", F.lit(0.0))).cast("int")).withColumn(
        "correspondance", F.when(F.col("best_match").isNotNull(), "yes").otherwise("no")
    )


#: Up to so many token sets every name is compared with all: that is linear in the names, and cheaper than candidates.
ALL_TARGETS = 10_000
#: Names and targets that are compared in one table.
NAME_BLOCK, TARGET_BLOCK = 256, 512


def _best_of_all(todo: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(s, score, best_match) of the names, each compared with every target, block by block."""

    def blocks(df: DataFrame, key: str, size: int, row: Column) -> tuple[DataFrame, int]:
        count = max(1, -(-df.count() // size))
        number = F.pmod(F.xxhash64(key), F.lit(count))
        return df.select(number.alias("block"), row.alias("row")).groupBy("block").agg(F.sort_array(F.collect_list("row")).alias("rows")), count

    todo = cut_lineage(todo, "names")
    names, count = blocks(todo, "id", NAME_BLOCK, F.col("id"))
    others, _ = blocks(right, "o", TARGET_BLOCK, F.struct("best_match", "o"))
    dealt = names.select(F.col("rows").alias("names")).repartition(min(count, 1000))
    met = dealt.crossJoin(cut_lineage(others.select(F.col("rows").alias("others")), "targets"))
    each = met.select(F.explode(best_of_blocks("names", "others")).alias("x")).select("x.*")
    best = each.groupBy("s").agg(F.min(F.struct((-F.col("score")).alias("m"), F.col("best_match").alias("b"))).alias("w"))
    score = -F.col("w.m")
    return cut_lineage(best.select("s", score.alias("score"), F.when(score >= threshold, F.col("w.b")).alias("best_match")), "scored")


def _best_in_rounds(todo: DataFrame, right: DataFrame, threshold: float) -> list[DataFrame]:
    """The same in parts, found among candidates: names that reach a round's bound are done."""
    targets = right.select(F.col("o").alias("id"))
    index = _name_grams(targets, targets)
    still = _name_grams(todo, targets).withColumn("best", F.lit(0.0))
    scores = []
    for bound in [threshold, *[r for r in ROUNDS if r < threshold]]:
        scored = cut_lineage(_scored_candidates(still, index, bound), "scored")
        best = scored.groupBy("s").agg(F.max("score").alias("score"))
        if bound == threshold:
            named = scored.where(F.col("score") >= threshold).join(right, "o")
            matches = named.groupBy("s").agg(F.min(F.struct((-F.col("score")).alias("m"), F.col("best_match").alias("b"))).alias("w"))
            best = best.join(matches.select("s", F.col("w.b").alias("best_match")), "s", "left")
        else:
            best = best.withColumn("best_match", F.lit(None).cast("string"))
        now = still.join(best.withColumnRenamed("s", "id"), "id", "left")
        now = cut_lineage(now.withColumn("best", F.greatest("best", F.coalesce("score", F.lit(0.0)))).drop("score"), "names")
        release(scored)
        ends = F.col("best") >= bound
        scores.append(now.where(ends).select(F.col("id").alias("s"), F.col("best").alias("score"), "best_match"))
        still = now.where(~ends).drop("best_match")
        if still.isEmpty():
            break
    return scores


def _name_grams(names: DataFrame, targets: DataFrame) -> DataFrame:
    """(id, len, grams, tokens) of names, grams and tokens ordered by how rare they are among the targets."""
    as_text = lambda df: df.select("id", F.lit(0).alias("group"), F.col("id").alias("text"))
    each = lambda df: df.select("id", F.explode(F.split("id", " ")).alias("w"))
    held = each(targets).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counted = join_group_rows(each(names), held.withColumn("held", F.col("n")), "w", "held")
    tokens = counted.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "w"))).alias("tokens"))
    grams = ordered_grams(as_text(names), as_text(targets), [], spaces=False)
    return cut_lineage(grams.join(tokens, "id"), "names")


def _token_keys(t: float | Column) -> tuple[Column, Column]:
    """(all, first) token keys of a name: with any that may be similar it shares a token.

    If shared tokens make up as much of a side as the similarity asks for, the
    rarest of them is among that side's first ones: those before the rest is
    too short to make it up.
    """
    word = lambda x: F.concat(F.lit("w\x1f"), x["w"])
    rest = lambda i: F.aggregate(F.slice("tokens", i + 1, F.size("tokens")), F.lit(-1), lambda size, x: size + F.length(x["w"]) + 1)
    first = F.filter("tokens", lambda x, i: rest(i) >= t / (2 - t) * F.col("len") - 1e-9)
    return F.transform("tokens", word), F.transform(first, word)


def _scored_candidates(names: DataFrame, index: DataFrame, bound: float) -> DataFrame:
    """(s, o, score) of all pairs that reach ``bound`` and the name's best score so far, and of some others."""
    t = bound / 100.0
    own = F.greatest(F.col("best"), F.lit(float(bound))) / 100.0

    def sides(df: DataFrame, name: str, mine: Column | None = None) -> list[DataFrame]:
        every, first = _token_keys(F.lit(t) if mine is None else mine)
        keyed = prefix(df, t, mine).select(F.col("id").alias(name), *([own.alias("own")] if mine is not None else []), every.alias("every"), first.alias("first"), F.transform("keys", lambda k: k["key"]).alias("grams"))
        keep = [c for c in keyed.columns if c not in ("every", "first", "grams")]
        return [keyed.select(*keep, F.explode(F.array_distinct(F.concat(*cols))).alias("key")) for cols in (("first", "grams"), ("every",), ("first",), ("every", "grams"))]

    (firsts, every, _, _), (_, _, other_first, others) = sides(names, "s", own), sides(index, "o")
    pairs = grid_join(firsts, others, "key").select("s", "o", "own").unionByName(grid_join(every, other_first, "key").select("s", "o", "own")).distinct()
    gap = F.levenshtein("s", "o") / (F.length("s") + F.length("o"))
    told = cut_lineage(pairs.select("s", "o", _reachable(F.col("s"), F.col("o"), F.col("own")).alias("near"), gap.alias("gap")), "pairs")
    closest = told.groupBy("s").agg(F.min_by("o", F.struct("gap", "o")).alias("o"))
    chosen = told.where("near").select("s", "o").unionByName(closest).distinct()
    return chosen.withColumn("score", token_set_ratio("s", "o"))


def _reachable(s: Column, o: Column, t: Column) -> Column:
    """Can the token-set score of two sorted token texts reach the threshold?

    All tokens of one side are shared, the shared ones make up nearly all of a
    side, or the two texts with the shared tokens in front are few edits apart.
    The edit distance counts a replacement once, so it is never above the number
    of inserted and deleted characters that the score allows.
    """
    a, b = F.split(s, " "), F.split(o, " ")
    shared = F.array_intersect(a, b)
    n = F.length(F.array_join(shared, " "))
    la, lb = F.length(s), F.length(o)
    subset = (n > 0) & ((n == la) | (n == lb))
    near_core = (n > 0) & (2 * n >= t * (n + F.least(la, lb)) - 1e-9)
    text_a = F.array_join(F.concat(shared, F.array_except(a, b)), " ")
    text_b = F.array_join(F.concat(shared, F.array_except(b, a)), " ")
    near = F.levenshtein(text_a, text_b) <= (1 - t) * (la + lb) + 1e-9
    return subset | near_core | (similar_lengths(la, lb, t) & near)
