"""Record linkage against brute force on small invented names."""

import hashlib
import random
import re
import unicodedata
from difflib import SequenceMatcher

import pytest

from fieldcohort.functions.similarity import common_lengths, common_table, matched_lengths, sequence_ratio, token_set_ratio
from fieldcohort.operators import linkage, similar, skew

FIRST = ["Marie", "Jean", "Josué", "Mariette", "Anne", "Rose-Marie", "Jeanne", "Wilner", "marie", "Jn"]
LAST = ["Pierre", "Pierre-Louis", "Joseph", "Josèphe", "Toussaint", "Charles", "Charle", "Paul", "Pol"]


def people(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        first, last = rng.choice(FIRST), rng.choice(LAST)
        if rng.random() < 0.3:
            k = rng.randrange(len(first))
            first = first[:k] + rng.choice("aeiou") + first[k + rng.randrange(2):]
        if rng.random() < 0.1:
            last = None
        rows.append((i, first, last, rng.choice(["2020-01-31", "2020-02-29", "2021-01-31"])))
    return rows


def compared(text):
    """The form in which names are compared; a missing one counts as the word nan."""
    if text is None:
        return "nan"
    letters = (c for c in unicodedata.normalize("NFKD", re.sub(r"\s+", " ", text.strip().lower())) if ord(c) < 128)
    return "".join(letters)


def brute_groups(rows, cols, threshold):
    """Groups found by walking the graph of all pairs that score high enough."""
    names = {r[0]: [compared(r[c]) for c in cols] for r in rows}
    near = {i: [j for j in names if j != i and all(100 * SequenceMatcher(None, *(x[::-1] if i > j else x)).ratio() >= threshold for x in zip(names[i], names[j]))] for i in names}
    left, groups = set(names), set()
    while left:
        front = [left.pop()]
        group = set(front)
        while front:
            fresh = [j for j in near[front.pop()] if j not in group]
            group.update(fresh)
            front += fresh
        left -= group
        if len(group) > 1:
            groups.add(frozenset(group))
    return groups


def spark_groups(out):
    groups = {}
    for r in out.collect():
        groups.setdefault(r[linkage.GROUP_ID], set()).add(r["id"])
        assert r[linkage.GROUP_SIZE] >= 2
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("threshold", [60, 85, 100])
def test_fuzzy_groups_equal_brute_force(spark, threshold):
    rows = people(150, threshold)
    df = spark.createDataFrame(rows, "id long, first string, last string, dob string")
    out = linkage.fuzzy_duplicate_groups(df, ["first", "last"], "id", threshold)
    assert spark_groups(out) == brute_groups(rows, [1, 2], threshold)


def test_fuzzy_groups_on_templated_names(spark):
    rows = [(i, f"Site#{i:06d}") for i in range(120)] + [(200 + i, f"{i} Rue {chr(65 + i)}xy") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, name string")
    out = linkage.fuzzy_duplicate_groups(df, ["name"], "id", 90)
    assert spark_groups(out) == brute_groups(rows, [1], 90)


def test_exact_groups_match_missing_values_and_modes(spark):
    rows = [(1, "Élise ", None), (2, "elise", None), (3, "elise", "x"), (4, " ELISE", "X"), (5, "nan", "q"), (6, None, "q"), (7, "z", "z")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    both = linkage.exact_duplicate_groups(df, ["a", "b"], "all")
    assert spark_groups(both.where("duplicate_group_id > 0")) == {frozenset({1, 2}), frozenset({3, 4}), frozenset({5, 6})}
    assert [r.id for r in linkage.exact_duplicate_groups(df, ["a", "b"], "uniques").collect()] == [7]
    ids = sorted({r.duplicate_group_id for r in both.collect()})
    assert ids == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="missing columns: ghost"):
        linkage.exact_duplicate_groups(df, ["ghost"])


def test_keep_most_null_is_idempotent(spark):
    rows = [(1, "a", None), (2, "a", "x"), (3, "a", None), (4, "b", "y")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    groups = linkage.exact_duplicate_groups(df, ["a"], "all")
    once = linkage.keep_most_null(groups, "id", "all")
    assert sorted(r.id for r in once.collect()) == [1, 4]
    again = linkage.exact_duplicate_groups(once.select("id", "a", "b"), ["a"], "all")
    assert sorted(r.id for r in linkage.keep_most_null(again, "id", "all").collect()) == [1, 4]
    assert [r.id for r in linkage.keep_most_null(groups, "id", "duplicates").collect()] == [1]
    assert [r.id for r in linkage.keep_most_null(groups, "id", "uniques").collect()] == [4]


def test_no_text_passes_for_a_column_border(spark):
    rows = [(1, "a\x1fb", "c"), (2, "a", "b\x1fc"), (3, "ab", "c"), (4, "A ", "B\x1fc")]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    sizes = {r.id: r[linkage.GROUP_SIZE] for r in linkage.exact_duplicate_groups(df, ["x", "y"], "all").collect()}
    assert sizes == {1: 1, 2: 2, 3: 1, 4: 2}
    labels = {r.id: r[linkage.GROUP_SIZE] for r in linkage.exact_duplicate_labels(df, ["x", "y"], "id").collect()}
    assert labels == sizes


def slow_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def indel_score(a, b):
    return 200.0 * slow_lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_score(a, b):
    """The best of the three comparisons of shared and left-over tokens, by the plain rule."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both, only_a, only_b = sorted(left & right), sorted(left - right), sorted(right - left)
    if both and (not only_a or not only_b):
        return 100.0
    core, text_a, text_b = " ".join(both), " ".join(both + only_a), " ".join(both + only_b)
    return max(indel_score(text_a, text_b), *([indel_score(core, text_a), indel_score(core, text_b)] if both else [0.0]))


def some_pairs(count, seed):
    rng = random.Random(seed)
    word = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    pairs = [tuple(word(rng.randrange(25), rng.choice(["ab", "abcd", "abcdefghij ", "é🙂xy "])) for _ in "xy") for _ in range(count)]
    long = "aaaaabbbcde fghijklmnopqrstuvwxyz"
    pairs += [(word(rng.randrange(300), long), word(rng.randrange(190, 420), long)) for _ in range(20)]
    return pairs + [("a" * 80, "a" * 240), ("ab" * 150, "ab" * 150), ("", ""), ("", "a"), ("x" * 30, "y" * 30)]


def test_common_lengths_equal_dynamic_programming():
    pairs = some_pairs(600, 7)
    assert list(common_lengths(*zip(*pairs))) == [slow_lcs(a, b) for a, b in pairs]
    assert list(common_lengths([], [])) == []


def test_matched_lengths_equal_the_block_by_block_search():
    pairs = some_pairs(3000, 8)
    want = [sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks()) for a, b in pairs]
    assert list(matched_lengths(*zip(*pairs))) == want


def test_ratios_equal_plain_rules_and_keep_nulls(spark):
    pairs = some_pairs(200, 9) + [("marie joseph", "joseph  marie"), ("marie", "marie joseph"), ("", "marie"), ("a b c", "a b d"), (None, "a"), ("a", None), (None, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id long, a string, b string")
    for r in df.select("a", "b", sequence_ratio("a", "b").alias("seq"), token_set_ratio("a", "b").alias("tok")).collect():
        if r.a is None or r.b is None:
            assert r.seq is None and r.tok is None
        else:
            assert r.seq == pytest.approx(100 * SequenceMatcher(None, r.a, r.b).ratio(), abs=1e-9)
            assert r.tok == pytest.approx(token_set_score(r.a, r.b), abs=1e-9)


@pytest.mark.parametrize("threshold", [70, 85, 95])
def test_best_match_equals_brute_force(spark, threshold):
    left = [(r[0], f"{r[1]} {r[2] or ''}") for r in people(60, 1)] + [(900, None), (901, "  ")]
    right = [(r[0], f"{r[2] or 'Ti'}  {r[1].upper()}") for r in people(60, 2)]
    cols = "id long, name string"
    out = linkage.best_name_match(spark.createDataFrame(left, cols), spark.createDataFrame(right, cols), threshold=threshold)
    bare = {n: re.sub(r"[\u0300-\u036f]", "", unicodedata.normalize("NFKD", re.sub(r"\s+", " ", (n or "").lower()).strip())) for _, n in [*left, *right]}
    got = {r.id: (r.best_match, r.score, r.correspondance) for r in out.collect()}
    assert len(got) == len(left)
    for key, name in left:
        best = max((token_set_score(bare[name], bare[o]) for _, o in right), default=0)
        match, score, flag = got[key]
        if bare[name] and best >= threshold:
            assert (score, flag) == (int(best), "yes")
            assert token_set_score(bare[name], bare[match]) == pytest.approx(best)
        else:
            assert (match, score, flag) == (None, int(best) if bare[name] else 0, "no")


def test_frequent_candidate_keys_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(skew, "PART_ROWS", 3)
    rows = people(80, 5)
    df = spark.createDataFrame(rows, "id long, first string, last string, dob string")
    assert spark_groups(linkage.fuzzy_duplicate_groups(df, ["first", "last"], "id", 85)) == brute_groups(rows, [1, 2], 85)

    left = spark.createDataFrame([(i,) for i in range(200)], "x int").selectExpr("x", "x % 3 key")
    right = spark.createDataFrame([(i,) for i in range(50)], "y int").selectExpr("y", "if(y < 20, 0, y) key")
    got = skew.grid_join(left, right, "key").select("key", "x", "y").collect()
    want = left.join(right, "key").select("key", "x", "y").collect()
    assert sorted(got) == sorted(want) and len(got) == 67 * 20


def test_keys_are_linear_in_the_length_and_rare_ones(spark):
    rng = random.Random(3)
    rows = [(i, ["pierre " + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))]) for i, n in enumerate([5, 10, 20, 40] * 50)]
    keys = linkage.fuzzy_keys(spark.createDataFrame(rows, "vid long, texts array<string>"), 90, 0, 1)
    held = {}
    for r in keys.collect():
        held.setdefault(r.vid, set()).add(r.key)
    for vid, (text,) in rows:
        assert 1 <= len(held[vid]) <= 0.7 * len(text)
        assert not any(k.endswith("\x1fpie") or k.endswith("\x1frre") for k in held[vid])


def test_a_token_in_every_name_makes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(similar, "CROWD", 4)
    rng = random.Random(4)
    names = ["pierre " + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(4000)]
    values = spark.createDataFrame([(i, [s]) for i, s in enumerate(names)], "vid long, texts array<string>")
    keys = linkage.fuzzy_keys(values, 90, 0, 1)
    held = keys.groupBy("key").agg({"vid": "count"}).toDF("key", "n").collect()
    single = [r.n for r in held if r.key.count("\x1f") == 2]
    assert max(single) <= 4 and max(r.n for r in held) < 40 and sum(r.n for r in held) < 4000 * 60
    met = linkage._unlinked_pairs(keys, spark.createDataFrame([], "vid long, root long"), 0.9).count()
    print("pairs of 4000 names:", met)
    assert met < 4000 * 6


@pytest.mark.parametrize(("threshold", "crowd"), [(70, 64), (88, 2)])
def test_fuzzy_groups_find_every_pair_of_random_edits(spark, monkeypatch, threshold, crowd):
    monkeypatch.setattr(similar, "CROWD", crowd)
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abcdefghij ") for _ in range(rng.randrange(1, 30))) for _ in range(30)]
    rows = []
    for i in range(240):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(text) + 1)
            text[k : k + rng.randrange(2)] = rng.choice(["", "x", "ab"])
        rows.append((i, "".join(text) if rng.random() < 0.95 else "", rng.choice(["same", "sane"])))
    df = spark.createDataFrame(rows, "id long, a string, b string")
    out = linkage.fuzzy_duplicate_groups(df, ["a", "b"], "id", threshold)
    assert spark_groups(out) == brute_groups(rows, [1, 2], threshold)


@pytest.mark.parametrize("crowd", [64, 2])
def test_every_name_has_the_best_score_whatever_it_is(spark, monkeypatch, crowd):
    monkeypatch.setattr(similar, "CROWD", crowd)
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9)))
    left = [(i, " ".join(word("abcxyz") for _ in range(rng.randrange(1, 4)))) for i in range(60)] + [(900, "###"), (901, None)]
    right = [(i, " ".join(word("abcdefghijklm") for _ in range(rng.randrange(1, 4)))) for i in range(60)]
    cols = "id long, name string"
    out = linkage.best_name_match(spark.createDataFrame(left, cols), spark.createDataFrame(right, cols), threshold=85)
    got = {r.id: r.score for r in out.collect()}
    assert got == {i: int(max((token_set_score(n or "", o) for _, o in right), default=0) + 1e-9) for i, n in left}
    none = linkage.best_name_match(spark.createDataFrame(left, cols), spark.createDataFrame([], cols))
    assert {(r.best_match, r.score, r.correspondance) for r in none.collect()} == {(None, 0, "no")}


@pytest.mark.parametrize("most", [0, 10_000])
def test_names_meet_all_of_few_targets_and_candidates_of_many(spark, monkeypatch, most):
    monkeypatch.setattr(linkage, "ALL_TARGETS", most)
    monkeypatch.setattr(linkage, "NAME_BLOCK", 7)
    monkeypatch.setattr(linkage, "TARGET_BLOCK", 5)
    searched = []
    rounds = linkage._best_in_rounds
    monkeypatch.setattr(linkage, "_best_in_rounds", lambda *a: searched.append(a) or rounds(*a))
    rng = random.Random(12)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    shared = [word("abcde", 4) for _ in range(6)]
    name = lambda letters: " ".join([*rng.sample(shared, rng.randrange(3)), *[word(letters, rng.randrange(1, 8)) for _ in range(rng.randrange(1, 3))]])
    left = [(i, name("abcxyz")) for i in range(40)] + [(100, word("abc", 64)), (101, word("abc", 65)), (102, word("ab", 90) + " " + shared[0]), (103, "\U0001f642 " + shared[1]), (104, None), (105, shared[2])]
    right = [(i, name("abcdefgh")) for i in range(40)] + [(100, word("abc", 70)), (101, shared[2] + " " + shared[3]), (102, left[0][1].upper()), (103, "  "), (104, None)]
    cols = "id long, name string"
    found = linkage.best_name_match(spark.createDataFrame(left, cols), spark.createDataFrame(right, cols), threshold=60).collect()
    assert len(found) == len(left) and bool(searched) == (most == 0)
    texts = {i: n for i, n in right if n and n.strip()}
    for r in found:
        score = {o: token_set_score((r.name or "").lower(), o.lower()) for o in texts.values()}
        best = max(score.values())
        assert r.score == int(best + 1e-9)
        # an equal token set wins, of other equal scores the smaller name
        equal = [o for o in score if set(o.lower().split()) == set((r.name or "").lower().split())]
        assert r.best_match == (None if best < 60 else min(equal or [o for o in score if score[o] > best - 1e-9]))


def test_common_table_equals_dynamic_programming():
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("abc\u00e9\U0001f642") for _ in range(n))
    left, right = [word(n) for n in (0, 1, 5, 30, 63, 64)], [word(n) for n in (0, 1, 7, 40, 120)]
    assert common_table(left, right).tolist() == [[slow_lcs(a, b) for b in right] for a in left]


def test_sites_of_one_place_are_not_paired_by_the_square(spark, monkeypatch):
    pairs = []
    score = linkage._score_pairs
    monkeypatch.setattr(linkage, "_score_pairs", lambda p, v, t: pairs.append(p.count()) or score(p, v, t))
    sites = [(i, f"haiti {hashlib.md5(str(i).encode()).hexdigest()[:4]}") for i in range(3000)]
    found = linkage.fuzzy_duplicate_groups(spark.createDataFrame(sites, "id long, site string"), ["site"], "id", threshold=85, mode="all").collect()
    values = len({s for _, s in sites})
    assert sum(pairs) < 200 * values
    # three of four places in order are similar, and most codes hang together
    assert max(r.duplicate_group_size for r in found) > 2000
