import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldcohort import session
from fieldcohort.llm import candidates, components, line_dedup, lsh_forest, tokens

from .cases import corpus, documents, empty, groups, lower_words, prose, spoiled


def test_word_hashes_follow_the_words():
    texts = ["A b\tc", "", "é\x0bß", "a  b c\n", "b"]
    hashes, first = tokens.word_hashes(pa.array(texts, pa.large_string()))
    seen = {}
    for i, text in enumerate(texts):
        own = hashes[first[i] : first[i + 1]]
        assert len(own) == len(lower_words(text))
        for h, w in zip(own, lower_words(text)):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components_of_chains_stars_and_loose_ends(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(7, 7)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    df = spark.createDataFrame([*links, (None, 3), (5, None)], "a long, b long")
    want = groups(300, [x for x in links])
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {n: want[n] for a, b in links if a != b for n in (a, b)}
    assert components.components(df.limit(0)).count() == 0


def _sets(rows):
    for r in rows:
        w = lower_words(r[1])
        yield {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _brute(rows):
    sets = list(_sets(rows))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return sets, groups(len(rows), links)


@pytest.mark.parametrize("extra", [False, True])
def test_forest_equals_brute_force(spark, extra):
    rows = corpus()
    sets, low = _brute(rows)
    members = {}
    for i, g in enumerate(low):
        members.setdefault(g, []).append(rows[i][0])
    ids = {g: min([x for x in m if x is not None], default=None) for g, m in members.items()}
    found = lsh_forest.cluster(documents(spark, rows, extra)).select("row.doc_id", "row.text", "n_shingles", "component_id", "keep").collect()
    want = sorted(((r[0], r[1], len(s), ids[g]) for r, s, g in zip(rows, sets, low)), key=str)
    assert sorted(((r.doc_id, r.text, r.n_shingles, r.component_id) for r in found), key=str) == want
    assert sum(r.keep for r in found) == len(members)
    assert {r.component_id for r in found if r.keep} == set(ids.values())


def test_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(8)
    base = prose(rng, 120)
    rows = [(i, spoiled(rng, base, 0.012), "en", "s", 1) for i in range(300)] + [(1000 + i, prose(rng, 80), "en", "s", 1) for i in range(50)]
    _, low = _brute(rows)
    found = {r.doc_id: r.component_id for r in lsh_forest.cluster(documents(spark, rows)).select("row.doc_id", "component_id").collect()}
    assert found == {r[0]: rows[g][0] for r, g in zip(rows, low)}


def test_forest_keeps_columns_and_bears_no_rows(spark):
    assert lsh_forest.near_dedup(documents(spark)).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert lsh_forest.near_dedup(empty(spark)).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 2**63, 900).astype(np.uint64)
    one, two = both[:800], both[100:]
    share = (lsh_forest.minimums(tokens.mix(one)) == lsh_forest.minimums(tokens.mix(two))).mean()
    assert abs(share - 700 / 900) < 0.15


def test_crowded_regions_are_divided(spark, monkeypatch):
    monkeypatch.setattr(candidates, "CROWD", 4)
    rows = spark.range(40).select(F.lit(1).cast("long").alias("region"), F.array((F.col("id") % 8), (F.col("id") % 16), F.col("id")).alias("ord"), F.col("id").alias("node"), F.lit(1).alias("n"), F.lit(True).alias("first"))
    parts = candidates.crowded_regions(rows).groupBy("part").count().collect()
    assert len(parts) > 4 and sum(r["count"] for r in parts) == 40


def _line_groups(rows):
    norm = lambda line: line.strip(" \t\r").lower()
    lines = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(norm(line)) >= 8:
                lines.setdefault(norm(line), len(lines))
    sets = [{n[i : i + 8] for i in range(len(n) - 7)} for n in lines]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return norm, lines, groups(len(sets), links)


@pytest.mark.parametrize("extra", [False, True])
def test_lines_equal_brute_force(spark, extra):
    rows = [r for r in corpus() if r[0] != 7 or r[4] == 1] + [(400, "tiny\ntiny\nlonger line here\nLonger line here \n\nlonger line hers", "en", "s", 1)]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    norm, lines, low = _line_groups(rows)
    seen, want = set(), {}
    for i in order:
        kept = []
        for line in (rows[i][1] or "").split("\n"):
            group = low[lines[norm(line)]] if len(norm(line)) >= 8 else None
            if group is None or group not in seen:
                kept.append(line)
                seen.add(group)
        want[rows[i][0], rows[i][1]] = None if rows[i][1] is None else "\n".join(kept)
    found = line_dedup.keep_first_lines(documents(spark, rows, extra)).select("row.doc_id", "row.text", "clean", "n_lines", "n_removed").collect()
    assert {(r.doc_id, r.text): r.clean for r in found} == want
    for r in found:
        assert r.n_lines == (0 if r.text is None else r.text.count("\n") + 1)
        kept = 0 if r.clean in (None, "") else r.clean.count("\n") + 1
        assert r.n_removed in (r.n_lines - kept, r.n_lines - kept - 1)


def test_lines_of_two_unit_characters(spark):
    base = "".join(chr(0x1F600 + i % 70) for i in range(60))
    rows = [(1, base, "", "", 1), (2, base[:58] + "ab", "", "", 1), (3, base[::-1], "", "", 1), (4, base[:30] + "x" + base[31:], "", "", 1)]
    norm, lines, low = _line_groups(rows)
    found = {r.doc_id: r.clean for r in line_dedup.keep_first_lines(documents(spark, rows)).select("row.doc_id", "clean").collect()}
    first = {}
    for r in rows:
        first.setdefault(low[lines[norm(r[1])]], r[0])
    assert found == {r[0]: r[1] if first[low[lines[norm(r[1])]]] == r[0] else "" for r in rows}


def test_repeated_rows_keep_their_lines_once(spark):
    rows = [(1, "the same long line\nand another one", "en", "s", 1)] * 3
    found = line_dedup.keep_first_lines(documents(spark, rows)).select("clean").collect()
    assert sorted(r.clean for r in found) == ["", "", rows[0][1]]
    assert line_dedup.dedup_lines(documents(spark, rows)).select("n_chars").collect()[0][0] == len(rows[0][1])
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_line_signatures_run_without_python(spark):
    plan = line_dedup.signatures(line_dedup._lines(line_dedup.numbered_rows(documents(spark)), "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _region(spark, count, order):
    rows = spark.range(count).select(F.lit(1).cast("long").alias("region"), order.alias("ord"), F.col("id").alias("node"), F.lit(1).alias("n"), F.lit(True).alias("first"))
    return candidates.crowded_regions(rows)


def test_line_signatures_place_shingles_in_whole_numbers(spark):
    lines = line_dedup._lines(line_dedup.numbered_rows(documents(spark)), "text")
    plan = line_dedup.signatures(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "FLOOR" not in plan.upper()


def test_all_members_of_a_leaf_meet(spark, monkeypatch):
    monkeypatch.setattr(candidates, "LEAF", 900)
    monkeypatch.setattr(candidates, "CROWD", 128)
    members = _region(spark, 900, F.array(F.col("id"), F.col("id"), F.col("id")))
    labels = candidates.link_rounds(members, lambda pairs: pairs.where("a % 300 = b % 300 or (b < 200 and a % 300 < 150 and b % 300 < 150)"), "true", lambda a, b: F.lit(True))
    want = groups(900, [(i, i % 300) for i in range(300, 900)] + [(i, i + 1) for i in range(149)])
    assert {r.node: r.root for r in labels.collect()} == dict(enumerate(want))


def test_pairs_of_a_mixed_region_grow_with_its_members(spark):
    met = {}
    for count in (1000, 3000, 9000):
        order = F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(3)) for k in range(12)])
        members = _region(spark, count, order).withColumn("label", F.col("node"))
        met[count] = candidates.leaf_pairs(members, lambda a, b: F.lit(True)).count()
    print("pairs by members of one region:", met)
    assert met[9000] < 3.5 * met[3000] < 3.5 * 3.5 * met[1000] and met[9000] <= 9000 * candidates.LEAF


def test_members_of_equal_order_meet_a_leader(spark):
    members = _region(spark, 3000, F.array(F.lit(1), F.lit(2))).withColumn("label", F.col("node"))
    pairs = candidates.leaf_pairs(members, lambda a, b: F.lit(True))
    assert pairs.count() < 2 * 3000 and pairs.selectExpr("explode(array(a, b)) n").distinct().count() == 3000


def _recall(found, links):
    """The share of the links whose ends came out in one component."""
    return sum(found[a] == found[b] for a, b in links) / len(links)


def test_recall_on_hard_families(spark):
    """Templates, stars, chains and one large group of near copies; links by brute force."""
    rng = random.Random(21)
    rows = []
    template = prose(rng, 90)
    rows += [f"{template} {prose(rng, 35)}" for _ in range(500)]
    rows += [t.rsplit(" ", 3)[0] + " " + prose(rng, 3) for t in rows[:80]]
    for _ in range(12):
        hub = prose(rng, 100)
        rows += [hub, *[spoiled(rng, hub, 0.02) for _ in range(8)]]
    for _ in range(8):
        words = prose(rng, 120).split(" ")
        for _ in range(8):
            rows.append(" ".join(words))
            words = words[12:] + prose(rng, 12).split(" ")
    base = prose(rng, 100)
    rows += [spoiled(rng, base, 0.015) for _ in range(400)]
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(rows)]
    sets = list(_sets(docs))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    found = {r.doc_id: r.component_id for r in lsh_forest.cluster(documents(spark, docs)).select("row.doc_id", "component_id").collect()}
    low = groups(len(rows), links)
    assert not any(found[a] == found[b] and low[a] != low[b] for a in range(len(rows)) for b in range(a))
    print("recall of", len(links), "links between documents:", _recall(found, links))
    assert _recall(found, links) >= 0.95

    some = lambda count: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(count))
    change = lambda line, k: line[: (p := rng.randrange(len(line) - 4))] + some(k) + line[p + k :]
    lines, head = [], some(130)
    lines += [head + some(30) for _ in range(700)]
    lines += [line[:-4] + some(4) for line in lines[:120]]
    hub = [some(120) for _ in range(15)]
    lines += [change(h, 2) for h in hub for _ in range(8)] + hub
    for h in hub[:8]:
        for _ in range(8):
            h = change(h, 3)
            lines.append(h)
    lines += [change(hub[0][:100], 2) for _ in range(400)]
    docs = [(i, line, "", "", 1) for i, line in enumerate(lines)]
    norm, unique, low = _line_groups(docs)
    found = {r.doc_id: r.clean for r in line_dedup.keep_first_lines(documents(spark, docs)).select("row.doc_id", "clean").collect()}
    firsts = {}
    for i, line in enumerate(lines):
        if len(norm(line)) >= 8:
            firsts.setdefault(low[unique[norm(line)]], i)
    gone = [i for i, line in enumerate(lines) if len(norm(line)) >= 8 and firsts[low[unique[norm(line)]]] != i]
    assert all(found[i] == lines[i] for i in firsts.values())
    caught = sum(found[i] == "" for i in gone) / len(gone)
    print("repeated lines removed:", caught, "of", len(gone))
    assert caught >= 0.95


def test_planted_pairs_among_lines_of_one_template(spark):
    rng = random.Random(11)
    some = lambda count: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(count))
    template = some(150)
    lines = [template + some(30) for _ in range(600)]
    lines += [line[:-5] + some(5) for line in lines[:80]]
    rows = [(i, line, "", "", 1) for i, line in enumerate(lines)]
    _, _, low = _line_groups(rows)
    found = {r.doc_id: r.clean for r in line_dedup.keep_first_lines(documents(spark, rows)).select("row.doc_id", "clean").collect()}
    assert found == {i: line if low[i] == i else "" for i, line in enumerate(lines)}


def test_planted_pairs_among_documents_of_one_template(spark):
    rng = random.Random(12)
    template = prose(rng, 100)
    texts = [f"{template} {prose(rng, 22)}" for _ in range(120)]
    texts += [text.rsplit(" ", 2)[0] + " " + prose(rng, 2) for text in texts[:30]]
    rows = [(i, text, "en", "s", 1) for i, text in enumerate(texts)]
    _, low = _brute(rows)
    found = {r.doc_id: r.component_id for r in lsh_forest.cluster(documents(spark, rows)).select("row.doc_id", "component_id").collect()}
    assert found == dict(enumerate(low))


def test_lines_that_repeat_a_phrase_have_one_signature(spark):
    texts = ["the same words again " * 100, "the same words again " * 130, "-" * 200, "-" * 260, "ab" * 100, "ab" * 2500]
    rows = [(i, text.strip(), "", "", 1) for i, text in enumerate(texts)]
    signed = line_dedup.signatures(line_dedup._lines(line_dedup.numbered_rows(documents(spark, rows)), "text")).collect()
    bands = {}
    for r in signed:
        bands.setdefault(r.node, set()).add((r.half, tuple(r.bands)))
    assert len(bands) == 6 and len({frozenset(b) for b in bands.values()}) == 3
    found = {r.doc_id: r.clean for r in line_dedup.keep_first_lines(documents(spark, rows)).select("row.doc_id", "clean").collect()}
    assert found == {i: text if i % 2 == 0 else "" for i, text in enumerate(r[1] for r in rows)}


def _one_region(rows):
    """All nodes in one region whose order divides nothing."""
    nodes = rows.groupBy("node").agg(F.max("n").alias("n"))
    return nodes.select(F.lit(1).cast("long").alias("region"), "node", "n", F.array(F.lit(1)).alias("ord"), F.lit(True).alias("first"))


def test_documents_of_a_region_that_nothing_divides_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "crowded_regions", lambda rows, deepen: candidates.crowded_regions(_one_region(rows)))
    rng = random.Random(13)
    template = prose(rng, 100)
    texts = [f"{template} {prose(rng, 22)}" for _ in range(120)]
    texts += [text.rsplit(" ", 2)[0] + " " + prose(rng, 2) for text in texts[:30]]
    texts += [prose(rng, 3), prose(rng, 6)]
    rows = [(i, text, "en", "s", 1) for i, text in enumerate(texts)]
    _, low = _brute(rows)
    found = {r.doc_id: r.component_id for r in lsh_forest.cluster(documents(spark, rows)).select("row.doc_id", "component_id").collect()}
    assert found == dict(enumerate(low))


def test_lines_of_a_region_that_nothing_divides_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "crowded_regions", lambda rows: candidates.crowded_regions(_one_region(rows)))
    rng = random.Random(14)
    some = lambda count: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(count))
    template = some(150)
    lines = [template + some(30) for _ in range(100)]
    lines += [line[:-5] + some(5) for line in lines[:40]]
    wide = "".join(chr(0x1F600 + i % 70) for i in range(60))
    lines += [wide, wide[:58] + "ab", wide[::-1], "ab" * 40, "ab" * 90]
    rows = [(i, line, "", "", 1) for i, line in enumerate(lines)]
    _, _, low = _line_groups(rows)
    found = {r.doc_id: r.clean for r in line_dedup.keep_first_lines(documents(spark, rows)).select("row.doc_id", "clean").collect()}
    assert found == {i: line if low[i] == i else "" for i, line in enumerate(lines)}


def test_rare_pairs_are_whole_and_few(spark):
    """Every pair with the similarity is met; members that share frequent elements only are not."""
    rng = random.Random(15)
    sets = [set(range(40)) | {1000 * i + k for k in range(100, 120)} for i in range(1, 401)]
    sets += [set(rng.sample(sorted(s), len(s) - 6)) | {10**6 + 9 * i + k for k in range(rng.randrange(5))} for i, s in enumerate(sets[:50])]
    table = spark.createDataFrame([(i, t) for i, s in enumerate(sets) for t in s], "node long, token long")
    members = spark.range(len(sets)).select(F.lit(1).alias("region"), F.col("id").alias("node"), F.col("id").alias("label"))
    found = {(r.a, r.b) for r in candidates.rare_pairs(members, lambda nodes: table.join(nodes, "node", "left_semi"), 80).collect()}
    links = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert len(links) >= 30 and links <= found and len(found) <= 4 * len(sets)


def test_last_round_takes_only_regions_left_open(spark):
    """A region whose members were all neighbours is done, a small one is compared pair by pair, a large one by its sets."""
    rows = [(1, i) for i in range(9)] + [(2, 100 + i) for i in range(12)] + [(3, 200 + i) for i in range(40)]
    members = spark.createDataFrame(rows, "region long, node long").selectExpr("region", "0L part", "array(1) ord", "node", "1 n", "false first", "node label")
    asked = []

    def sets(nodes):
        asked.extend(r.node for r in nodes.collect())
        return nodes.selectExpr("node", "explode(sequence(node div 2 * 10, node div 2 * 10 + 8)) token")

    found = {(r.a, r.b) for r in candidates.open_pairs(members, sets, 80, 8, 16, "true").collect()}
    assert sorted(asked) == list(range(200, 240))
    assert {(a, b) for a, b in found if b < 200} == {(a, b) for b in range(100, 112) for a in range(100, b)}
    assert {(a, b) for a, b in found if b >= 200} == {(a, a + 1) for a in range(200, 240, 2)}


def test_turns_of_the_signature_share_no_band(spark):
    rows = [(1, "one line of words that is long enough for all bins\nanother of the lines here", "", "", 1)]
    lines = line_dedup._lines(line_dedup.numbered_rows(documents(spark, rows)), "text")
    one, two = ({b for r in line_dedup.signatures(lines, turn).collect() for b in r.bands} for turn in (0, 1))
    assert one and two and not one & two


def test_shuffle_files_of_the_last_query_go_too(spark):
    files = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    written = session.cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    own = files() - before
    assert own
    session.drop_shuffles(spark)
    until = time.time() + 20
    while own & files() and time.time() < until:
        time.sleep(0.2)
    assert not own & files()
    session.release(written)


def test_lines_drop_shuffles_between_their_large_steps(spark, monkeypatch):
    steps = []
    for module in (candidates, line_dedup):
        cut, drop, free = module.cut_lineage, module.drop_shuffles, module.release

        def cut_lineage(df, label="step", *rest, cut=cut):
            steps.append(label)
            return cut(df, label, *rest)

        def drop_shuffles(spark, drop=drop):
            steps.append("drop")
            drop(spark)

        def release(*frames, free=free):
            steps.extend(f"-{f._scratch.rpartition('/')[2].partition('-')[0]}" for f in frames)
            free(*frames)

        for made in (cut_lineage, drop_shuffles, release):
            monkeypatch.setattr(module, made.__name__, made)
    rng = random.Random(23)
    lines = [prose(rng, 12) for _ in range(20)]
    rows = [(i, "\n".join([rng.choice(lines), spoiled(rng, rng.choice(lines), 0.04), prose(rng, 9)])) for i in range(60)]
    assert line_dedup.keep_first_lines(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)
    for label in ("held", "spots", "texts", "pairs", "verified", "gone"):
        for at in [i for i, x in enumerate(steps) if x == label]:
            assert next(x for x in steps[at + 1 :] if x[0] != "-") == "drop", (label, steps[at : at + 8])
    assert {"-places", "-texts", "-marks"} <= set(steps)


def test_lines_are_brought_to_their_normal_form_once(spark):
    texts = ["  Abcdefgh\t", "\r\tÉcole élémentaire \r", "short", "a b c d \t", "\U0001f600" * 8, "\U0001f600" * 7, "İstanbul", " \t\r", "", "x y\tz of\rsome words", None]
    rows = spark.createDataFrame([(i, (t,)) for i, t in enumerate(["\n".join(t for t in texts if t is not None), *texts])], "uid long, row struct<text string>")
    found = line_dedup._lines(rows, "text")
    plain = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("lower(btrim(t, ' \\t\\r')) norm").where("length(norm) >= 8")
    want = sorted(r.norm for r in plain.collect())
    assert len(want) == 5
    assert sorted(r.norm for r in found.collect()) == sorted(want * 2)
    plan = found.select(line_dedup.line_id(F.col("norm")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") == 1
