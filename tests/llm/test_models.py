import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldcohort.llm import brown, common, private_data, queries, tokens, toxicity

from .cases import corpus, documents, empty, lower_words, prose


def _crc(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


@pytest.mark.parametrize("extra", [False, True])
def test_base_scores_equal_brute_force(spark, extra):
    rows = corpus()
    train = [r for r in rows if _crc(r[0], 7) != 2]
    counts = Counter(w for r in train for w in lower_words(r[1]))
    total, kinds = sum(counts.values()) + len(train), len(counts) + 1
    found = brown.score(documents(spark, rows, extra), common.fold("doc_id", 7) == 2, rounds=2).collect()
    want = sorted(
        ((r[0], _crc(r[0], 7) == 2, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, total, round(sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((len(train) + 1) / (total + kinds + 1)), 6)) for r in rows for w in [lower_words(r[1])]),
        key=str,
    )
    assert sorted(((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=str) == want


def test_class_model_is_a_distribution_and_beats_the_base(spark):
    rng = random.Random(3)
    left, right = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    texts = [" ".join(rng.choice(left if k % 2 else right) for k in range(rng.randrange(10, 60))) for _ in range(400)]
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    found = brown.score(docs, F.col("doc_id") % 5 == 0).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1] * 0.9 and found[0] > found[1]
    one = documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(["x y", "x x", "y", "", "z"] * 9)] + [(100, "x", "", "", 1), (101, "new", "", "", 1)])
    scored = {r.id: r.score for r in brown.score(one, F.col("doc_id") >= 100).collect()}
    assert all(s < 0 for s in scored.values())


@pytest.mark.parametrize("share", [brown.MIN_SHARE, 0.01])
def test_scores_equal_a_plain_class_model(spark, monkeypatch, share):
    monkeypatch.setattr(brown, "MIN_SHARE", share)
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randrange(0, 80)), "en", "s", 1) for i in range(150)] + corpus()
    docs, held = documents(spark, rows), common.fold("doc_id", 7) == 2
    chunks = brown.encode(docs, "doc_id", "text", held)
    lexicon = chunks.select("chunk", F.explode(F.arrays_zip("lexicon", "counts")).alias("w")).select("chunk", F.col("w.lexicon").alias("word"), F.col("w.counts").alias("n"))
    known, training = brown.learn(chunks, lexicon)
    train = [r for r in rows if _crc(r[0], 7) != 2]
    counts = Counter(w for r in train for w in lower_words(r[1]))
    hashes = dict(zip(counts, tokens.word_hashes(pa.array(list(counts), pa.large_string()))[0].view(np.int64).tolist()))
    table = {r.word: (r.n, r["class"]) for r in known.collect()}
    assert training == len(train) and {hashes[w]: n for w, n in counts.items()} == {w: n for w, (n, _) in table.items()}
    # every word that occurs twice has a class of its choice, of the core or not, and no other word has
    assert all((c < brown.CLASSES) == (n >= 2) for n, c in table.values())
    core = sum(n >= max(2, share * (sum(counts.values()) + training)) for n in counts.values())
    assert (core < sum(n >= 2 for n in counts.values())) == (share == 0.01)

    cls = {w: table[hashes[w]][1] for w in counts}
    lines = [["", *lower_words(r[1]), ""] for r in train]
    of = lambda w: brown.END if w == "" else cls.get(w, brown.OTHER)
    bigrams = Counter((of(a), of(b)) for line in lines for a, b in zip(line, line[1:]))
    starts = Counter()
    for (a, _), n in bigrams.items():
        starts[a] += n
    sizes = Counter()
    for w, n in counts.items():
        sizes[cls[w]] += n
    once = [w for w in counts if cls[w] == brown.OTHER]

    def emission(w):
        if w == "":
            return 1.0
        if of(w) != brown.OTHER:
            return counts[w] / sizes[of(w)]
        return (counts.get(w, 0) + 1) / (2 * len(once) + 1)

    assert abs(sum(emission(w) for w in counts) + emission("never seen") - len(set(cls.values()) | {brown.OTHER})) < 1e-9
    for a in range(brown.ALL):
        assert abs(sum((bigrams[a, b] + 1) / (starts[a] + brown.ALL) for b in range(brown.ALL)) - 1) < 1e-9

    def plain(text):
        line = ["", *lower_words(text), ""]
        return sum(math.log10((bigrams[of(a), of(b)] + 1) / (starts[of(a)] + brown.ALL) * emission(b)) for a, b in zip(line, line[1:]))

    found = sorted(((str(r.id), round(r.score, 6)) for r in brown.score(docs, held).collect()))
    assert found == sorted((str(r[0]), round(plain(r[1]), 6)) for r in rows)


def test_exchange_finds_the_two_sides():
    rng = np.random.default_rng(0)
    now = rng.integers(0, 2, 40)
    truth = np.arange(40) % 2
    for step in range(8):
        bigrams = np.zeros((brown.ALL, brown.ALL))
        left, right = np.zeros((40, brown.ALL)), np.zeros((40, brown.ALL))
        for a in range(40):
            for b in range(40):
                if truth[a] != truth[b]:
                    bigrams[now[a], now[b]] += 5
                    right[a, now[b]] += 5
                    left[b, now[a]] += 5
        moved = brown.best_classes(left, right, now, bigrams)
        now = np.where(np.arange(40) // 2 % 2 == step % 2, moved, now)
    pairs = {(t, c) for t, c in zip(truth, now)}
    assert len({c for t, c in pairs if t == 0} & {c for t, c in pairs if t == 1}) == 0


def test_words_of_no_class_join_the_best(monkeypatch):
    rng = np.random.default_rng(4)
    bigrams = rng.integers(0, 50, (brown.ALL, brown.ALL)) + np.eye(brown.ALL, k=1, dtype=int) * 500
    left, right = rng.integers(0, 3, (90, brown.ALL)), rng.integers(0, 3, (90, brown.ALL))
    bigrams[:, brown.OTHER] += left.sum(axis=0)
    bigrams[brown.OTHER, :] += right.sum(axis=0)
    monkeypatch.setattr(brown, "SLICE", 1)
    one_by_one = brown.best_classes(left, right, np.full(90, brown.OTHER), bigrams)
    assert (brown.join_classes(left, right, bigrams) == one_by_one).all()
    monkeypatch.undo()
    assert np.mean(brown.join_classes(left, right, bigrams) == one_by_one) > 0.8
    assert len(brown.join_classes(left[:0], right[:0], bigrams)) == 0


def test_scores_without_training_or_rows(spark):
    assert brown.score(empty(spark), F.lit(False)).count() == 0
    found = brown.score(documents(spark, corpus()[:3]), F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in found} == {(0, 0, 0.0)}


def _base_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(9)
    pieces = ["a@b.co", "x@y", "@", "..", "a@b.c@d.e", "_z@q.w-e.r", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+12345", "+1 234 567 890 123 456", "é", "ß ", " ", "\n", "-", "9" * 30, "0" * 14, "%+-", "token = ", "12"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 7)))
        assert private_data.base_spans(text) == _base_spans(text), text
    assert private_data.base_spans("a" * 200_000 + "1" * 200_000) == []


def test_personal_data_counts_of_the_query(spark, tmp_path):
    rows = [(1, "10.2.3.4 and 10.2.3.5 and 10.2.3.6"), (2, "a@b.co"), (3, "4111 1111 1111 1111, x@y.org, +1 (017) 555-7713"), (4, None), (5, ""), (6, "+1 (017) 555-7713 or +1 (017) 555-7714"), (6, "1.2.3.4"), (None, "c@d.org e@f.org")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op6_weak_supervision(spark, str(tmp_path)).collect()

    def expected(doc_id, text):
        spans = _base_spans(text or "")
        names = ",".join(f"{private_data.KINDS[kind]}:{a}:{b}" for a, kind, b in spans)
        return (doc_id, *[sum(s[1] == k for s in spans) for k in range(4)], hashlib.sha256(names.encode()).hexdigest())

    got = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found]
    assert sorted(got, key=str) == sorted((expected(*r) for r in rows), key=str)


def test_personal_data_of_all_rows(spark):
    rng = random.Random(2)
    secret = hashlib.sha1(b"k").hexdigest()
    kinds = ["mail me at ann.b@example.org ", "call +1 (017) 555-7713 now ", "card 4111 1111 1111 1111 ", "from host 10.2.3.4 ", f'token = "{secret}" ', "order 1234567812345678 ", "call (017) 555-7714 "]
    rows = [(i, prose(rng, 10) + " " + kinds[i % 7] + prose(rng, 10), "en", "s", 1) for i in range(140)] + corpus()
    found = private_data.personal_data(documents(spark, rows, extra=True)).select("row.doc_id", "base", "spans", private_data.spelled(F.col("spans")).alias("spelled")).collect()
    assert len(found) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1] or "")
    for r in found:
        base = [(s.start, s.kind, s.end) for s in r.base]
        assert any(base == _base_spans(t) for t in texts[r.doc_id]) and set(r.base) <= set(r.spans)
        assert r.spelled == ",".join(f"{private_data.KINDS[s.kind]}:{s.start}:{s.end}" for s in r.spans)
    planted = [r for r in found if r.doc_id is not None and r.doc_id < 140 and r.doc_id % 7 == 4 and r.spans]
    assert len(planted) >= 18 and all(s.kind == 4 for r in planted for s in r.spans)
    assert not any(s.kind == 2 for r in found if r.doc_id is not None and r.doc_id < 140 and r.doc_id % 7 == 5 for s in r.spans)
    assert private_data.personal_data(empty(spark)).count() == 0
    whole = documents(spark, rows[:7])
    hidden = private_data.personal_data(whole.withColumn("copy", F.col("text"))).select(private_data.masked(F.col("row.copy"), F.col("spans")).alias("t")).collect()
    assert sum("<email>" in r.t and "@" not in r.t for r in hidden) == 1


def test_estimation_finds_the_unreliable_labeler():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.4
    vote = np.stack([np.where(rng.random(4000) < good, truth, ~truth) * 2 for good in (0.95, 0.9, 0.5, 0.9, 0.85, 0.8)], axis=1).astype(int)
    codes = (vote * 3 ** np.arange(5, -1, -1)).sum(axis=1)
    patterns = pd.DataFrame({"kind": 0, "votes": codes}).groupby(["kind", "votes"], as_index=False).size().rename(columns={"size": "n"})
    chance = dict(zip(patterns["votes"], private_data.estimate(patterns)))
    assert np.mean((np.array([chance[c] for c in codes]) >= 0.5) == truth) > 0.97


def _labelled(spark, rng, count=600):
    rows, labels = [], []
    for i in range(count):
        toxic = i % 4 == 0
        text = prose(rng, 30) + (" you are such trashy folk" if toxic else "") + (" muslim" if toxic and i % 8 == 0 else "")
        rows.append((i, text, "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(9000, None, None, None, None), (9001, "", None, None, None), (None, "trashy", None, None, None)]
    labels += [(None, 1, 1), (5, 1, None), (9000, None, 0), (3, 1, 0), (3, 1, 0)]
    return documents(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_texts_are_found_and_mentions_are_not(spark):
    docs, labels = _labelled(spark, random.Random(1))
    learn_from = common.fold("doc_id", 5) != 0
    model = toxicity.learn(docs, labels, learn_from)
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).select("row.doc_id", "score").collect()}
    held = [i for i in range(600) if _crc(i, 5) == 0]
    assert np.mean([(found[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.98
    assert found[9000] == found[9001] and 0 <= found[9000] <= 1
    plain = toxicity.learn(docs, labels, learn_from, penalty=0.0)
    probe = documents(spark, [(1, "my muslim friend", "", "", 1), (2, "my christian friend", "", "", 1)])
    gap = [abs(a - b) for a, b in ([r.score for r in toxicity.score(probe, m).orderBy("row.doc_id").collect()] for m in (model, plain))]
    assert gap[0] < gap[1] / 2 and gap[0] < 0.02


def test_nothing_to_learn_from(spark):
    docs, labels = _labelled(spark, random.Random(2), 20)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        model = toxicity.learn(docs, some, F.lit(True))
        scores = {r.score for r in toxicity.score(docs, model).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 0.5
    assert toxicity.score(empty(spark), model).count() == 0


def test_swapped_sentences_change_the_features_they_would(spark):
    """Against features of texts in which the term is really replaced, at all levels."""
    texts = ["a muslim and a muslim, muslims too", "Women women women women men", "white-washed whites white", "no term", "", "old old young gay\u00e9 gay", "black " * 5 + "native nat nation"]
    hashes = np.unique(np.concatenate([np.unique(toxicity._levels(*toxicity.feature_hashes(pa.array([t + " " + " ".join(toxicity.TERMS) * k for t in texts], pa.large_string())))[1]) for k in (1, 2, 4)]))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = {r.i: sorted(tuple(c) for c in r.c) for r in df.select("i", toxicity.swap_changes(hashes)("text").alias("c")).collect()}

    def features(text):
        return set(toxicity._levels(*toxicity.feature_hashes(pa.array([text], pa.large_string())))[1].tolist())

    for i, text in enumerate(texts):
        want = []
        for group in toxicity.IDENTITIES:
            for term in group:
                whole = re.compile(rf"(?<![0-9a-z\u0080-\uffff]){term}(?![0-9a-z\u0080-\uffff])", re.I)
                for other in group:
                    if other != term and whole.search(text):
                        before, after = features(text), features(whole.sub(other, text))
                        spot = lambda h: int(np.searchsorted(hashes, h))
                        known = set(hashes.tolist())
                        want.append((len(group) - 1, *sorted([-spot(h) - 1 for h in (before - after) & known] + [spot(h) + 1 for h in (after - before) & known])))
        assert found[i] == sorted(w for w in want if len(w) > 1)
    assert any(len(c) > 12 for c in found[0])


def test_training_finds_the_least_of_its_objective():
    rng = np.random.default_rng(3)
    texts, width = 60, 9
    dense = rng.random((texts, width)) < 0.4
    label = (dense[:, 0] | (rng.random(texts) < 0.2)).astype(float)
    row, column = np.nonzero(dense)
    differences = [(np.array([0, 1]), np.array([-1.0, 1.0]), 2.0), (np.array([2, 3, 4]), np.array([1.0, -1.0, 1.0]), 0.5)]

    def objective(w, b):
        logit = b + dense @ w
        loss = np.logaddexp(0, logit).sum() - label @ logit + toxicity.RIDGE * w @ w / 2
        return loss + sum(5.0 * times * float(w[c] @ s) ** 2 / 2 for c, s, times in differences)

    w, b = toxicity.train(row, column, label, width, differences, 5.0)
    best = objective(w, b)
    for k in range(width):
        for step in (-0.02, 0.02):
            assert objective(w + step * np.eye(width)[k], b) > best - 1e-6
    assert objective(w, b + 0.02) > best - 1e-6 and objective(w, b - 0.02) > best - 1e-6
    free, _ = toxicity.train(row, column, label, width, [], 5.0)
    assert abs(w[0] - w[1]) < abs(free[0] - free[1])


def test_free_spans_equal_the_comparison_of_all():
    rng = random.Random(5)
    for _ in range(300):
        some = lambda n: [(a := rng.randrange(60), rng.randrange(5), a + rng.randrange(1, 9)) for _ in range(rng.randrange(n))]
        base, out = some(8), some(20)
        taken, kept = [(a, b) for a, _, b in base], []
        for start, kind, end in sorted(out):
            if all(b <= start or a >= end for a, b in taken):
                kept.append((start, kind, end))
                taken.append((start, end))
        assert private_data.free_spans(base, out) == kept
    many = [(20 * i, 3, 20 * i + 10) for i in range(200_000)]
    assert private_data.free_spans(many, [(20 * i + 10, 4, 20 * i + 15) for i in range(200_000)]) == [(20 * i + 10, 4, 20 * i + 15) for i in range(200_000)]
