import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldcohort.llm import phrases

from .cases import DOCS, corpus, documents, empty, prose


def _pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def _brute(rows, least, top=None):
    f, sizes = Counter(), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for w in _pieces(r[1]):
            sizes[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    cand = {p: n for p, n in f.items() if len(p) > 2 and n >= least}
    longer = Counter()
    for p, n in cand.items():
        if len(p) == 4:
            for q in (p[:3], (p[0], *p[2:])):
                longer[q] = max(longer[q], n)
    out = {}
    for p, a in cand.items():
        if len(p) == 3 and longer[p] and 100 * longer[p] >= 50 * a:
            continue
        lang, *w = p
        score, _, l, r = min((1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i, w.decode(), -a, l, r, sizes[lang], -s) for lang, found in out.items() for i, (s, a, w, l, r) in enumerate(sorted(found)[:top], 1)}


def _rows():
    rng = random.Random(9)
    rows = corpus()
    words = ["the", "of", "New", "york", "city", "é", "x.y", "a,b", "\tz", "is"]
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(60)) + rng.choice([".", "\n", "; "]) + prose(rng, 30, 12), rng.choice(["en", "fr", None, "und", ""]), "s", 1) for i in range(150)]
    return rows + [(2000, "hot pair " * 3000, "en", "s", 1), (2001, "HOT PAIR. " * 50, "en", "s", 1)]


def _found(df, **options):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.collocations(df, **options).collect()}


@pytest.mark.parametrize("extra", [False, True])
def test_phrases_equal_brute_force(spark, extra):
    rows = _rows()
    assert _found(documents(spark, rows, extra).repartition(4)) == _brute(rows, 10, 2000)
    if not extra:
        assert _found(documents(spark, rows), least=3, top=None) == _brute(rows, 3)
        assert _found(documents(spark, rows), least=3, top=5) == _brute(rows, 3, 5)


def test_split_slots_and_many_buckets_change_nothing(spark, monkeypatch):
    rows = _rows()
    monkeypatch.setattr(phrases, "BUCKET", 500)
    monkeypatch.setattr(phrases, "CHUNK", 3000)
    monkeypatch.setattr(phrases, "CROWDED", 1)
    words, load, _ = phrases.vocabulary(documents(spark, rows).select("lang", "text"))
    route = phrases.Route(load)
    assert route.buckets > 20 and (route.parts > 1).any() and words.count() > 100
    assert _found(documents(spark, rows)) == _brute(rows, 10, 2000)


def test_equal_hashes_start_another_seed(spark, monkeypatch):
    real = phrases._seeded
    monkeypatch.setattr(phrases, "_seeded", lambda seed: real(seed) if seed > 1 else real(seed) & np.uint8(1))
    rows = _rows()
    words, _, seed = phrases.vocabulary(documents(spark, rows).select("lang", "text"))
    assert seed == 2 and words.count() == words.select("hash").distinct().count()
    assert _found(documents(spark, rows)) == _brute(rows, 10, 2000)


def test_no_texts_and_rare_phrases_give_no_rows(spark):
    assert _found(empty(spark)) == set()
    assert _found(spark.createDataFrame([(1, None, "en", "s", 1), (2, " .\n", None, "s", 0), (3, "one two three", "en", "s", 1)], DOCS)) == set()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 4), st.integers(0, 4), st.integers(1, 5)), max_size=80), st.integers(1, 12))
def test_quicksort_counts_every_frequent_prefix(rows, least):
    rows = [(a, b, c if b else 0, n) for a, b, c, n in rows]
    keys = [np.array([r[k] for r in rows], np.uint64) for k in range(3)]
    weight = np.array([r[3] for r in rows], np.int64)
    want = Counter()
    for a, b, c, n in rows:
        for p in {(a,), (a, b) if b else (a,), (a, b, c) if c else (a,)}:
            want[p] += n
    found = {}
    for depth, at, n in phrases.multikey_quicksort(keys, weight, np.array([least] * 3)):
        for i, count in zip(at, n):
            prefix = tuple(int(keys[k][i]) for k in range(depth + 1))
            assert prefix not in found
            found[prefix] = int(count)
    assert found == {p: n for p, n in want.items() if n >= least}
