import random
import re
from collections import Counter

import pytest

from fieldcohort.llm import decontaminate, line_quality

from .cases import corpus, documents, empty, prose, words


def _base(text):
    w = words(text)
    held = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if held[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def _key(line):
    return re.sub(r"[ \t\r]+", " ", re.sub("[0-9]", "0", line.lower())).strip(" ")


@pytest.mark.parametrize("extra", [False, True])
def test_counts_and_furniture_equal_brute_force(spark, extra):
    rows = corpus() + [(500, "a b c a b c\na b c a b c\n#*$ %&|\n<>", "en", "src9", 1)]
    hosts = {}
    for r in rows:
        if r[1] is not None:
            hosts.setdefault(r[3], set()).add(r[1])
    found = line_quality.judge(documents(spark, rows, extra), least=5, share_pct=20).collect()
    assert len(found) == len(rows)
    removed = 0
    for r in found:
        text, host = r.row.text, r.row.source
        assert tuple(r[c] for c in line_quality.COUNTS) == _base(text)
        lines = (text or "").split("\n")
        often = lambda line, host=host: sum(_key(line) in map(_key, t.split("\n")) for t in hosts.get(host, ()))
        gone = [i for i, line in enumerate(lines) if line.strip(" \t\r") and often(line) >= 5 and 100 * often(line) >= 20 * len(hosts[host])]
        clean = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        assert r.n_removed == len(gone) and r.clean == (text if not gone else clean)
        n = len(words(text))
        left = n - sum(len(words(lines[i])) for i in gone)
        assert r.base_failed == (n < 50 or 100 * _base(text)[4] > 50 * n)
        assert r.kept == (not r.base_failed and 100 * left >= 50 * n)
        removed += len(gone)
    assert removed > 0


def test_depleted_documents_go_and_good_ones_keep_their_columns(spark):
    rng = random.Random(1)
    boiler = prose(rng, 60)
    rows = [(i, f"{prose(rng, 80)}\n{boiler}", "en", "h", 1) for i in range(30)] + [(99, f"{prose(rng, 20)}\n{boiler}", "en", "h", 1)]
    kept = line_quality.good_documents(documents(spark, rows)).collect()
    assert {r.doc_id for r in kept} == set(range(30))
    assert all(r.n_chars == len(r.text) and boiler not in r.text for r in kept)
    copies = [(i, boiler + "\n" + boiler[::-1], "en", "h", 1) for i in range(40)]
    assert line_quality.good_documents(documents(spark, copies)).count() == 40
    assert line_quality.good_documents(empty(spark)).count() == 0


def _tokens(text):
    return [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if w]


def _brute_overlap(doc, item):
    """The best count of equal words around any place where a mask fits, over all alignments."""
    best = None
    for shift in range(-len(item), len(doc)):
        for at in range(len(item) - decontaminate.SPAN + 1):
            if not 0 <= at + shift <= len(doc) - decontaminate.SPAN:
                continue
            fits = any(all(item[at + i] == doc[at + shift + i] for i, bit in enumerate(m) if bit == "1") for m in decontaminate.MASKS)
            if fits:
                low, high = max(at - decontaminate.MARGIN, 0, -shift), min(at + decontaminate.SPAN + decontaminate.MARGIN, len(item), len(doc) - shift)
                same = sum(item[k] == doc[k + shift] for k in range(low, high))
                if same >= decontaminate.MIN_EQUAL and 100 * same >= decontaminate.MIN_SHARE_PCT * (high - low):
                    best = max(best or 0, same)
    return best


def test_passages_with_substitutions_are_found(spark):
    rng = random.Random(4)
    items = [(k, prose(rng, rng.randrange(12, 40), 800).capitalize() + ".") for k in range(12)] + [(50, None), (51, ""), (52, "too short an item"), (12, "baba " * 30)]
    rows = []
    for i in range(60):
        text = prose(rng, rng.randrange(0, 60), 800)
        if i % 2:
            passage = items[i % 12][1].split(" ")
            for _ in range(rng.randrange(0, 4)):
                passage[rng.randrange(len(passage))] = "zzz"
            text += " " + ", ".join(passage) + "\n" + prose(rng, 9, 800)
        rows.append((i, text, "en", "s", 1))
    rows += [(70, None, None, None, None), (71, "", None, None, None), (None, items[2][1], None, None, None), (72, items[3][1], "x", "y", 1), (72, items[3][1], "x", "y", 1), (73, "baba " * 45, "x", "y", 1)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(documents(spark, rows, extra=True), bench).collect()
    want = sorted(((r[0], k, n) for r in rows for k, t in items if (n := _brute_overlap(_tokens(r[1]), _tokens(t)))), key=str)
    assert sorted(((r.doc_id, r.item_id, r.n_equal) for r in found), key=str) == want
    assert {r[0] for r in want} >= {72, None, 73}
    exact = {r[0] for r in rows if any(len(_tokens(t)) >= 12 and " ".join(_tokens(t)) in " ".join(_tokens(r[1])) for _, t in items)}
    assert exact <= {r[0] for r in want}
    clean = decontaminate.clean_documents(documents(spark, rows), bench)
    assert clean.columns == documents(spark).columns and {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {r[0] for r in want}
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(documents(spark, rows), bench.limit(0)).count() == 0


def test_any_two_substitutions_in_fifteen_words_leave_a_seed():
    looked_at = [[i for i, bit in enumerate(m) if bit == "1"] for m in decontaminate.MASKS]
    for a in range(15):
        for b in range(a):
            assert any(not {a, b} & {p + i for i in mask} for mask in looked_at for p in range(15 - decontaminate.SPAN + 1))
