import hashlib
import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldcohort.llm import chat_format as chat

TURNS = "conv_id long, turn long, role string, text string"


def _rows():
    rng = random.Random(3)
    bits = ["</s>", "[INST]", "[/INST]", "<\\/s>", "[\\\\INST]", "<|start|>", "<|next|>", "<|end|>", "<|message|>", "\\", "<", "[", "é", "🙂", "\n", " ", "ok", "<|im_end|>", "$0"]
    some = lambda n: "".join(rng.choice(bits) for _ in range(rng.randrange(n)))
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system"]), some(9)) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(1000, t, rng.choice(["user", "assistant"]), some(6)) for t in range(700)]
    rows += [(1001, t, "assistant", some(4)) for t in range(200)]
    rows += [(2000, 1, "user", None), (2000, 2, None, "a"), (2001, None, "user", "b"), (2001, 0, "assistant", ""), (None, 3, "user", "c"), (None, None, None, None)]
    rows += [(2002, 5, "user", "same")] * 3 + [(2003, 0, "a<|message|>b\n", "x" * 100_000), (2003, 1, "assistant", "é" * 100_000)]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    return rows


def _escaped(text):
    return re.sub("|".join(rf"{re.escape(f)}(?=\\*(?:{'|'.join(re.escape(c[1:]) for c in chat.CONTROLS if c[0] == f)}))" for f in "<["), lambda m: m[0] + "\\", text)


def _brute(rows):
    out = {}
    key = lambda r: tuple((x is not None, x) for x in r[1:2]) + (r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        text, spans = "", []
        for role, run in itertools.groupby(turns, key=lambda t: t[0]):
            text += chat.OPEN + _escaped(role) + chat.BODY
            for i, (_, said) in enumerate(run):
                text += chat.NEXT if i else ""
                if role == "assistant":
                    spans.append((len(text), len(_escaped(said))))
                text += _escaped(said)
            text += chat.CLOSE
        out[conv] = turns, text, spans
    return out


@pytest.fixture(scope="module")
def parts(spark):
    df = spark.createDataFrame(_rows(), TURNS).selectExpr("*", "role row", "turn part", "text formatted", "turn number")
    return chat.format_parts(df).cache()


def test_formatted_conversations_equal_brute_force(parts):
    want = _brute(_rows())
    found = {r.conv_id: (r.formatted, [tuple(s) for s in r.loss]) for r in chat.whole_conversations(parts).collect()}
    assert found == {c: (text, spans) for c, (_, text, spans) in want.items()}
    assert max(r.n_turns for r in parts.collect()) <= chat.PART and parts.where("conv_id = 1000").count() > 10


def test_read_back_gives_the_turns(parts):
    want = _brute(_rows())
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = chat.digests(parts).collect()
    assert len(found) == len(want)
    for r in found:
        turns, text, spans = want[r.conv_id]
        learnt = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.formatted_chars, r.loss_chars) == (len(turns), len(text), len(learnt))
        assert r.turns_sha256 == digest("".join(f"{role}\n{t}\n" for role, t in turns)) and r.loss_sha256 == digest(learnt)


def test_no_control_string_is_left_inside_a_text(parts):
    marks = "|".join(map(re.escape, (chat.OPEN, chat.BODY, chat.NEXT, chat.CLOSE)))
    for r in parts.collect():
        for piece in re.split(marks, r.formatted):
            assert not any(c in piece for c in chat.CONTROLS)


def test_control_strings_hold_no_other():
    assert not any(c in d[1:] or c in d and c != d for c in chat.CONTROLS for d in chat.CONTROLS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "[", "\\", "/", "/s>", ">", "INST]", "|", "<|end|>", "[INST]", "<<SYS>>", "é"]), max_size=12).map("".join))
def test_escapes_are_reversible(text):
    escaped = _escaped(text)
    assert not any(c in escaped for c in chat.CONTROLS)
    assert re.sub(chat.UNESCAPE, "", escaped) == text


def test_no_turns_give_no_rows(spark):
    assert chat.digests(chat.format_parts(spark.createDataFrame([], TURNS))).count() == 0
