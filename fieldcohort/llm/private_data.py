"""Personal data in texts, by weak supervision.

Strict patterns give the base spans, looser ones more candidates. Labelers of
three sorts (patterns and check digits, gazetteers, context) vote for, against
or not at all. Expectation-maximisation over the counts of vote patterns finds
how reliable each labeler is, and the resulting probabilities train a logistic
classifier of spans, which decides about the candidates beyond the base.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds in the order of their names in span lists; the first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = ("form", "check", "gazetteer", "context", "shape", "edges")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, so looking back changes nothing but the cost.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-][0-9]{3,4}(?![0-9.-])")
LOOSE_EMAIL = re.compile(r"(?<![\w.])[A-Za-z0-9][A-Za-z0-9._-]{0,63} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]{2,63})+")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+")

# Gazetteers and context words.
TOP_DOMAINS = frozenset("com org net edu gov io info biz co uk de fr es it nl eu us ca au ch at be se no pl pt br in jp".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "2221", "23", "24", "25", "26", "34", "37", "35", "6011", "65")
CONTEXT = {
    "email": frozenset("email mail contact write e".split()),
    "ip": frozenset("ip host server address client from".split()),
    "card": frozenset("card visa mastercard amex credit debit payment cc".split()),
    "phone": frozenset("call phone tel telephone mobile cell fax whatsapp ring".split()),
    "secret": frozenset("token key secret password passwd pwd api bearer auth credential".split()),
}
AGAINST = frozenset("version isbn issn order invoice doi ticket license section chapter page figure table commit sha".split())
ORDINARY_HOSTS = ("0.0.0.0", "127.0.0.1", "255.255.255.255")

WORD = re.compile(r"[A-Za-z]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            after = found.end()
        at = text.find("@", max(at + 1, after))
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the strict patterns, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _more_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Looser candidates that overlap no base span."""
    out = []
    if "at" in text and ("dot" in text or "(at)" in text or "[at]" in text):
        out += [(m.start(), 0, m.end()) for m in LOOSE_EMAIL.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(_digits(m.group())) <= 19]
    out += [(m.start(), 3, m.end()) for m in LOOSE_PHONE.finditer(text)]
    for m in SECRET.finditer(text):
        value = m.group()
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            out.append((m.start(), 4, m.end()))
    return free_spans(base, out)


def free_spans(base: list[tuple[int, int, int]], out: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The candidates, by start, that overlap neither a base span nor one kept before.

    Base spans are found by start, with the farthest end up to each, so many
    spans in one text cost a logarithm each.
    """
    taken = sorted((a, b) for a, _, b in base)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    kept, last = [], 0
    for start, kind, end in sorted(out):
        before = bisect_left(starts, end)
        if start >= last and not (before and reach[before - 1] > start):
            kept.append((start, kind, end))
            last = end
    return kept


def votes(text: str, start: int, kind: int, end: int, strict: bool) -> tuple[int, ...]:
    """The votes of all labelers: 1 for personal data, -1 against, 0 for none."""
    value, name = text[start:end], KINDS[kind]
    digits = _digits(value)
    near = {w.lower() for w in WORD.findall(text[max(0, start - 40) : start])}
    check = gazetteer = 0
    if name == "card":
        check = 1 if _luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_STARTS) else -1
    elif name == "email":
        last = re.split(r"[^A-Za-z]+", value.rstrip(". "))[-1].lower()
        gazetteer = 1 if last in TOP_DOMAINS else -1
    elif name == "ip":
        gazetteer = -1 if value in ORDINARY_HOSTS else 0
        check = 1 if value.count(".") == 3 else 0
    elif name == "phone":
        check = 1 if 9 <= len(digits) <= 15 else -1
    elif name == "secret":
        check = 1 if len(set(value)) >= 10 else -1
    context = 1 if near & CONTEXT[name] else -1 if near & AGAINST else 0
    shape = -1 if digits and len(set(digits)) <= 2 and len(digits) >= 8 else 1 if name == "secret" and sum(c.isdigit() for c in value) >= 4 else 0
    before, after = text[start - 1 : start], text[end : end + 1]
    edges = -1 if before.isalnum() or after.isalnum() else 1
    return (1 if strict else 0, check, gazetteer, context, shape, edges)


def features(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """Small numbers that describe a span and its surroundings."""
    value, digits = text[start:end], _digits(text[start:end])
    size = end - start
    near = {w.lower() for w in WORD.findall(text[max(0, start - 40) : start])}
    before = text[max(0, start - 2) : start]
    return (
        kind, min(3, size // 12), min(3, int(4 * sum("0" <= c <= "9" for c in value) / size)), int(any(c in " .-()" for c in value)),
        int('"' in before or "'" in before), int("=" in text[max(0, start - 4) : start] or ":" in before), int(bool(near & CONTEXT[KINDS[kind]])), int(bool(near & AGAINST)),
        int(_luhn(digits)) if KINDS[kind] == "card" else 1, int(9 <= len(digits) <= 15) if KINDS[kind] == "phone" else 1,
    )


SIZES = (len(KINDS), 4, 4, 2, 2, 2, 2, 2, 2, 2)
SPAN = T.StructType([T.StructField(c, T.BooleanType() if c == "base" else T.IntegerType()) for c in ("start", "end", "kind", "base", "votes", "features")])


def _code(values, sizes) -> int:
    out = 0
    for v, s in zip(values, sizes):
        out = out * s + v
    return out


def candidates(text: str) -> list[dict]:
    base = base_spans(text)
    out = []
    for strict, spans in ((True, base), (False, _more_spans(text, base))):
        for start, kind, end in spans:
            vote = _code([v + 1 for v in votes(text, start, kind, end, strict)], [3] * len(LABELERS))
            out.append({"start": start, "end": end, "kind": kind, "base": strict, "votes": vote, "features": _code(features(text, start, kind, end), SIZES)})
    return sorted(out, key=lambda s: (s["start"], s["kind"], s["end"]))


@F.arrow_udf(T.ArrayType(SPAN))
def found_spans(texts: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("features", pa.int32())]))
    return pa.array([candidates(t.as_py() or "") for t in texts], kind)


def _unpack(codes: np.ndarray, sizes) -> np.ndarray:
    out = np.empty((len(codes), len(sizes)), int)
    left = codes.copy()
    for j in range(len(sizes) - 1, -1, -1):
        out[:, j] = left % sizes[j]
        left = left // sizes[j]
    return out


def estimate(patterns: pd.DataFrame, rounds: int = 200) -> np.ndarray:
    """P(personal) of each row (kind, votes, n), by expectation-maximisation.

    For each kind the model has a prior and, for each labeler, the chances of
    its three votes for either truth (all smoothed by one). It starts from the
    balance of the votes.
    """
    kinds, n = patterns["kind"].to_numpy(), patterns["n"].to_numpy(float)
    vote = _unpack(patterns["votes"].to_numpy(), [3] * len(LABELERS))
    truth = 1 / (1 + np.exp(-(vote - 1).sum(axis=1).astype(float)))
    for _ in range(rounds):
        old = truth
        logs = np.zeros((len(n), 2))
        for k in np.unique(kinds):
            mine = kinds == k
            weight = np.stack([n[mine] * (1 - truth[mine]), n[mine] * truth[mine]], axis=1)
            logs[mine] += np.log((weight.sum(axis=0) + 1) / (weight.sum() + 2))
            for j in range(len(LABELERS)):
                table = np.ones((3, 2))
                np.add.at(table, vote[mine, j], weight)
                logs[mine] += np.log(table / table.sum(axis=0))[vote[mine, j]]
        truth = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(truth - old).max(initial=0) < 1e-9:
            break
    return truth


def _columns(codes: np.ndarray) -> np.ndarray:
    """One-hot features with a constant."""
    values = _unpack(codes, SIZES)
    parts = [np.eye(s)[values[:, j]] for j, s in enumerate(SIZES)]
    by_kind = [parts[0] * values[:, j : j + 1] for j in (6, 7, 8, 9)]
    return np.concatenate([np.ones((len(codes), 1)), *parts, *by_kind], axis=1)


def train(codes: np.ndarray, target: np.ndarray, n: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by Newton steps with a small ridge."""
    x = _columns(codes)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - target)) + w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row's other columns (struct ``row``) with ``base`` and ``spans``.

    Both are arrays of (start, end, kind) in code points, end exclusive, sorted
    by start and kind. ``spans`` holds all of ``base`` and those further
    candidates to which the classifier gives at least one half. Null and empty
    texts have none; without any candidate nothing is trained. Texts are
    scanned whole, once. Only counts of vote and feature patterns reach the
    driver, of which there are at most 3 ** 6 patterns of votes times 10 240 of features, and in practice some dozens.
    """
    text_batches(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    scanned = docs.select(F.struct(*others).alias("row"), found_spans(F.col(f"`{text}`")).alias("found"))
    scanned = cut_lineage(scanned, "spans")
    counted = scanned.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes", "s.features").agg(F.count(F.lit(1)).alias("n")).toPandas()
    chosen: list[int] = []
    if len(counted):
        counted = counted.sort_values(["kind", "votes", "features"], ignore_index=True)
        patterns = counted.groupby(["kind", "votes"], as_index=False)["n"].sum()
        patterns["truth"] = estimate(patterns)
        rows = counted.merge(patterns[["kind", "votes", "truth"]], on=["kind", "votes"])
        codes = rows["features"].to_numpy()
        weights = train(codes, rows["truth"].to_numpy(), rows["n"].to_numpy(float))
        every = np.unique(codes)
        chosen = [int(c) for c in every[_columns(every) @ weights >= 0]]
    accepted = F.array(*[F.lit(c) for c in chosen]) if chosen else F.array().cast("array<int>")
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    found = F.coalesce("found", F.array().cast(scanned.schema["found"].dataType))
    base = F.filter(found, lambda s: s["base"])
    spans = F.filter(found, lambda s: s["base"] | F.array_contains(accepted, s["features"]))
    return scanned.select("row", plain(base).alias("base"), plain(spans).alias("spans"))


def count_of(spans: str, kind: int) -> Column:
    """How many spans are of a kind. The test takes the span alone: a second parameter would be its place."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the earlier wins."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        grown = F.concat(state["out"], gap, F.lit("<"), F.get(names, s["kind"]), F.lit(">"))
        return F.struct(F.when(fresh, s["end"]).otherwise(state["at"]).alias("at"), F.when(fresh, grown).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1, F.length(text))))
