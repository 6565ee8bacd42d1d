"""Language-model scores by a class-based bigram model over Brown classes.

The most frequent words start one class each. All others join them in bands of
falling frequency, and then words are exchanged between classes, each to the
class that raises the likelihood of the class bigrams most; every round counts
contexts over the whole training text. A text's probability is the product of class
transitions and word emissions, both smoothed.

The corpus is encoded once, as chunks of texts with a lexicon of their own, so
a task never needs more counts than its chunk has words. Every word that occurs
twice or more in the training texts gets a class. Words that hold two millionths
of the training tokens are the core: there are 500,000 of them at most whatever
the corpus, so their classes can be sent to every task, and they join in bands
and are exchanged. All others are the last band: they join the classes of the
core by the same gain, in buckets, and their classes stay a table. Words that
occur once share a class, which also holds the unseen ones.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, release
from . import common, tokens
from .common import text_batches, text_slices
from .tokens import word_hashes

for _module in (sys.modules[__name__], common, tokens):
    cloudpickle.register_pickle_by_value(_module)

CLASSES = 16
#: A word is of the core from this share of the training tokens; at most 1 / MIN_SHARE words are.
MIN_SHARE = 2e-6
#: A word has a class of its own choice from this many occurrences.
MIN_COUNT = 2
#: Each band of words that join is so many times as large as all before it.
BAND = 4
#: Rounds of exchange after the last band; every second word may move in one, the others in the next.
ROUNDS = 2
#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK = 16 << 20
#: Fixed classes after the exchanged ones: words that occur once or never, and the end of a text, which also stands before its start.
OTHER, END, ALL = CLASSES, CLASSES + 1, CLASSES + 2
#: A place of a lexicon and its class in one number: bits of the class, and their mask.
PLACE, MASK = 8, 255
#: Words that one task moves one after another, starting from the counts of the round.
BUCKET = 4096
#: Words outside the core that join between two updates of the counts.
SLICE = 64


def _chunks():
    """Chunks of texts: one row each, with tokens as places in the chunk's own lexicon."""
    names = ["chunk", "ids", "held", "first", "tokens", "lexicon", "counts"]

    def row(number: int, parts: list) -> pa.RecordBatch:
        hashes = np.concatenate([p[2] for p in parts])
        sizes = np.concatenate([p[3] for p in parts])
        held = np.concatenate([p[1] for p in parts])
        lexicon, places = np.unique(hashes.view(np.int64), return_inverse=True)
        trained = np.repeat(~held, sizes)
        counts = np.bincount(places[trained], minlength=len(lexicon))
        first = np.concatenate([[0], np.cumsum(sizes)])
        ids = pa.concat_arrays([p[0] for p in parts])
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = [
            pa.array([number], pa.int64()), one(ids), one(pa.array(held)), one(pa.array(first.astype(np.int64))),
            pa.array([pa.compress(places.astype("<i4").tobytes(), "zstd", asbytes=True)], pa.binary()), one(pa.array(lexicon)), one(pa.array(counts.astype(np.int64))),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def encode(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        parts, size = [], 0
        for batch in batches:
            for low, high, texts in text_slices(batch.column("text")):
                here = texts.nbytes
                if parts and size + here > CHUNK:
                    yield row(number, parts)
                    number, parts, size = number + 1, [], 0
                hashes, first = word_hashes(texts)
                held = batch.column("held")[low:high].to_numpy(zero_copy_only=False).astype(bool)
                parts.append((batch.column("id")[low:high], held, hashes, np.diff(first)))
                size += here
        if parts:
            yield row(number, parts)

    return encode


def encode(docs: DataFrame, doc_id: str, text: str, held_out: Column) -> DataFrame:
    text_batches(docs.sparkSession)
    chosen = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    whole = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(chosen.schema["id"].dataType)), T.StructField("held", T.ArrayType(T.BooleanType())),
        T.StructField("first", T.ArrayType(T.LongType())), T.StructField("tokens", T.BinaryType()), T.StructField("lexicon", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType())),
    ])
    return cut_lineage(chosen.mapInArrow(_chunks(), whole), "chunks", "zstd")


def _each(batch: pa.RecordBatch):
    """The chunks of a batch as numpy arrays by name."""
    for i in range(batch.num_rows):
        found = {}
        for name in batch.schema.names:
            value = batch.column(name)[i]
            if name in ("tokens", "kinds"):
                found[name] = value.as_py()
            elif name in ("chunk", "ids"):
                found[name] = value
            else:
                found[name] = value.values.to_numpy(zero_copy_only=False)
        size = 4 * int(found["first"][-1])
        found["tokens"] = np.frombuffer(pa.decompress(found["tokens"], size, "zstd", asbytes=True) if size else b"", "<i4")
        yield found


def _classes_of(lexicon: np.ndarray, words: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place among the exchanged words or -1, class) of each word of a lexicon."""
    if not len(words):
        return np.full(len(lexicon), -1), np.full(len(lexicon), OTHER)
    at = np.minimum(np.searchsorted(words, lexicon), len(words) - 1)
    at = np.where(words[at] == lexicon, at, -1)
    return at, np.where(at >= 0, classes[at], OTHER)


def _sequence(values: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """The values of all texts in a row, ``end`` after each text."""
    return np.insert(values, first[1:], end)


def _contexts(words: np.ndarray, classes: np.ndarray, active: np.ndarray):
    """Rows (word, context, n) of the training texts.

    For an active word: how often a class stands before (context) and after
    (ALL + context) it. For word -1: class bigrams (context: their pair).
    """
    numbers = np.cumsum(active) - 1
    chosen = np.flatnonzero(active)

    def count(batches):
        total = np.zeros(len(chosen) * 2 * ALL, np.int32)
        pairs = np.zeros(ALL * ALL, np.int64)
        for batch in batches:
            for c in _each(batch):
                at, cls = _classes_of(c["lexicon"], words, classes)
                own = np.where((at >= 0) & active[at], numbers[at], -1) if len(words) else at
                first = c["first"]
                line = _sequence(cls[c["tokens"]], first, END)
                place = _sequence(own[c["tokens"]], first, -1)
                train = np.repeat(~c["held"], np.diff(first) + 1)
                before = np.concatenate([[END], line[:-1]])
                after = np.concatenate([line[1:], [END]])
                pairs += np.bincount((before * ALL + line)[train], minlength=len(pairs))
                use = train & (place >= 0)
                spot = place[use] * (2 * ALL)
                total += np.bincount(spot + before[use], minlength=len(total)).astype(np.int32)
                total += np.bincount(spot + ALL + after[use], minlength=len(total)).astype(np.int32)
        full = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(full), -1, np.int32)), pa.array(full.astype(np.int32)), pa.array(pairs[full])], ["word", "context", "n"])
        full = np.flatnonzero(total)
        for start in range(0, len(full), 1 << 18):
            part = full[start : start + (1 << 18)]
            columns = [pa.array(chosen[part // (2 * ALL)].astype(np.int32)), pa.array((part % (2 * ALL)).astype(np.int32)), pa.array(total[part].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "context", "n"])

    return count


def _counted(chunks: DataFrame, words: np.ndarray, classes: np.ndarray, active: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """(context rows of the active words, class bigrams) of the training texts."""
    rows = chunks.select("first", "held", "tokens", "lexicon").mapInArrow(_contexts(words, classes, active), "word int, context int, n long")
    rows = cut_lineage(rows.groupBy("word", "context").agg(F.sum("n").alias("n")), "contexts")
    bigrams = np.zeros(ALL * ALL, np.int64)
    for r in rows.where("word < 0").collect():
        bigrams[r.context] = r.n
    return rows, bigrams.reshape(ALL, ALL)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def best_classes(left: np.ndarray, right: np.ndarray, now: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The classes after each word in turn, the most frequent first, has moved to the class of largest likelihood.

    ``left`` and ``right`` count the classes before and after each word. The
    change of sum n(c, d) log n(c, d) - 2 sum n(c) log n(c) is computed with the
    word taken out of its class, and the counts follow each move, so words do
    not all crowd into the same class. Ties stay or go to the lower class; a
    word of no class yet (``OTHER``) always joins one.
    """
    counts, now = bigrams.astype(float), now.copy()
    own = left.sum(axis=1)
    for w in np.argsort(-own, kind="stable"):
        before, after, n, home = left[w].astype(float), right[w].astype(float), float(own[w]), now[w]
        counts[:, home] = np.maximum(counts[:, home] - before, 0)
        counts[home, :] = np.maximum(counts[home, :] - after, 0)
        sizes = counts.sum(axis=0)[:CLASSES]
        columns, lines = counts[:, :CLASSES].T, counts[:CLASSES, :]
        gain = (_xlogx(columns + before) - _xlogx(columns)).sum(axis=1) + (_xlogx(lines + after) - _xlogx(lines)).sum(axis=1)
        gain -= 2 * (_xlogx(sizes + n) - _xlogx(sizes))
        best = int(gain.argmax())
        if home < CLASSES and gain[home] >= gain[best] - 1e-9:
            best = home
        counts[:, best] += before
        counts[best, :] += after
        now[w] = best
    return now


def likelihood(bigrams: np.ndarray) -> float:
    """The part of the training text's log probability that depends on the classes."""
    counts = bigrams.astype(float)
    return float(_xlogx(counts).sum() - _xlogx(counts.sum(axis=0)).sum() - _xlogx(counts.sum(axis=1)).sum())


def _movers(classes: np.ndarray, bigrams: np.ndarray):
    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        words, at = np.unique(rows["word"].to_numpy(), return_inverse=True)
        counts = np.zeros((len(words), 2 * ALL))
        counts[at, rows["context"].to_numpy()] = rows["n"].to_numpy()
        moved = best_classes(counts[:, :ALL], counts[:, ALL:], classes[words], bigrams)
        return pd.DataFrame({"word": words, "class": moved})

    return decide


def exchange(chunks: DataFrame, words: np.ndarray, rank: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(classes, class bigrams); ``words`` is sorted, ``rank`` their order by falling frequency.

    A round of exchange that lowers the likelihood is taken back.
    """
    classes = np.where(rank < CLASSES, rank, OTHER)
    low, steps = CLASSES, []
    while low < len(words):
        steps.append((rank >= low) & (rank < low * BAND))
        low *= BAND
    joining = len(steps)
    steps += [rank % 2 == k % 2 for k in range(rounds if len(words) else 0)]
    best, kept = -np.inf, classes
    for number, active in enumerate([*steps, np.zeros(len(words), bool)]):
        rows, bigrams = _counted(chunks, words, classes, active)
        if number >= joining:
            if likelihood(bigrams) < best:
                classes = kept
                release(rows)
                rows, bigrams = _counted(chunks, words, classes, active)
            best, kept = likelihood(bigrams), classes
        if active.any():
            buckets = max(1, int(active.sum()) // BUCKET)
            moved = rows.where("word >= 0").withColumn("bucket", F.pmod("word", F.lit(buckets))).groupBy("bucket").applyInPandas(_movers(classes, bigrams), "word int, class int").toPandas()
            classes = classes.copy()
            classes[moved["word"].to_numpy()] = moved["class"].to_numpy()
        release(rows)
    return classes, bigrams


def _tail_contexts(words: np.ndarray, classes: np.ndarray):
    """Rows (word, context, n) of the training texts for the words outside the core, one chunk at a time."""

    def count(batches):
        for batch in batches:
            for c in _each(batch):
                at, cls = _classes_of(c["lexicon"], words, classes)
                first, tokens = c["first"], c["tokens"]
                line = _sequence(cls[tokens], first, END)
                place = _sequence(np.where(at < 0, np.arange(len(at)), -1)[tokens], first, -1)
                use = np.repeat(~c["held"], np.diff(first) + 1) & (place >= 0)
                before = np.concatenate([[END], line[:-1]])[use]
                after = np.concatenate([line[1:], [END]])[use]
                spot = place[use] * (2 * ALL)
                full, n = np.unique(np.concatenate([spot + before, spot + ALL + after]), return_counts=True)
                for start in range(0, len(full), 1 << 18):
                    part = full[start : start + (1 << 18)]
                    columns = [pa.array(c["lexicon"][part // (2 * ALL)]), pa.array((part % (2 * ALL)).astype(np.int32)), pa.array(n[start : start + (1 << 18)])]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "context", "n"])

    return count


def join_classes(left: np.ndarray, right: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The class of largest likelihood for words of none yet, the most frequent first.

    As ``best_classes``, but the counts follow after every ``SLICE`` words.
    """
    counts, out = bigrams.astype(float), np.empty(len(left), np.int64)
    own = left.sum(axis=1)
    order = np.argsort(-own, kind="stable")
    for start in range(0, len(order), SLICE):
        w = order[start : start + SLICE]
        before, after, n = left[w], right[w], own[w, None]
        counts[:, OTHER] = np.maximum(counts[:, OTHER] - before.sum(axis=0), 0)
        counts[OTHER, :] = np.maximum(counts[OTHER, :] - after.sum(axis=0), 0)
        sizes, columns, lines = counts.sum(axis=0)[:CLASSES], counts[:, :CLASSES].T, counts[:CLASSES, :]
        gain = (_xlogx(columns + before[:, None]) - _xlogx(columns)).sum(axis=2) + (_xlogx(lines + after[:, None]) - _xlogx(lines)).sum(axis=2)
        gain -= 2 * (_xlogx(sizes + n) - _xlogx(sizes))
        out[w] = gain.argmax(axis=1)
        np.add.at(counts.T, out[w], before)
        np.add.at(counts, out[w], after)
    return out


def _joiners(bigrams: np.ndarray):
    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        words, at = np.unique(rows["word"].to_numpy(), return_inverse=True)
        counts = np.zeros((len(words), 2 * ALL))
        counts[at, rows["context"].to_numpy()] = rows["n"].to_numpy()
        often = counts[:, :ALL].sum(axis=1) >= MIN_COUNT
        words, counts = words[often], counts[often]
        return pd.DataFrame({"word": words, "class": join_classes(counts[:, :ALL], counts[:, ALL:], bigrams)})

    return decide


def tail_classes(chunks: DataFrame, words: np.ndarray, classes: np.ndarray, bigrams: np.ndarray, kinds: int) -> DataFrame:
    """(word, class) of the words outside the core that occur ``MIN_COUNT`` times or more.

    Rows are dealt by bucket once; a bucket holds about ``BUCKET`` of the
    ``kinds`` words, and a word at most two counts per class, so its size is bounded.
    """
    rows = chunks.select("first", "held", "tokens", "lexicon").mapInArrow(_tail_contexts(words, classes), "word long, context int, n long")
    buckets = max(1, kinds // BUCKET)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets))).repartition("bucket")
    rows = rows.groupBy("bucket", "word", "context").agg(F.sum("n").alias("n"))
    return cut_lineage(rows.groupBy("bucket").applyInPandas(_joiners(bigrams), "word long, class int"), "tail")


def _bigrams(batches):
    """Rows (context, n): class bigrams of the training texts, by the pair of classes."""
    pairs = np.zeros(ALL * ALL, np.int64)
    for batch in batches:
        for c in _each(batch):
            line = _sequence(_spread(c, c["spots"] & MASK, OTHER)[c["tokens"]], c["first"], END)
            train = np.repeat(~c["held"], np.diff(c["first"]) + 1)
            pairs += np.bincount((np.concatenate([[END], line[:-1]]) * ALL + line)[train], minlength=len(pairs))
    full = np.flatnonzero(pairs)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(pairs[full])], ["context", "n"])


def _spread(chunk: dict, given: np.ndarray, missing: int) -> np.ndarray:
    """Values given for the places of ``spots``, for the whole lexicon of a chunk."""
    values = np.full(chunk["kinds"], missing, np.int64)
    values[chunk["spots"] >> PLACE] = given
    return values


SCORES = ("n_tokens", "n_known", "base_score", "score")


def _scorer(sizes, transition, other_log, end_log, base_log):
    """Scores of every text of a chunk; ``spots`` hold places of its lexicon with their classes, ``known`` their counts."""

    def score(batches):
        for batch in batches:
            for c in _each(batch):
                first, lengths, tokens = c["first"], np.diff(c["first"]), c["tokens"]
                known, cls = _spread(c, c["known"], 0), _spread(c, c["spots"] & MASK, OTHER)
                emit = np.log10(np.maximum(known, 1)) - np.log10(sizes)[np.minimum(cls, CLASSES - 1)]
                emit = np.where(cls < CLASSES, emit, np.log10(known + 1.0) - other_log)
                line = _sequence(cls[tokens], first, END)
                before = np.concatenate([[END], line[:-1]])
                logs = transition[before, line] + _sequence(emit[tokens], first, 0.0)
                base = _sequence((np.log10(known + 1.0) - base_log)[tokens], first, end_log)
                seen = _sequence((known > 0)[tokens], first, end_log > -base_log)
                starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
                columns = [
                    c["ids"].values, pa.array(c["held"]), pa.array(lengths + 1), pa.array(np.add.reduceat(seen.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(logs, starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", *SCORES])

    return score


def learn(chunks: DataFrame, lexicon: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, int]:
    """((word, n, class) of every training word, training texts).

    ``word`` is the word's hash; ``class`` is ``OTHER`` for words that occur
    once. Words of equal frequency are taken in the order of their hashes.
    """
    vocabulary = cut_lineage(lexicon.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    training = chunks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    running = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    core = F.col("n") >= max(MIN_COUNT, MIN_SHARE * (running + training))
    frequent = vocabulary.where(core).toPandas()
    frequent = frequent.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    frequent["rank"] = np.arange(len(frequent))
    frequent = frequent.sort_values("word", ignore_index=True)
    words = frequent["word"].to_numpy(np.int64)
    classes, bigrams = exchange(chunks, words, frequent["rank"].to_numpy(np.int64), rounds)
    tail = tail_classes(chunks, words, classes, bigrams, vocabulary.where(~core & (F.col("n") >= MIN_COUNT)).count())
    chosen = chunks.sparkSession.createDataFrame(pa.table({"word": words, "class": classes.astype(np.int32)})).unionByName(tail)
    known = vocabulary.join(chosen, "word", "left").select("word", "n", F.coalesce("class", F.lit(OTHER)).alias("class"))
    return cut_lineage(known, "classes"), training


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Learns from the rows that are not held out; a null there counts as not.
    Words are lower-cased in A-Z; each text ends with a token of its own. Null
    and empty texts are that token alone. base_score is the add-one unigram
    score, score the model's log10 probability. Without training rows every
    count is 0 and the scores follow from smoothing alone. Repeated rows count
    as often as they occur.
    """
    chunks = encode(docs, doc_id, text, held_out)
    lexicon = chunks.select("chunk", F.posexplode(F.arrays_zip("lexicon", "counts")).alias("at", "w"))
    lexicon = lexicon.select("chunk", "at", F.col("w.lexicon").alias("word"), F.col("w.counts").alias("n"))
    known, training = learn(chunks, lexicon, rounds)
    found = {r["class"]: (r["n"], r["kinds"]) for r in known.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()}
    total = sum(n for n, _ in found.values()) + training
    kinds = sum(k for _, k in found.values()) + (training > 0)

    matched = lexicon.select("chunk", "at", "word").join(known, "word")
    # one aggregate gathers both lists row by row, so their places agree
    matched = matched.groupBy("chunk").agg(F.collect_list(F.shiftleft(F.col("at").cast("long"), PLACE) + F.col("class")).alias("spots"), F.collect_list("n").alias("known"))
    full = chunks.select("chunk", "ids", "held", "first", "tokens", F.size("lexicon").alias("kinds")).join(matched, "chunk", "left")
    part = lambda name: F.coalesce(name, F.array().cast("array<long>")).alias(name)
    full = cut_lineage(full.select("ids", "held", "first", "tokens", "kinds", part("spots"), part("known")), "classed", "zstd")
    bigrams = np.zeros(ALL * ALL)
    for r in full.drop("ids", "known").mapInArrow(_bigrams, "context int, n long").groupBy("context").agg(F.sum("n").alias("n")).collect():
        bigrams[r.context] = r.n
    bigrams = bigrams.reshape(ALL, ALL)

    transition = np.log10((bigrams + 1.0) / (bigrams.sum(axis=1, keepdims=True) + ALL))
    sizes = np.array([max(1, found.get(k, (0, 0))[0]) for k in range(CLASSES)], float)
    others, other_kinds = found.get(OTHER, (0, 0))
    other_log, base_log = float(np.log10(others + other_kinds + 1.0)), float(np.log10(total + kinds + 1.0))
    end_log = float(np.log10(training + 1.0)) - base_log
    id_type = chunks.schema["ids"].dataType.elementType
    out = T.StructType([T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    scored = full.mapInArrow(_scorer(sizes, transition, other_log, end_log, base_log), out)
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
