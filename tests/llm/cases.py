"""Small tables that hold what operators must bear."""

import random

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names used inside the operators.
EXTRA = ("uid", "row", "node", "region", "kept", "label", "piece", "at", "number", "id", "held", "found")


#: Invented words without digits.
WORDS = [a + b + c for a in ("", "ka", "lo", "mi", "ne", "pu", "ra", "so") for b in ("ba", "de", "fi", "gu", "ha", "jo", "ke", "li", "mo", "nu") for c in ("n", "r", "st", "t", "lk", "sh", "m", "x", "ng", "p")] * 7


def prose(rng: random.Random, words: int, vocabulary: int = 800) -> str:
    return " ".join(WORDS[rng.randrange(vocabulary)] for _ in range(words))


def spoiled(rng: random.Random, text: str, share: float) -> str:
    return " ".join(f"x{rng.randrange(9999)}" if rng.random() < share else w for w in text.split(" "))


def corpus(seed: int = 5) -> list[tuple]:
    """Documents with exact and near copies, shared lines, short and odd texts, repeated rows and nulls."""
    rng = random.Random(seed)
    furniture = "this line stands on every page of the site 2024"
    out = []
    for i in range(60):
        lines = [prose(rng, rng.randrange(8, 40)) for _ in range(rng.randrange(2, 6))]
        if i % 2:
            lines.insert(rng.randrange(len(lines)), furniture)
        out.append((i, "\n".join(lines), "en", f"src{i % 3}", None))
    base = [r[1] for r in out]
    for k in range(20):
        out.append((100 + k, spoiled(rng, base[k % 5].replace("\n", " \n "), rng.choice((0.0, 0.01, 0.03, 0.2))), "en", "src0", 1))
    out += [(200 + k, base[7], "de", "src1", 5) for k in range(6)]
    out += [(300, None, None, None, None), (301, "", "", "", 0), (302, " \t\n ", None, "src0", 3), (303, "one", "en", None, 3), (304, "one two three", "en", "src0", 1), (305, "one two three", "en", "src0", 1)]
    out += [(306, "é" * 3000 + " ü ß\n" + "word " * 4000, "fr", "src2", 1), (None, base[3], "en", "src1", 2), (None, None, None, None, None), (7, base[7], "en", "src1", None), (7, base[7], "en", "src1", None)]
    return out


def documents(spark, rows=None, extra: bool = False):
    df = spark.createDataFrame(corpus() if rows is None else rows, DOCS)
    if extra:
        for name in EXTRA:
            df = df.withColumn(name, df["lang"])
    return df


def empty(spark, schema: str = DOCS):
    return spark.createDataFrame([], T._parse_datatype_string(schema))


def words(text) -> list[bytes]:
    return (text or "").encode().split()


def lower_words(text) -> list[bytes]:
    return (text or "").encode().lower().split()


def groups(count: int, links) -> list[int]:
    """The smallest member of each one's component, by search over the links."""
    beside = [[] for _ in range(count)]
    for a, b in links:
        beside[a].append(b)
        beside[b].append(a)
    low = [None] * count
    for start in range(count):
        if low[start] is None:
            todo, low[start] = [start], start
            while todo:
                for other in beside[todo.pop()]:
                    if low[other] is None:
                        low[other] = start
                        todo.append(other)
    return low
