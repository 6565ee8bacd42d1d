"""Chat formatting with DataFrame functions: turns to marked text with a loss mask, and back.

Turns are numbered in one global order and cut into parts of a bounded number of
turns, so a conversation of any length is formatted by many tasks. In a part the
collected turn structs are sorted, adjacent turns of a role are merged into runs
by an array aggregation, and the runs are concatenated. The texts of a
conversation's parts, in order, are its formatted text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharding import global_numbers

OPEN, BODY, NEXT, CLOSE = "<|start|>", "<|message|>", "<|next|>", "<|end|>"
#: Strings that tokenizers may read as control tokens; none of them is left inside a text.
CONTROLS = (
    OPEN, BODY, NEXT, CLOSE, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>",
    "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]",
)
#: Turns of the global order that one part may hold.
PART = 64
LOSS_ROLES = ("assistant",)


def _rests(first: str) -> str:
    return "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first)


_FIRSTS = sorted({c[0] for c in CONTROLS})
#: The first character of a control string, or of one that was escaped before; a backslash goes behind it.
ESCAPE = "|".join(rf"{re.escape(f)}(?=\\*(?:{_rests(f)}))" for f in _FIRSTS)
UNESCAPE = "|".join(rf"(?<={re.escape(f)})\\(?=\\*(?:{_rests(f)}))" for f in _FIRSTS)


def escape(text: Column) -> Column:
    """``text`` without any control string; ``unescape`` gives it back, whatever it held."""
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit("$0\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit(""))


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(BODY))


def merge_runs(turns: Column) -> Column:
    """array<struct<role, texts>>: adjacent turns of the same role as one run."""
    first = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def add(runs: Column, turn: Column) -> Column:
        last = F.get(runs, F.size(runs) - 1)
        longer = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        begun = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        same = (F.size(runs) > 0) & (last["role"] == turn["role"])
        return F.when(same, F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(begun)))

    return F.aggregate(turns, first, add)


def format_parts(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, role, n_turns, formatted, loss): the conversations in parts of at most ``PART`` turns.

    - Turns of a conversation are ordered by turn, then role, then text, nulls
      first; repeated rows are turns of their own. A null ``conv_id`` is a
      conversation of its own. Null role and text count as empty.
    - ``formatted``: a run of turns of one role is a header with the role, the
      texts with a mark between them, and an end. Control strings inside texts
      and roles are broken by a backslash that ``unescape`` takes out again.
    - ``role``: the role of the run that is open where the part begins, null in
      the first part. A part that goes on with it begins with the mark
      between texts, any other with the end of the run before.
    - ``loss``: array of (start, length) in code points of ``formatted``, one
      for each text of a role in ``LOSS_ROLES``.
    - No rows give no rows. Other columns of ``turns`` are not looked at.
    """
    named = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    numbered, _ = global_numbers(named, [F.col(c) for c in ("conv_id", "turn", "role", "text")], "turns")
    rows = numbered.select("row.conv_id", F.floor(F.col("number") / PART).alias("part"), "number", "row.role", "row.text")

    edges = rows.groupBy("conv_id", "part").agg(F.max_by("role", "number").alias("open"))
    here = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("number", "role", "text"))).alias("turns"))
    before = edges.select(F.col("conv_id").alias("c"), (F.col("part") + 1).alias("p"), "open")
    after = edges.select(F.col("conv_id").alias("d"), (F.col("part") - 1).alias("q"), F.lit(True).alias("goes_on"))
    joined = here.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left").join(after, F.col("conv_id").eqNullSafe(F.col("d")) & (F.col("part") == F.col("q")), "left")
    runs = joined.select("conv_id", "part", F.col("open").alias("role"), F.size("turns").cast("long").alias("n_turns"), "goes_on", merge_runs(F.col("turns")).alias("runs"))

    def start(run: Column, i: Column) -> Column:
        continues = (i == 0) & F.col("role").eqNullSafe(run["role"])
        return F.when((i == 0) & F.col("role").isNull(), _header(run["role"])).when(continues, F.lit(NEXT)).otherwise(F.concat(F.lit(CLOSE), _header(run["role"])))

    def pieces(run: Column, i: Column) -> Column:
        piece = lambda text, j: F.struct(F.when(j == 0, start(run, i)).otherwise(NEXT).alias("mark"), escape(text).alias("text"), run["role"].isin(*LOSS_ROLES).alias("loss"))
        return F.transform(run["texts"], piece)

    cut = runs.select("conv_id", "part", "role", "n_turns", "goes_on", F.flatten(F.transform("runs", pieces)).alias("pieces"))
    marked = F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["text"])), "")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(done: Column, piece: Column) -> Column:
        begin, size = done["at"] + F.length(piece["mark"]), F.length(piece["text"]).cast("long")
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size).alias("at"), F.when(piece["loss"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    formatted = F.concat(marked, F.when(F.col("goes_on"), "").otherwise(CLOSE))
    return cut.select("conv_id", "part", "role", "n_turns", formatted.alias("formatted"), F.aggregate("pieces", zero, step, lambda done: done["spans"]).alias("loss"))


def read_parts(parts: DataFrame) -> DataFrame:
    """(conv_id, part, turns, learnt, n_chars) read from ``formatted``, ``loss`` and ``role`` alone.

    ``turns``: the original turns (role, text); ``learnt``: the texts under the
    loss mask, joined.
    """
    literal = lambda mark: re.escape(mark)
    whole = F.concat(F.when(F.col("role").isNull(), "").otherwise(_header(F.col("role"))), "formatted")
    runs = F.filter(F.split(whole, literal(CLOSE)), lambda r: r.startswith(OPEN))

    def said(run: Column) -> Column:
        role = unescape(F.substring_index(F.substring(run, len(OPEN) + 1, 2147483647), BODY, 1))
        return F.transform(F.split(F.substring_index(run, BODY, -1), literal(NEXT)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    turns = F.flatten(F.transform(runs, said))
    cut = F.when(F.col("role").isNull(), turns).otherwise(F.slice(turns, F.lit(2), F.size(turns)))
    learnt = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return parts.select("conv_id", "part", cut.alias("turns"), F.array_join(learnt, "").alias("learnt"), F.length("formatted").cast("long").alias("n_chars"))


def whole_conversations(parts: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): one row per conversation, for those that fit a value (2 GB)."""
    sized = parts.select("conv_id", F.struct("part", "formatted", "loss", F.length("formatted").cast("long").alias("size")).alias("p"))
    held = sized.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("parts"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    moved = lambda done, p: F.transform(p["loss"], lambda s: F.struct((s["start"] + done["at"]).alias("start"), s["length"].alias("length")))
    spans = F.aggregate("parts", zero, lambda done, p: F.struct((done["at"] + p["size"]).alias("at"), F.concat(done["spans"], moved(done, p)).alias("spans")), lambda done: done["spans"])
    return held.select("conv_id", F.array_join("parts.formatted", "").alias("formatted"), spans.alias("loss"))


def digests(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the parts.

    A digest runs over a whole conversation, so its turns meet in one value.
    """
    back = read_parts(parts)
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    narrow = back.select("conv_id", F.size("turns").cast("long").alias("n"), "n_chars", F.struct("part", spoken.alias("spoken"), "learnt").alias("p"))
    held = narrow.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"), F.sort_array(F.collect_list("p")).alias("parts"))
    both = held.select("conv_id", "n_turns", "formatted_chars", *[F.array_join(f"parts.{c}", "").alias(c) for c in ("spoken", "learnt")])
    return both.select("conv_id", "n_turns", F.sha2("spoken", 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars")
