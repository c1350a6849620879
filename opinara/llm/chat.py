"""Conversations as training texts with budgeted windows (operator 10).

A turn is written as ``<|turn|>role`` newline ``text<|end|>`` newline, with control strings
inside roles and texts escaped reversibly. Prefix sums of the turns' tokens cut a long
conversation into windows of whole turns. A later window repeats the system turn and a
limited history; what is repeated is never under the loss mask again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from opinara.llm.mixing import word_count
from opinara.session import cut_lineage

TURN, END = "<|turn|>", "<|end|>\n"
TURN_PATTERN = r"<\|turn\|>"
#: Control strings of common templates: a backslash goes behind their first character.
CONTROL = r"(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])"
#: Tokens a turn counts besides its words: its marks and its role.
MARKS = 4
#: Turn numbers whose running sums are made together; a very long conversation has many.
GRAIN = 1024


def escape(text: Column) -> Column:
    """Without control strings; ``unescape`` gives the text back."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _numbered(turns: DataFrame) -> DataFrame:
    """With ``pos`` (1, 2, ... in a conversation) and ``before`` (tokens of the turns before).

    Sums run inside blocks of turn numbers; the blocks' totals are added.
    """
    order = Window.partitionBy("key", "block").orderBy("turn", "role", "text")
    inside = turns.withColumn("block", F.floor(F.col("turn") / GRAIN)).withColumn(
        "block", F.coalesce("block", F.lit(-2**62))).withColumns({
            "n": F.row_number().over(order),
            "sum": F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    along = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = inside.groupBy("key", "block").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("all")).select(
        "key", "block", F.coalesce(F.sum("rows").over(along), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("all").over(along), F.lit(0)).alias("all"))
    return inside.join(blocks, ["key", "block"]).select(
        "key", "conv_id", "role", "text", "tokens", (F.col("n") + F.col("rows")).alias("pos"),
        (F.col("sum") - F.col("tokens") + F.col("all")).alias("before"))


def format_conversations(rows: DataFrame, budget: int = 512, history: int = 2,
                         history_budget: int = 128, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per window: ``conv_id, window, text, n_tokens, n_context, loss_spans``.

    The first ``n_context`` turns of a window are repeated from earlier ones: the
    conversation's first system turn, then up to ``history`` turns before the window of
    together at most ``history_budget`` tokens. ``loss_spans`` are the places (first code
    point from 1, length) of the texts of the assistant's own turns. A window keeps to
    ``budget`` tokens (words plus four per turn) unless one turn or the system turn alone is
    longer: turns are never cut.

    Turns are ordered by number, then role, then text, so repeated rows are turns of their
    own. Null text or role counts as empty, a null turn number comes first, a null
    conversation id is one conversation. Other columns are ignored whatever their names. No
    rows, no windows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = rows.select(
        F.coalesce(F.concat(F.lit("c"), F.col(conv_col).cast("string")), F.lit("n")).alias("key"),
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("text"),
        (word_count(text) + MARKS).alias("tokens"))
    placed = _numbered(turns)
    system = placed.filter("role = 'system'").groupBy("key").agg(F.min("pos").alias("sys_pos"),
                                                                 F.min_by("tokens", "pos").alias("sys_tokens"))
    room = F.greatest(F.lit(budget - history_budget) - F.coalesce("sys_tokens", F.lit(0)), F.lit(1))
    # a window holds the turns that end in one stretch of the running sum; a turn that began
    # in the stretch before would make it too long and is a window of its own
    stretch = F.floor((F.col("before") + F.col("tokens") - 1) / F.col("room"))
    straddles = F.col("before") < stretch * F.col("room")
    own = cut_lineage(placed.join(system, "key", "left").withColumn("room", room).withColumn(
        "window", stretch * 2 + F.when(straddles, 0).otherwise(1)).withColumn("rank", F.lit(2)))
    starts = own.groupBy("key", "window").agg(F.min("pos").alias("first"), F.min("before").alias("begins"))
    repeated = own.drop("window", "rank")
    back = repeated.withColumn("first", F.explode(F.sequence(F.col("pos") + 1, F.col("pos") + history))) if history else None
    parts = [own.select("key", "conv_id", "window", "rank", "pos", "role", "text", "tokens")]
    if back is not None:
        parts.append(back.join(starts, ["key", "first"]).filter(
            (F.col("begins") - F.col("before") <= history_budget)
            & ~F.coalesce(F.col("pos") == F.col("sys_pos"), F.lit(False))).select(
            "key", "conv_id", "window", F.lit(1).alias("rank"), "pos", "role", "text", "tokens"))
    lead = repeated.filter("pos = sys_pos")
    parts.append(lead.join(starts.filter("first > 1"), "key").filter(F.col("first") > F.col("pos")).select(
        "key", "conv_id", "window", F.lit(0).alias("rank"), "pos", "role", "text", "tokens"))
    uses = parts[0]
    for part in parts[1:]:
        uses = uses.unionByName(part)

    # a window's turns are bounded by the budget: each counts four tokens at least
    grouped = uses.groupBy("key", "window").agg(
        F.first("conv_id").alias("conv_id"), F.sum("tokens").alias("n_tokens"),
        F.sum((F.col("rank") < 2).cast("int")).alias("n_context"),
        F.array_sort(F.collect_list(F.struct(
            "rank", "pos", (F.col("rank").eqNullSafe(2) & (F.col("role") == "assistant")).alias("loss"),
            F.concat(F.lit(TURN), escape(F.col("role")), F.lit("\n")).alias("head"),
            escape(F.col("text")).alias("body")))).alias("t"))

    def add(done: Column, t: Column) -> Column:
        start = done["at"] + F.char_length(t["head"])
        span = F.struct(start.alias("start"), F.char_length(t["body"]).alias("length"))
        return F.struct(
            (start + F.char_length(t["body"]) + len(END)).alias("at"),
            F.when(t["loss"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,length:int>>")
    folded = F.aggregate("t", F.struct(F.lit(1).alias("at"), none.alias("spans")), add, lambda d: d["spans"])
    return grouped.select(
        "conv_id", "window",
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        "n_tokens", "n_context", folded.alias("loss_spans"))


def parse_windows(windows: DataFrame) -> DataFrame:
    """Read back: ``conv_id, window, turns`` (role and text, in order, none twice), ``loss``.

    ``loss`` is the unescaped text under the window's loss mask.
    """
    segments = F.slice(F.split("text", TURN_PATTERN), F.lit(2) + F.col("n_context"), F.size(F.split("text", TURN_PATTERN)))

    def turn(segment: Column) -> Column:
        role = F.substring_index(segment, "\n", 1)
        body = F.substring(segment, F.char_length(role) + 2,
                           F.char_length(segment) - F.char_length(role) - 1 - len(END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("text"), s["start"], s["length"]))), "")
    return windows.select("conv_id", "window", F.transform(segments, turn).alias("turns"), loss.alias("loss"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from its formatted windows: turns and loss text with their digests."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parsed = parse_windows(windows).select("conv_id", "window", F.size("turns").alias("n"), said.alias("said"), "loss")
    chars = windows.groupBy("conv_id").agg(F.sum(F.char_length("text")).alias("formatted_chars"))
    whole = parsed.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("w"))
    join = lambda name: F.array_join(F.transform("w", lambda w: w[name]), "")
    out = whole.select(F.col("conv_id"), "n_turns", F.sha2(join("said"), 256).alias("turns_sha256"),
                       F.char_length(join("loss")).cast("bigint").alias("loss_chars"),
                       F.sha2(join("loss"), 256).alias("loss_sha256"))
    return out.join(chars.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
