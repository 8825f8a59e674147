"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is `<|im_start|>role`, a line break, its text, `<|im_end|>` and a line break. Inside texts and roles, `<|` becomes
`<\\|`, and `<\\|` one more backslash, so no text can hold a control string and the step can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import Scratch

START, END = "<|im_start|>", "<|im_end|>"
#: What a turn's control strings count for, in tokens.
TURN_TOKENS = 4
#: Turn numbers per block of the prefix sums; bounds what one task sorts of a long conversation.
TURNS = 256


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role stands on one line: `%` and the line break are written as %25 and %0A."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _positioned(turns: DataFrame) -> DataFrame:
    """The turns with at, the sum of tokens of a conversation's earlier turns, and large_before, the number of large turns up to each.

    Summed inside blocks of turn numbers and then over the blocks, so a long conversation is not one task's work.
    """
    large = F.col("large").cast("long")
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    summed = turns.withColumn("upto", F.sum("tokens").over(inside)).withColumn("large_upto", F.sum(large).over(inside))
    blocks = turns.groupBy("conv_id", "block").agg(F.sum("tokens").alias("all"), F.sum(large).alias("all_large"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = [F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"base_{name}") for name in ("all", "all_large")]
    blocks = blocks.select(F.col("conv_id").alias("_conv_id"), F.col("block").alias("_block"), *base)
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("block").eqNullSafe(F.col("_block"))
    at = F.col("base_all") + F.col("upto") - F.col("tokens")
    placed = summed.join(blocks, same).withColumns({"at": at, "large_before": F.col("base_all_large") + F.col("large_upto")})
    return placed.select("conv_id", "at", "tokens", "role", "text", "large", "large_before", "cell")


def format_chat(conversations: DataFrame, budget: int = 2048, history: int = 2, history_tokens: int = 512) -> DataFrame:
    """Conversations as windows of formatted text with the spans that count for the loss.

    Returns one row per window: conv_id, window (the tokens of its conversation before it), n_turns, n_repeated (leading turns
    that repeat earlier ones), formatted, and loss, an array of (start, end) in code points of `formatted` that
    covers the escaped texts of the assistant turns that are not repeated. Read are conv_id, turn, role and text; null roles and
    texts count as empty, a null turn comes first, ties go by role and text, and rows without a conv_id make one
    conversation. Repeated rows are turns of their own. Blank texts are turns too. An empty table gives no window.

    Tokens are words plus four for a turn's marks. What the budget leaves beside the system turn and the history is a window's
    room. A turn of over a quarter of it is a window by itself. The others belong to the window in which they end when the tokens between
    two such turns are cut every three quarters of the room, so windows hold whole turns, follow from prefix sums alone and
    keep to the room. A window begins with the conversation's first system turn, if that lies before, and the last `history` turns
    before it, as far as they fit into history_tokens and the budget. A window exceeds the budget only if a single turn and the
    system turn do.
    """
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.floor(F.col("turn") / TURNS).alias("block"),
        escaped_role(F.coalesce(F.col("role").cast("string"), F.lit(""))).alias("role"),
        escaped(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
    ).withColumn("tokens", (words + TURN_TOKENS).cast("long"))
    # The first system turn in the order of the turns: a null turn comes first.
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role", "text")
    sizes = turns.where("role = 'system'").groupBy("conv_id").agg(F.min_by("tokens", place).alias("system_tokens"))
    sizes = sizes.select(F.col("conv_id").alias("_of"), "system_tokens")
    turns = turns.join(sizes, F.col("conv_id").eqNullSafe(F.col("_of")), "left").drop("_of")
    room = F.greatest(budget - history_tokens - F.coalesce("system_tokens", F.lit(0)), F.lit(1).cast("long"))
    quarter = F.floor(room / 4)
    turns = turns.withColumns({"large": F.col("tokens") > quarter, "cell": room - quarter})
    placed = _positioned(turns)
    cell = F.when(~F.col("large"), F.floor((F.col("at") + F.col("tokens") - 1) / F.col("cell")))
    turn = F.struct("at", "tokens", "role", "text")
    windows = placed.groupBy("conv_id", "large_before", "large", cell.alias("cell")).agg(
        F.array_sort(F.collect_list(turn)).alias("own"), F.min("at").alias("window"), F.sum("tokens").alias("own_tokens")
    ).select("conv_id", "window", "own", "own_tokens")
    # Each text is moved twice up to here and not again for every use of the windows below.
    windows = Scratch(conversations.sparkSession, "chat").write(windows, "windows")

    order = Window.partitionBy("conv_id").orderBy("window")
    numbers = windows.select("conv_id", "window").withColumn("next", F.lead("window").over(order))
    numbers = numbers.where("next IS NOT NULL").select(F.col("conv_id").alias("_c"), F.col("window").alias("_w"), "next")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("window") == F.col("_w"))
    tail = F.slice("own", F.greatest(F.size("own") - history + 1, F.lit(1)), history) if history else F.slice("own", 1, 0)
    passed_on = windows.select("conv_id", "window", tail.alias("tail")).join(numbers, same)
    passed_on = passed_on.select(F.col("conv_id").alias("_c"), F.col("next").alias("_w"), "tail")

    system = windows.select("conv_id", F.explode(F.filter("own", lambda t: t["role"] == "system")).alias("t"))
    system = system.groupBy("conv_id").agg(F.min_by("t", F.col("t.at")).alias("system"))
    system = system.select(F.col("conv_id").alias("_s"), "system")
    rows = windows.join(passed_on, same, "left").join(system, F.col("conv_id").eqNullSafe(F.col("_s")), "left")
    left = budget - F.coalesce(F.col("system")["tokens"], F.lit(0)) - F.col("own_tokens")
    rows = rows.withColumn("allowed", F.least(F.lit(history_tokens).cast("long"), left))
    before = F.coalesce(F.filter("tail", lambda t: F.col("window") - t["at"] <= F.col("allowed")), F.slice("own", 1, 0))
    rows = rows.select("conv_id", "window", "own", "system", before.alias("before"))
    first = F.coalesce(F.try_element_at("before", F.lit(1))["at"], F.col("window"))
    kept = F.when(F.col("system")["at"] < first, F.array("system")).otherwise(F.slice("own", 1, 0))
    rows = rows.withColumn("repeated", F.concat(kept, "before"))
    rows = rows.select("conv_id", "window", F.size("repeated").alias("n_repeated"), F.concat("repeated", "own").alias("turns"))

    marked = F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n")))
    spans = F.aggregate(
        F.transform("turns", lambda t, k: F.struct((k >= F.col("n_repeated")).alias("own"), t["role"].alias("role"), F.length(t["text"]).alias("size"))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss")),
        _with_turn,
        lambda state: state["loss"],
    )
    return rows.select(
        "conv_id", "window", F.size("turns").alias("n_turns"), "n_repeated", F.array_join(marked, "").alias("formatted"), spans.alias("loss")
    )


def _with_turn(state: Column, turn: Column) -> Column:
    start = state["at"] + len(START) + F.length(turn["role"]) + 1
    end = start + turn["size"]
    counts = turn["own"] & (turn["role"] == "assistant")
    span = F.struct(start.alias("start"), end.alias("end"))
    loss = F.when(counts, F.concat(state["loss"], F.array(span))).otherwise(state["loss"])
    return F.struct((end + len(END) + 1).alias("at"), loss.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from formatted windows alone: its turns and the text under the loss mask.

    Returns conv_id, n_turns, turns (role, line break, text and line break of each turn, repeated turns left out),
    loss_text and formatted_chars.
    """
    parts = F.slice(F.split("formatted", r"<\|im_start\|>"), F.col("n_repeated") + 2, F.col("n_turns"))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - 2 - len(END))
        return F.concat(unescaped_role(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    masked = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    read = windows.select(
        "conv_id",
        "window",
        (F.col("n_turns") - F.col("n_repeated")).alias("n"),
        F.array_join(F.transform(parts, turn), "").alias("turns"),
        F.array_join(masked, "").alias("loss_text"),
        F.length("formatted").alias("chars"),
    )
    joined = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss_text"))).alias("all"),
        F.sum("chars").alias("formatted_chars"),
    )
    return joined.select(
        "conv_id",
        "n_turns",
        F.array_join("all.turns", "").alias("turns"),
        F.array_join("all.loss_text", "").alias("loss_text"),
        "formatted_chars",
    )
