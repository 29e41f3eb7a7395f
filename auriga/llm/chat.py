"""Chat formatting: conversations cut into budgeted windows of whole turns, with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.llm.common import count_words, text_of

# A turn is <turn ROLE>TEXT</turn> and a line end. Inside roles and texts these characters are written as
# a backslash and a letter, so no text holds a marker and plain replacement restores it.
BACKSLASH, OPEN, CLOSE = "\\", "<", ">"
ESCAPES = ((BACKSLASH, "\\b"), (OPEN, "\\l"), (CLOSE, "\\g"))
END = "</turn>\n"
TURN_TOKENS = 4
BUDGET, HISTORY = 1024, 128


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, formatted, repeated, tokens, mask (array of start and end).

    Tokens are words plus TURN_TOKENS per turn. Prefix sums of a conversation's turn tokens lay its turns
    on a line cut into cells of half the span budget (the budget less the history and the system turn). A turn
    belongs to the cell it starts in, unless it crosses the cell's end and is longer than a cell: then it is
    a span of its own. So a window fits the budget unless a single turn or the system turn does not, and
    no turn is cut. Every window after the first starts with the system turn, if the conversation opens with
    one, and the turns before its span that together have at most `history` tokens; `repeated` counts them.
    The mask holds code-point ranges of `formatted`: the texts of assistant turns of the span itself, so a
    target counts once however often it is repeated.

    A null text or role is empty. Turns are ordered by turn (null first), then role and text, so ties and
    repeated rows have one result. A null conv_id is a conversation of its own. Other columns are ignored.
    An empty table gives no rows.

    One shuffle by conversation; its turns stream through windows that spill, and nothing is grouped but the
    turns of one window. History is a range frame on the prefix sums.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        text_of("role").alias("role"),
        text_of("text").alias("text"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    within = Window.partitionBy("conv_id").orderBy(*order)
    whole = Window.partitionBy("conv_id")
    body = escape(F.col("text"))
    block = F.struct(
        F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">")).alias("head"),
        body.alias("body"),
        (F.col("role") == "assistant").alias("target"),
    )
    turns = (
        turns.withColumn("number", F.row_number().over(within))
        .withColumn("tokens", count_words(F.col("text")) + TURN_TOKENS)
        .withColumn("block", block)
        .withColumn("system", (F.col("number") == 1) & (F.col("role") == "system"))
        .withColumn("opening", F.max(F.when(F.col("system"), F.struct("block", "tokens"))).over(whole))
    )
    line = within.rowsBetween(Window.unboundedPreceding, -1)
    cost = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    turns = turns.withColumn("start", F.coalesce(F.sum(cost).over(line), F.lit(0)))
    cell = F.greatest(
        F.floor((F.lit(budget - history) - F.coalesce(F.col("opening.tokens"), F.lit(0))) / 2), F.lit(1)
    )
    number = F.floor(F.col("start") / cell)
    alone = (F.col("start") + F.col("tokens") > (number + 1) * cell) & (F.col("tokens") > cell)
    # The range frame looks at lines of equal conversations only; the system turn is not history.
    near = Window.partitionBy("conv_id").orderBy("start").rangeBetween(-history, -1)
    turns = (
        turns.withColumn("span", F.when(F.col("system"), F.lit(0)).otherwise(2 * number + alone.cast("int")))
        .withColumn("near", F.collect_list(F.when(~F.col("system"), F.struct("start", "number", "block"))).over(near))
        .withColumn("near_from", F.col("start"))
    )
    spans = turns.groupBy("conv_id", "span").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("own"),
        F.sum("tokens").alias("tokens"),
        F.min("number").alias("first"),
        F.min_by("near", "number").alias("near"),
        F.max("opening").alias("opening"),
    )
    before = F.transform(F.sort_array(F.col("near")), lambda n: n["block"])
    opening = F.when(F.col("opening").isNotNull() & (F.col("first") > 1), F.array("opening.block")).otherwise(
        F.array().cast("array<struct<head:string,body:string,target:boolean>>")
    )
    placed = spans.select(
        "conv_id", "first", "tokens",
        F.concat(opening, before).alias("again"),
        F.transform("own", lambda o: o["block"]).alias("own"),
    )
    rank = Window.partitionBy("conv_id").orderBy("first")
    blocks = F.concat("again", "own")
    return placed.select(
        "conv_id",
        (F.row_number().over(rank) - 1).alias("window"),
        F.concat_ws("", F.transform(blocks, _written)).alias("formatted"),
        F.size("again").alias("repeated"),
        "tokens",
        _mask(F.col("again"), F.col("own")).alias("mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role and text), loss (the masked texts as one), from windows' output alone."""
    parsed = F.transform(
        F.slice(F.split("formatted", END), F.col("repeated") + 1, F.greatest(_turn_count() - F.col("repeated"), F.lit(0))),
        lambda t: F.struct(
            unescape(F.substring_index(F.substring(t, len("<turn ") + 1, 2**31 - 1), ">", 1)).alias("role"),
            unescape(F.substring(t, F.instr(t, ">") + 1, F.length(t))).alias("text"),
        ),
    )
    masked = F.concat_ws(
        "", F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["end"] - m["start"])))
    )
    pieces = formatted.select(
        "conv_id", "window", parsed.alias("turns"), masked.alias("loss"), F.char_length("formatted").alias("chars")
    )
    ordered = F.sort_array(F.collect_list(F.struct("window", "turns", "loss")))
    return pieces.groupBy("conv_id").agg(ordered.alias("w"), F.sum("chars").alias("formatted_chars")).select(
        "conv_id",
        F.flatten(F.transform("w", lambda w: w["turns"])).alias("turns"),
        F.concat_ws("", F.transform("w", lambda w: w["loss"])).alias("loss"),
        "formatted_chars",
    )


def _turn_count() -> Column:
    return F.size(F.split("formatted", END)) - 1


def _written(block: Column) -> Column:
    return F.concat(block["head"], block["body"], F.lit(END))


def _mask(again: Column, own: Column) -> Column:
    """Ranges of the bodies of the span's targets, from running lengths of its blocks."""

    def length(block: Column) -> Column:
        return F.char_length(_written(block))

    start = F.aggregate(again, F.lit(0), lambda a, b: a + length(b))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, block: Column) -> Column:
        body = state["at"] + F.char_length(block["head"])
        reach = F.struct(body.alias("start"), (body + F.char_length(block["body"])).alias("end"))
        return F.struct(
            (state["at"] + length(block)).alias("at"),
            F.when(block["target"], F.concat(state["out"], F.array(reach))).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(own, F.struct(start.alias("at"), empty.alias("out")), step, lambda s: s["out"])
