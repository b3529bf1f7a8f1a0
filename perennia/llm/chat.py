r"""Chat formatting and its inverse, with DataFrame functions only.

    <|im_start|>role\ntext<|im_sep|>text<|im_end|>\n

One block holds the adjacent turns of one role, with a separator between their texts. Control
strings inside texts are escaped (`\` as `\\`, `<|` as `<\|`), so no marker can be forged and the
turns can be read back exactly. In a role a line feed is written `\n`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import filled, let, running_sums, sha256

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # A line feed is the only `\n` whose backslash is not itself escaped.
    lines = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(lines)


def format_chats(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, `formatted`, and the loss mask `loss_runs`.

    Turns are ordered by number, then role, then text; null numbers come first; rows repeated are
    turns repeated. Null texts and roles are empty. Adjacent turns of one role share a block.
    `loss_runs` are pairs (skip, keep) of code points, one for each turn of the role `learn`: so many
    are passed over, so many count for the loss. A null id is a conversation of its own.
    """
    turns = rows.select(
        F.col(conv_col).alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            escape_role(filled(F.col(role_col))).alias("role"),
            escape(filled(F.col(text_col))).alias("text"),
        ).alias("t"),
    )
    chats = turns.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def head(turn: Column, i: Column) -> Column:
        before = F.try_element_at(F.col("turns"), F.greatest(i, F.lit(1)))
        opens = F.concat(F.lit(START), turn["role"], F.lit("\n"))
        return (
            F.when(i == 0, opens)
            .when(before["role"] == turn["role"], F.lit(SEP))
            .otherwise(F.concat(F.lit(END), opens))
        )

    pieces = F.transform("turns", lambda t, i: F.struct(head(t, i).alias("head"), t["text"].alias("text"), t["role"].alias("role")))
    formatted = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"])), ""), F.lit(END))
    runs = F.transform(
        "pieces",
        lambda p: F.struct(
            F.when(p["role"] == escape_role(F.lit(learn)), F.char_length(p["head"]))
            .otherwise(F.char_length(p["head"]) + F.char_length(p["text"])).alias("skip"),
            F.when(p["role"] == escape_role(F.lit(learn)), F.char_length(p["text"])).otherwise(F.lit(0)).alias("keep"),
        ),
    )
    return chats.withColumn("pieces", pieces).select(
        F.col("conv").alias(conv_col), formatted.alias("formatted"), runs.alias("loss_runs")
    )


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted conversation was made of."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1_000_000_000)

    def turns(block):
        role = F.substring_index(block, "\n", 1)
        body = F.substring_index(F.substring(block, F.char_length(role) + 2, F.char_length(block)), "<|im_end|>", 1)
        return F.transform(
            F.split(body, r"<\|im_sep\|>", -1),
            lambda text: F.struct(unescape_role(role).alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def learnt_text(formatted: Column, loss_runs: Column, block: int = 256) -> Column:
    """All text under the loss mask, unescaped, with nothing between its parts.

    A place in a text is found by walking to it, so runs are taken from blocks of the text, not from the whole.
    """

    def lengths(runs):
        return F.transform(runs, lambda r: (r["skip"] + r["keep"]).cast("long"))

    def total(runs):
        return F.aggregate(lengths(runs), F.lit(0).cast("long"), lambda acc, x: acc + x)

    def kept(runs, text):
        parts = F.zip_with(
            runs, running_sums(lengths(runs)), lambda r, at: F.substring(text, (at + r["skip"] + 1).cast("int"), r["keep"])
        )
        return F.array_join(F.transform(parts, unescape), "")

    def learnt(blocks):
        texts = F.zip_with(
            blocks,
            running_sums(F.transform(blocks, total)),
            lambda runs, at: let(
                F.substring(formatted, (at + 1).cast("int"), total(runs).cast("int")), lambda text: kept(runs, text)
            ),
        )
        return F.array_join(texts, "")

    last = F.floor((F.size(loss_runs) - 1) / block).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(loss_runs, b * block + 1, block))
    return F.when(F.size(loss_runs) > 0, let(blocks, learnt)).otherwise("")


def chat_digest(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What a reader of `formatted` and its loss mask finds: turns, and the text to learn."""
    texts = chats.select(
        conv_col,
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        learnt_text(F.col("formatted"), F.col("loss_runs")).alias("learnt"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return texts.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        sha256(F.array_join(said, "")).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        sha256(F.col("learnt")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
