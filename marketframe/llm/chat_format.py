"""Chat transcripts as marked-up text, in Spark expressions only.

A conversation is its turns, collected as structs and sorted. Neighbouring turns of one role share one
marked block. Every control string begins with ``<|``; a text's own ``<|`` gets a backslash after the
``<`` (and one more if it has some there already), which reading back takes away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, starts

# The template's control strings.
START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_next|>"


def escaped(text: Column) -> Column:
    """A text that holds no control string."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role in one line."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row a conversation: conv_id, formatted and loss, the spans (start, end in code points) of ``learn``'s texts in it.

    Turns are sorted by number, then role and text, NULL first, so ties and repeated rows have a defined
    place. A NULL text or role is an empty one; rows with a NULL conversation form one of their own.
    Other columns are left out; an empty table gives no rows. One conversation is one text, so its turns
    meet in one task, collected there from what each task before has collected.
    """
    turns = df.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def marked(all_turns: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            same = (i > 0) & (F.get(all_turns, F.greatest(i - 1, F.lit(0)))["role"] == t["role"])
            opened = F.concat(F.when(i > 0, F.lit(END)).otherwise(""), F.lit(START), escaped_role(t["role"]), F.lit("\n"))
            return F.struct(F.when(same, F.lit(NEXT)).otherwise(opened).alias("mark"), escaped(t["text"]).alias("text"), (t["role"] == learn).alias("learn"))

        return F.transform(all_turns, one)

    pieces = sorted_turns.select("conv_id", marked(F.col("turns")).alias("pieces"))

    def spans(p: Column) -> Column:
        sizes = F.transform(p, lambda x: F.struct(F.length(x["mark"]).alias("gap"), F.length(x["text"]).alias("size")))
        placed = F.zip_with(p, starts(sizes), lambda x, s: F.struct(x["learn"].alias("learn"), s.alias("start"), (s + F.length(x["text"])).alias("end")))
        return F.transform(F.filter(placed, lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    whole = F.concat(F.array_join(F.transform("pieces", lambda x: F.concat(x["mark"], x["text"])), ""), F.lit(END))
    return pieces.select("conv_id", whole.alias("formatted"), let(F.col("pieces"), spans).alias("loss"))


def read_back(text: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""

    def block(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)

        def turns(r: Column) -> Column:
            texts = F.split(F.substr(b, F.length(r) + 2), r"<\|im_next\|>", -1)
            name = unescaped_role(F.substr(r, F.lit(len(START) + 1)))
            return F.transform(texts, lambda t: F.struct(name.alias("role"), unescaped(t).alias("text")))

        return let(role, turns)

    blocks = F.split(text, r"<\|im_end\|>\n", -1)
    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), block))


def under(text: Column, spans: Column) -> Column:
    """What stands under spans of a formatted conversation, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(text, s["start"] + 1, s["end"] - s["start"]))), "")


def report(df: DataFrame, **columns: str) -> DataFrame:
    """Per conversation what reading back its formatted text gives: turns and loss texts, as counts and digests."""
    read = formatted(df, **columns).select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), read_back(F.col("formatted")).alias("turns"), under(F.col("formatted"), F.col("loss")).alias("learned")
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
