"""Preference formatting of conversations (operator 9), in DataFrame functions.

A pair is two conversations (arrays of turns), chosen and rejected.  Their
longest common turn prefix is rendered once as the prompt; what follows it is
rendered as two completions, each with a mask: the character spans of its
assistant texts, the only ones that count in training.

Defined cases: a null role or text counts as empty; equal conversations give
two empty completions; an empty side is allowed; long texts need nothing
special, a row holds one pair; repeated turns of a conversation stay, ordered
by turn, role and text; turns without conv_id are left out; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rendering of a turn (fixed values).
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal."""
    equal = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differ = F.array_position(equal, False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(equal)).cast("int")


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def mask(turns: Column) -> Column:
    """Spans [begin, end) of the assistant texts in the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>")
                     .alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.length(t["role"]) + len(OPEN) + len(MIDDLE)
        end = begin + F.length(t["text"])
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"),
                        F.when(t["role"] == "assistant", F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (role, text) in order."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    return (conversations.where("conv_id is not null").groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(row)).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(
                x["role"].alias("role"), x["text"].alias("text"))).alias("turns")))


def format_pairs(pairs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Format a table with columns chosen and rejected (arrays of turns)."""
    n = pairs.withColumn("n_prompt_turns", common_prefix(F.col("chosen"), F.col("rejected")))
    after = {c: F.slice(F.col(c), F.col("n_prompt_turns") + 1,
                        F.size(c) - F.col("n_prompt_turns")) for c in ("chosen", "rejected")}
    return n.select(
        *keep, "n_prompt_turns", rendered(F.slice("chosen", 1, F.col("n_prompt_turns")))
        .alias("prompt"),
        *[rendered(v).alias(f"{c}_text") for c, v in after.items()],
        *[mask(v).alias(f"{c}_mask") for c, v in after.items()])


def mismatched_pairs(conversations: DataFrame) -> DataFrame:
    """conv_id, chosen, rejected for every conversation with an assistant
    turn.  Chosen: its turns up to the last assistant turn.  Rejected: the same
    with the last assistant text of the conversation whose id differs in the
    lowest bit, or without an answer if there is none."""
    last = F.size("turns") - F.array_position(
        F.transform(F.reverse("turns"), lambda t: t["role"] == "assistant"), True) + 1
    full = turn_lists(conversations).where(
        F.exists("turns", lambda t: t["role"] == "assistant")).withColumn("last", last.cast("int"))
    full = full.withColumn("chosen", F.slice("turns", 1, F.col("last")))
    other = full.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"),
                        F.slice("turns", F.col("last"), 1).alias("answer"))
    # an id is on either side once: no key can be hot
    return full.join(other, "conv_id", "left").select(
        "conv_id", "chosen", F.concat(F.slice("chosen", 1, F.size("chosen") - 1),
                                      F.coalesce("answer", F.slice("chosen", 1, 0)))
        .alias("rejected"))
