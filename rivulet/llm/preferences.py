"""Preference formatting for chat data, in DataFrame functions only.

A chosen and a rejected conversation are rendered as one prompt (their longest
common prefix of turns, equal in role and text, rendered once) and two
completions with masks: only what an assistant says, and the mark that ends
it, counts for the loss.

Turns are gathered per conversation (a conversation is one row's worth of
data, like a document); everything after that is arrays of one row.

Edge cases: a null role is ``user`` and a null text is empty; equal turns
repeat as they stand, in the order (turn, role, text), null turn numbers
first; conversations that are equal, or of which one is a prefix of the
other, give an empty completion; a conversation with no partner gives no row;
turns with a null conversation id are left out; markers inside texts are
broken up, so that a text can't end its own turn; a very long text, or a
conversation of many turns, is one row; other columns are not read; empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm._order import number, range_of

HEAD, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
PIECE = 100_000


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: id, turns (array of role and text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("conv_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias("all"))
            .select("conv_id", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))


def pair_by_opening(chats: DataFrame, piece: int = PIECE) -> DataFrame:
    """Pairs (chosen, rejected) of conversations with equal openings: the
    turns up to the first of the user.  In an opening's conversations by id,
    the first and second are a pair, the third and fourth, and so on; a hot
    opening is numbered in pieces.  Returns opening, pair, conv_id, turns,
    rejected_id, rejected_turns."""
    at = F.array_position(F.transform("turns", lambda t: t["role"] == "user"), True)
    opening = F.sha2(F.to_json(F.slice("turns", 1, F.when(at > 0, at).otherwise(F.size("turns")).cast("int"))), 256)
    keyed = chats.withColumn("opening", opening)
    part, _ = range_of(chats, "conv_id", chats.count() // piece + 1)
    numbered = number(keyed.select("opening", "conv_id"), ["opening"], part, ["conv_id"], "n")
    ids = numbered.groupBy("opening", F.floor(F.col("n") / 2).alias("pair")).agg(
        F.min("conv_id").alias("conv_id"), F.max("conv_id").alias("rejected_id"), F.count("*").alias("both")
    ).where("both = 2").drop("both")
    return ids.join(chats, "conv_id").join(
        chats.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected_turns")), "rejected_id")


def pair_with_next_reply(chats: DataFrame, piece: int = PIECE) -> DataFrame:
    """Every conversation with an assistant's turn, up to its last one, as
    chosen; the same with that reply replaced by the last reply of the next
    such conversation by id (after the last comes the first) as rejected.
    Returns conv_id, turns, rejected_id (whose reply it is), rejected_turns."""
    back = F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), "assistant")
    last = (F.size("turns") - back + 1).cast("int")
    rows = chats.where(back > 0).select("conv_id", F.slice("turns", F.lit(1), last).alias("turns"))
    part, _ = range_of(rows, "conv_id", rows.count() // piece + 1)
    numbered = number(rows.select("conv_id", F.element_at("turns", -1).alias("reply")), [], part, ["conv_id"], "n")
    total = F.lit(rows.count())
    other = numbered.select(F.pmod(F.col("n") - 1 + total, total).alias("n"), F.col("conv_id").alias("rejected_id"), F.col("reply").alias("other"))
    pairs = numbered.select("conv_id", "n").join(other, "n").drop("n")
    return rows.join(pairs, "conv_id").withColumn(
        "rejected_turns", F.concat(F.slice("turns", F.lit(1), F.size("turns") - 1), F.array("other"))).drop("other")


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns are equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.get(a, i - 1).eqNullSafe(F.get(b, i - 1)))
    first = F.array_position(same, False)
    return F.when(n == 0, 0).when(first == 0, n).otherwise(first - 1).cast("int")


def segments(turns: Column) -> Column:
    """Rendered pieces of turns, each with its weight in the loss (0 or 1):
    the header of a turn, then what is said and the end mark."""
    def pieces(t: Column) -> Column:
        said = F.replace(t["text"], F.lit(HEAD), F.lit("< |"))
        return F.array(
            F.struct(F.concat(F.lit(HEAD), t["role"], F.lit(MIDDLE)).alias("text"), F.lit(0).alias("loss")),
            F.struct(F.concat(said, F.lit(END)).alias("text"), F.when(t["role"] == "assistant", 1).otherwise(0).alias("loss")))
    return F.flatten(F.transform(turns, pieces))


def joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda s: s["text"]), "")


def run_lengths(pieces: Column) -> Column:
    """The mask of a rendered text as runs: code points and their weight."""
    return F.transform(pieces, lambda s: F.struct(F.length(s["text"]).alias("n_chars"), s["loss"].alias("loss")))


def format_pairs(pairs: DataFrame, chosen: str = "turns", rejected: str = "rejected_turns") -> DataFrame:
    """Replace the two turn columns by n_prompt_turns, prompt, chosen and
    rejected (completions), and chosen_mask and rejected_mask (runs of code
    points, each with its weight in the loss)."""
    n = F.col("n_prompt_turns")
    keep = [c for c in pairs.columns if c not in (chosen, rejected)]
    rows = pairs.withColumn("n_prompt_turns", common_prefix(F.col(chosen), F.col(rejected)))

    def rest(turns: str) -> Column:
        return segments(F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0))))

    return rows.select(*keep, "n_prompt_turns", joined(segments(F.slice(chosen, F.lit(1), n))).alias("prompt"),
                       joined(rest(chosen)).alias("chosen"), run_lengths(rest(chosen)).alias("chosen_mask"),
                       joined(rest(rejected)).alias("rejected"), run_lengths(rest(rejected)).alias("rejected_mask"))
