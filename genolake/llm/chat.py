"""Chat logs: collapse cumulative snapshots, then render.

Chat systems often log a conversation again after every turn, so one log line
is a prefix of the next.  Only maximal conversations are kept:

* a turn's fingerprint is the bitwise sum (xor) of two 64-bit hashes of
  ``(turn, role, text)`` over the rows of that turn;
* a rolling fingerprint, xor-ed turn by turn, names every prefix of every
  conversation; the last one names the whole conversation;
* equal conversations keep the smallest ``conv_id``;
* an anti-join drops each conversation whose whole fingerprint (and row
  count) is a proper prefix of some other one.

Built-in functions only.  Both sides of the anti-join hold one row per
fingerprint, so a conversation logged a million times is no hot key.  The
rolling sum is taken in blocks of ``BLOCK_TURNS`` turns (within blocks, then
over block totals), so even one endless conversation is spread over tasks.

Defined cases: turns are compared by ``turn``, ``role`` and ``text`` (null
equals null); rows repeated within a conversation count once; several
different rows with one turn number belong to one turn and are rendered by
role, then text; rows with a null ``conv_id`` or ``turn`` form no conversation
and are left out; empty texts are kept; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TURNS = 1024


def _marked(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit("-"))


def distinct_turns(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.where("conv_id IS NOT NULL AND turn IS NOT NULL").dropDuplicates()


def prefix_fingerprints(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, n, f1, f2``: rows and fingerprint of the conversation up to and including each turn."""
    parts = [F.col("turn"), _marked("role"), _marked("text")]
    per_turn = turns.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*parts)).alias("f1"),
        F.bit_xor(F.xxhash64(F.lit("second"), *parts)).alias("f2"))
    per_turn = per_turn.withColumn("_block", F.floor(F.col("turn") / BLOCK_TURNS))
    inside = Window.partitionBy("conv_id", "_block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_turn.groupBy("conv_id", "_block").agg(
        F.sum("n").alias("bn"), F.bit_xor("f1").alias("b1"), F.bit_xor("f2").alias("b2"))
    blocks = blocks.select("conv_id", "_block", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("pn"),
                           F.coalesce(F.bit_xor("b1").over(before), F.lit(0)).alias("p1"),
                           F.coalesce(F.bit_xor("b2").over(before), F.lit(0)).alias("p2"))
    rolled = per_turn.select("conv_id", "_block", "turn", F.sum("n").over(inside).alias("n"),
                             F.bit_xor("f1").over(inside).alias("f1"), F.bit_xor("f2").over(inside).alias("f2"))
    return rolled.join(blocks, ["conv_id", "_block"]).select(
        "conv_id", "turn", (F.col("n") + F.col("pn")).alias("n"),
        F.col("f1").bitwiseXOR(F.col("p1")).alias("f1"), F.col("f2").bitwiseXOR(F.col("p2")).alias("f2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, copies``: the kept conversations and how many logged ones equal each."""
    rolling = prefix_fingerprints(turns)
    whole = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total"), F.max("turn").alias("last"))
    marked = rolling.join(whole, "conv_id")
    key = ["n", "f1", "f2"]
    complete = (marked.where("turn = last").groupBy(*key)
                .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")))
    proper = marked.where("turn < last").select(*key).distinct()
    return complete.join(proper, key, "left_anti").select("conv_id", "copies")


def render(turns: DataFrame, begin: str = "<|", end: str = "|>", close: str = "<|end|>") -> DataFrame:
    """``conv_id, n_turns, n_rows, rendered``: each conversation as one text, turns in order."""
    line = F.concat(F.lit(begin), F.coalesce("role", F.lit("")), F.lit(end + "\n"), F.coalesce("text", F.lit("")),
                    F.lit("\n" + close + "\n")).alias("line")
    rows = turns.select("conv_id", F.struct("turn", _marked("role").alias("role"), _marked("text").alias("text"),
                                            line).alias("row"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return grouped.select(
        "conv_id", F.size(F.array_distinct("rows.turn")).cast("long").alias("n_turns"),
        F.size("rows").cast("long").alias("n_rows"), F.array_join("rows.line", "").alias("rendered"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered: ``conv_id, copies, n_turns, n_rows, rendered``."""
    turns = distinct_turns(conversations)
    kept = maximal_conversations(turns)
    return (render(turns.join(kept.select("conv_id"), "conv_id", "left_semi")).join(kept, "conv_id")
            .select("conv_id", "copies", "n_turns", "n_rows", "rendered"))
