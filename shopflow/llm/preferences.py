"""Preference formatting: the shared turns of chosen and rejected as one prompt, two masked completions.

Input: one row for each turn, (pair, side, turn, role, text), side ``chosen`` or
``rejected``.  The two sides' turns are compared place by place; the longest run
of equal turns from the start (same role and text) is the prompt, rendered once.
What follows on each side is its completion.  A completion's loss mask is a list
of character spans, relative to the completion: the texts of the assistant's
turns with their end mark; all else (headers, other roles) is masked.

A pair is one training example, so its two conversations are brought together in
one row; nothing else is grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the chat template.
OPEN, CLOSE, BREAK = "<|im_start|>", "<|im_end|>", "\n"
TRAINED_ROLE = "assistant"


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE + BREAK))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _spans(turns: Column) -> Column:
    """[start, end) of what is trained, in characters of the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        head = acc["at"] + F.length(turn["role"]) + F.lit(len(OPEN) + 1)
        tail = head + F.length(turn["text"]) + F.lit(len(CLOSE))
        span = F.array(F.struct(head.alias("start"), tail.alias("end")))
        return F.struct((tail + F.lit(len(BREAK))).alias("at"),
                        F.when(turn["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_pairs(turns: DataFrame, pair: str = "pair_id") -> DataFrame:
    """One row for each pair: prompt, chosen, rejected, loss spans, and turn counts.

    Null roles and texts count as empty.  Rows without pair, side or turn, or with another
    side, belong to no conversation.  Repeated rows count once; of different rows with
    the same turn number the one with lesser role, then text, goes first.  A side
    without rows has no turns: the prompt is then empty.  Equal sides have all in the
    prompt and empty completions; ``has_preference`` is then false.
    """
    rows = turns.select(F.col(pair).alias("pair_id"), "side", F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t")).where(
            "pair_id is not null and t.turn is not null and side in ('chosen', 'rejected')")
    sides = rows.groupBy("pair_id").agg(*[
        F.array_sort(F.collect_set(F.when(F.col("side") == s, F.col("t")))).alias(s) for s in ("chosen", "rejected")])
    plain = {s: F.transform(F.col(s), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
             for s in ("chosen", "rejected")}
    sides = sides.select("pair_id", *[plain[s].alias(s) for s in plain])
    equal = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    first_other = F.array_position(equal, False)
    n = F.when(first_other == 0, F.size("chosen")).otherwise(first_other - 1).cast("int")
    cut = sides.withColumn("n", n).select(
        "pair_id", "n", F.slice("chosen", 1, F.col("n")).alias("p"),
        *[F.slice(s, F.col("n") + 1, F.size(s)).alias(s) for s in ("chosen", "rejected")])
    return cut.select(
        "pair_id", F.col("n").cast("long").alias("prompt_turns"), F.size("chosen").cast("long").alias("chosen_turns"),
        F.size("rejected").cast("long").alias("rejected_turns"), _text(F.col("p")).alias("prompt"),
        _text(F.col("chosen")).alias("chosen"), _spans(F.col("chosen")).alias("chosen_spans"),
        _text(F.col("rejected")).alias("rejected"), _spans(F.col("rejected")).alias("rejected_spans"),
        ((F.size("chosen") > 0) | (F.size("rejected") > 0)).alias("has_preference"))


def spans_text(spans: Column) -> Column:
    """Spans as ``start:end,start:end``."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
