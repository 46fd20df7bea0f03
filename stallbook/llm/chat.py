"""Chat formatting: logged conversations collapsed to the maximal ones, then rendered.

A chat log that is saved after every turn holds each conversation many times, each time one
turn longer. Every turn gets a rolling hash of the conversation up to it: sums of hashes of
(place, role, text), so that the sums of a slice can be added to those of the slices before
it and a conversation of any length is hashed by many tasks. A conversation whose last hash
is an earlier hash of any conversation is a prefix of that one; an anti-join drops it. Of
equal conversations the one with the smallest id stays.

Rendering gives one row per conversation and slice of SLICE turn numbers (nearly always one),
so no row holds an unbounded conversation; slices in order are the whole.

DataFrame functions only. Cases: rows without conversation id are left out; a null turn comes
before turn 0, a null role or text is empty; repeated rows count once; turns with the same
number are ordered by role and text; markers inside a text are broken by a space; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.common import prepare

SLICE = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SUMS = ["a", "b", "c", "d"]


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Clean distinct turns: conv, turn, role, text, slice."""
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(-1).cast("long")).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    return rows.distinct().withColumn("slice", F.floor(F.col("turn") / SLICE))


def before(totals: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """Per conversation and slice, what the slices before it add up to; one short row per slice."""
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("long")).alias(f"base_{c}") for c in columns]
    return totals.select("conv", "slice", *sums, *more)


def rolling(clean: DataFrame) -> DataFrame:
    """conv, place (1, 2, ...), the four rolling sums, and whether the turn is the conversation's last."""
    inside = Window.partitionBy("conv", "slice").orderBy("turn", "role", "text")
    no_more = F.lead("slice").over(Window.partitionBy("conv").orderBy("slice")).isNull().alias("ends")
    counts = before(clean.groupBy("conv", "slice").agg(F.count("*").alias("n")), ["n"], F.col("n"), no_more)
    # Joins below are by slice, never by conversation alone, which may hold most rows.
    numbered = clean.withColumn("own", F.row_number().over(inside)).join(counts, ["conv", "slice"])
    placed = numbered.select(
        "conv", "slice", "role", "text", (F.col("own") + F.col("base_n")).alias("place"),
        (F.col("ends") & (F.col("own") == F.col("n"))).alias("last"),
    )
    # Halves of two hashes: sums of 31-bit numbers don't overflow below four billion turns.
    first, second = F.xxhash64("place", "role", "text"), F.xxhash64("text", "place", F.lit("second"), "role")
    low = F.lit(2**31 - 1).cast("long")
    hashed = placed.select(
        "conv", "slice", "place", "last",
        first.bitwiseAND(low).alias("a"), F.shiftrightunsigned(first, 33).alias("b"),
        second.bitwiseAND(low).alias("c"), F.shiftrightunsigned(second, 33).alias("d"),
    )
    totals = before(hashed.groupBy("conv", "slice").agg(*[F.sum(s).alias(s) for s in SUMS]), SUMS)
    running = Window.partitionBy("conv", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = hashed.select("conv", "slice", "place", "last", *[F.sum(s).over(running).alias(s) for s in SUMS])
    return local.join(totals, ["conv", "slice"]).select(
        "conv", "place", *[(F.col(s) + F.col(f"base_{s}")).alias(s) for s in SUMS], "last"
    )


def maximal(clean: DataFrame) -> DataFrame:
    """conv, length: the conversations that no other one continues, one of each group of equals."""
    hashes = rolling(clean)
    identity = ["place", *SUMS]
    whole = hashes.where("last").groupBy(*identity).agg(F.min("conv").alias("conv"))
    prefixes = hashes.where(~F.col("last")).select(*identity).distinct()
    return whole.join(prefixes, identity, "left_anti").select("conv", F.col("place").cast("long").alias("length"))


def rendered(role: Column, text: Column) -> Column:
    safe = F.replace(text, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), safe, F.lit(CLOSE + "\n"))


def chat_texts(conversations: DataFrame) -> DataFrame:
    """conv_id, chunk (slice of turn numbers), n_turns of the conversation, chunk_turns, text."""
    prepare(conversations.sparkSession)
    clean = turns(conversations)
    kept = maximal(clean)
    own = clean.join(kept, "conv").groupBy("conv", "slice", "length").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows")
    )
    lines = F.transform("rows", lambda r: rendered(r["role"], r["text"]))
    return own.select(
        F.col("conv").alias("conv_id"), F.col("slice").cast("long").alias("chunk"), F.col("length").alias("n_turns"),
        F.size("rows").cast("long").alias("chunk_turns"), F.array_join(lines, "").alias("text"),
    )
