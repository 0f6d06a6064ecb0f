"""Chat formatting with cumulative-snapshot collapse.

A log often holds every state of a growing conversation.  Each turn gets a
rolling hash of all turns up to it; a conversation whose last rolling hash
occurs at a turn of a longer one is a snapshot of it and goes by an anti-join;
of equal conversations the smallest id stays.  The rest is rendered.

A rolling hash is the xor, in two seeds of 64 bits, of the hashes of the
turns so far (each with its turn number), so it is added up over segments of
``SEGMENT`` turn numbers.  Rendering numbers the turns of a conversation by
range partitions and makes one row per ``SEGMENT`` turns in order, so no task
gathers more of them, whatever their numbers are.

Edge cases: rows without conv_id are left out; rows that repeat (conv_id,
turn, role, text) count once; turns that share a number (or have none) are
ordered by role and text and stand or fall together, but may be rendered in
several chunks; a null turn comes first; null role or
text is rendered empty but hashes apart from the empty string; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrlake.llm.common import stored

SEGMENT = 256
START, END = "<|im_start|>", "<|im_end|>"


def turns(conversations: DataFrame) -> DataFrame:
    """Distinct (conv_id, turn, role, text) with segment and turn hashes."""
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
            .where("conv_id is not null"))

    def hashed(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "turn", F.col("role").isNull(), "role", F.col("text").isNull(), "text")

    return (rows.withColumn("h1", hashed(1)).withColumn("h2", hashed(2))
            .dropDuplicates(["conv_id", "turn", "role", "text"])
            .withColumn("segment", F.floor(F.coalesce("turn", F.lit(-1)) / SEGMENT)))


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, n, p1, p2, last): the rolling hash at each turn number,
    rows so far, and whether it is the conversation's last."""
    steps = rows.groupBy("conv_id", "segment", "turn").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.count("*").alias("n"))
    steps = stored(steps, "turn-hashes")
    sums = steps.groupBy("conv_id", "segment").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"), F.sum("n").alias("bn"))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("conv_id").orderBy(F.desc("segment"))
    zero = F.lit(0).cast("long")
    starts = sums.select("conv_id", "segment", F.coalesce(F.bit_xor("b1").over(before), zero).alias("b1"),
                         F.coalesce(F.bit_xor("b2").over(before), zero).alias("b2"),
                         F.coalesce(F.sum("bn").over(before), zero).alias("bn"), (F.row_number().over(after) == 1).alias("final"))
    inside = Window.partitionBy("conv_id", "segment").orderBy(F.asc_nulls_first("turn")).rowsBetween(Window.unboundedPreceding, 0)
    ends = Window.partitionBy("conv_id", "segment").orderBy(F.desc_nulls_last("turn"))
    return (steps.join(starts, ["conv_id", "segment"])
            .select("conv_id", "turn", (F.col("bn") + F.sum("n").over(inside)).alias("n"),
                    F.col("b1").bitwiseXOR(F.bit_xor("h1").over(inside)).alias("p1"),
                    F.col("b2").bitwiseXOR(F.bit_xor("h2").over(inside)).alias("p2"),
                    (F.col("final") & (F.row_number().over(ends) == 1)).alias("last")))


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal): conversations that are no snapshot of a
    longer one, and how many equal ones each stands for, itself included."""
    marks = stored(prefixes(rows), "prefixes")
    whole = (marks.where("last").groupBy("n", "p1", "p2")
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal")))
    inner = marks.where("not last").select("n", "p1", "p2").distinct()
    return (whole.join(inner, ["n", "p1", "p2"], "left_anti")
            .select("conv_id", F.col("n").alias("n_turns"), "n_equal"))


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` with the position ``pos`` of a turn in its conversation.  The
    whole order is cut into ranges (long texts by their first characters); a
    range counts its own rows only."""
    rows = rows.select("conv_id", F.coalesce("turn", F.lit(-2 ** 63)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
    dealt = stored(rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
                   .withColumn("part", F.spark_partition_id()), "turn-ranges")
    counts = stored(dealt.groupBy("part", "conv_id").agg(F.count("*").alias("m")), "turn-counts")
    before = F.sum("m").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("m")
    within = Window.partitionBy("part", "conv_id").orderBy("turn", "role", "text")
    return (dealt.join(counts.select("part", "conv_id", before.alias("before")), ["part", "conv_id"])
            .withColumn("pos", F.col("before") + F.row_number().over(within) - 1).drop("part", "before"))


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    """(conv_id, chunk, n_turns, n_equal, text): every maximal conversation,
    rendered in chunks of ``SEGMENT`` turns each, in order."""
    rows = turns(conversations)
    chunk = F.expr(f"pos div {SEGMENT}")
    kept = maximal(rows).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(n_turns - 1) div {SEGMENT}"))))
    line = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n")).alias("line")
    lines = in_order(rows).select("conv_id", chunk.alias("chunk"), "pos", line)
    parts = lines.join(kept, ["conv_id", "chunk"]).groupBy("conv_id", "chunk", "n_turns", "n_equal").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    return parts.select("conv_id", "chunk", "n_turns", "n_equal",
                        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"))
