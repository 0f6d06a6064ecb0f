"""Topic positions: which offsets of which partition a table holds.

``islands`` finds the runs of offsets without a hole.  Offsets go into
bitmaps of 32,768 positions, built map-side: a chunk whose bitmap is as full
as its span is one run, and only the offsets of the others are looked at one
by one, inside their chunk.  So no topic partition is sorted in one task; what
is ordered per partition is one row per chunk or run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POSITION = ["source_partition", "source_offset"]


def islands(rows: DataFrame) -> DataFrame:
    """(source_partition, first, last): the runs of ``rows``' offsets.  Copies
    of a position and rows without one don't count."""
    at = rows.select(*POSITION).where("source_partition is not null and source_offset is not null")
    at = at.withColumn("chunk", F.bitmap_bucket_number("source_offset"))
    chunks = at.groupBy("source_partition", "chunk").agg(
        F.min("source_offset").alias("first"), F.max("source_offset").alias("last"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("source_offset"))).alias("n"))
    whole = F.col("n") == F.col("last") - F.col("first") + 1
    full = chunks.where(whole).select("source_partition", "first", "last")
    holed = chunks.where(~whole).select("source_partition", "chunk")
    order = Window.partitionBy("source_partition", "chunk").orderBy("source_offset")
    inside = (at.join(holed, ["source_partition", "chunk"], "left_semi").distinct()
              .withColumn("run", F.col("source_offset") - F.row_number().over(order))
              .groupBy("source_partition", "chunk", "run")
              .agg(F.min("source_offset").alias("first"), F.max("source_offset").alias("last"))
              .select("source_partition", "first", "last"))
    return merged(full.unionByName(inside))


def merged(runs: DataFrame, *least: str) -> DataFrame:
    """Runs (source_partition, first, last) that touch or overlap made one;
    columns ``least`` keep their smallest value."""
    before = Window.partitionBy("source_partition").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("source_partition").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))
    return (runs.withColumn("_begins", begins.cast("int")).withColumn("_run", F.sum("_begins").over(upto))
            .groupBy("source_partition", "_run")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), *[F.min(c).alias(c) for c in least])
            .drop("_run"))


def gaps(runs: DataFrame, *keep: str) -> DataFrame:
    """(source_partition, gap_first, gap_last, missing) between the runs of
    each partition; ``keep`` are columns of the run after the gap."""
    earlier = F.lag("last").over(Window.partitionBy("source_partition").orderBy("first"))
    return (runs.withColumn("_earlier", earlier).where("_earlier is not null")
            .select("source_partition", (F.col("_earlier") + 1).alias("gap_first"), (F.col("first") - 1).alias("gap_last"),
                    (F.col("first") - F.col("_earlier") - 1).alias("missing"), *keep))


def offset_gaps(rows: DataFrame) -> DataFrame:
    """The offsets between a partition's first and last that ``rows`` lack."""
    return gaps(islands(rows))
