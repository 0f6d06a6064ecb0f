"""What a stream would lose unseen, made visible or stopped.

* ``start_offset_guard`` (S1): the offsets of every topic partition, kept
  across batches; a hole that stays stops the query.
* ``start_late_split`` (ST6): rows that a daily window behind a watermark
  would drop go to a table of their own; the windowed fact reads the rest and
  drops none.
* ``LossRecords`` (ST6/P6): late drops and cast errors of every micro-batch,
  from the queries' progress, as rows of a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from attrlake.functions.time import ntz_to_micros
from attrlake.operators import offsets as O
from attrlake.schemas import silver_schema
from attrlake.store import LakeTable, _children, _delete
from attrlake.streaming import pipeline as P
from attrlake.streaming.deltas import DONE

RUNS = "source_partition int, first bigint, last bigint, seen bigint"
DAY_US = 86_400_000_000


def _batches(spark: SparkSession, folder: str, before: int | None = None) -> list[int]:
    """Complete ``batch=<id>`` folders, oldest first."""
    found = [int(c.split("=")[1]) for c in _children(spark, folder) if c.startswith("batch=")]
    return sorted(b for b in found if (before is None or b < before) and DONE in _children(spark, f"{folder}/batch={b}"))


# -- S1: lost offsets ---------------------------------------------------------------

class LostOffsets(RuntimeError):
    """The topic lacks offsets between ones that were read."""


def _refuse(open_gaps: DataFrame) -> None:
    worst = open_gaps.orderBy(F.desc("missing"), "source_partition", "gap_first").limit(10).collect()
    if worst:
        raise LostOffsets("offsets lost: " + "; ".join(
            f"partition {g.source_partition}: {g.gap_first} to {g.gap_last} ({g.missing})" for g in worst))


def guard_offsets(batch: DataFrame, batch_id: int, state: str, patience: int = 0) -> None:
    """Fold a micro-batch's offsets into the runs seen so far and raise if a
    hole has stayed open for more than ``patience`` batches.  The state, a row
    per run, is written per batch, so a replayed batch starts from the same
    one."""
    spark = batch.sparkSession
    earlier = _batches(spark, state, batch_id)
    rows = batch.select(F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"))
    runs = O.islands(rows).withColumn("seen", F.lit(batch_id).cast("bigint"))
    if earlier:
        runs = runs.unionByName(spark.read.schema(RUNS).parquet(f"{state}/batch={earlier[-1]}"))
    here = f"{state}/batch={batch_id}"
    O.merged(runs, "seen").select("source_partition", "first", "last", "seen").coalesce(1).write.mode("overwrite").parquet(here)
    for old in earlier[:-1]:
        _delete(spark, f"{state}/batch={old}")
    _refuse(O.gaps(spark.read.schema(RUNS).parquet(here), "seen").where(F.col("seen") <= batch_id - patience))


def check_offsets(spark: SparkSession, state: str) -> None:
    """Raise if any hole is open now (the end of a bounded run)."""
    found = _batches(spark, state)
    if found:
        _refuse(O.gaps(spark.read.schema(RUNS).parquet(f"{state}/batch={found[-1]}"), "seen"))


def start_offset_guard(topic: DataFrame, state: str, settings: P.StreamSettings, patience: int = 0) -> StreamingQuery:
    """A query over the topic's positions that fails on lost offsets.

    ``patience`` 0 suits a source that reads each partition in order; files of
    a topic may hold a partition's offsets in any order, so a hole may need a
    few batches to fill.  Topics with natural holes (compaction, transaction
    markers) can't be guarded this way.
    """
    return (P._writer(topic.select("partition", "offset"), "offset_guard", settings)
            .foreachBatch(lambda df, bid: guard_offsets(df, bid, state, patience)).start())


# -- ST6: late rows -------------------------------------------------------------------

@dataclass
class Split:
    """Where a split keeps the rows in time, the late ones and how far event
    time had come after each batch."""

    spark: SparkSession
    location: str

    def _path(self, name: str) -> str:
        return f"{self.location.rstrip('/')}/{name}"

    @property
    def timely(self) -> LakeTable:
        return LakeTable(self.spark, self._path("timely"))

    @property
    def late(self) -> LakeTable:
        return LakeTable(self.spark, self._path("late"))

    def _mark(self, batch_id: int) -> int | None:
        """Largest event time (micros) of the batches before ``batch_id``."""
        earlier = _batches(self.spark, self._path("marks"), batch_id)
        if not earlier:
            return None
        return self.spark.read.schema("most bigint").parquet(self._path(f"marks/batch={earlier[-1]}")).first()[0]

    def take(self, batch: DataFrame, batch_id: int, delay_us: int) -> None:
        """Split one micro-batch.  A row is late if its day had ended
        ``delay_us`` before the largest event time of earlier batches (what a
        daily window behind that watermark drops), or if it has no event
        time.  Each batch has its own folders: complete ones are kept on a
        replay, half-written ones replaced."""
        mark = self._mark(batch_id)
        us = ntz_to_micros(F.col("created_at"))
        day_end = (F.floor(us / DAY_US) + 1) * DAY_US
        late = day_end <= F.lit(None if mark is None else mark - delay_us).cast("bigint")
        reason = F.when(us.isNull(), "no_event_time").when(late, "late")
        rows = batch.withColumn("reason", reason).persist()
        try:
            for name, part in (("late", rows.where("reason is not null")), ("timely", rows.where("reason is null").drop("reason"))):
                if batch_id not in _batches(self.spark, self._path(name)):
                    part.write.mode("overwrite").parquet(self._path(f"{name}/batch={batch_id}"))
            most = rows.agg(F.greatest(F.max(us), F.lit(mark).cast("bigint")).alias("most"))
            most.coalesce(1).write.mode("overwrite").parquet(self._path(f"marks/batch={batch_id}"))
        finally:
            rows.unpersist()


def _delay_us(spark: SparkSession, delay: str) -> int:
    return spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {delay}"))).first()[0]


def start_late_split(spark: SparkSession, silver: LakeTable, split: Split, name: str, settings: P.StreamSettings) -> StreamingQuery:
    """Split the rows that fact ``name`` counts, with the columns it reads."""
    rows = P._of_family(silver.read_stream(silver_schema(), settings.max_files_per_trigger), name)
    delay = _delay_us(spark, settings.watermark)
    return (P._writer(rows, f"{name}_split", settings)
            .foreachBatch(lambda df, bid: split.take(df, bid, delay)).start())


def start_fact_of_timely(spark: SparkSession, split: Split, table: LakeTable, name: str, settings: P.StreamSettings) -> StreamingQuery:
    """The windowed fact over the rows in time.  Its own watermark trails the
    split's, so it drops none of them."""
    return P.start_fact_upsert(spark, split.timely, table, name, settings, settings.watermark)


# -- ST6 / P6: a table of what was lost ---------------------------------------------------

RECORD = T.StructType([T.StructField(n, t) for n, t in (
    ("query", T.StringType()), ("run_id", T.StringType()), ("batch_id", T.LongType()), ("at", T.StringType()),
    ("input_rows", T.LongType()), ("watermark", T.StringType()), ("late_dropped", T.LongType()),
    ("checked_rows", T.LongType()), ("cast_errors", T.LongType()))])


@dataclass
class LossRecords(StreamingQueryListener):
    """One row per micro-batch: rows read, rows that a stateful operator
    dropped as late, values that did not convert (metrics observed under the
    name ``conform``).  Progress is gathered as it is reported; ``flush``
    appends it to ``table``."""

    table: LakeTable
    pending: list = field(default_factory=list)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get("conform")
        self.pending.append((
            p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, (p.eventTime or {}).get("watermark"),
            sum(op.numRowsDroppedByWatermark or 0 for op in p.stateOperators),
            seen["rows"] if seen else None, seen["cast_errors"] if seen else None))

    def flush(self) -> None:
        taken, self.pending = self.pending, []
        if taken:
            self.table.append(self.table.spark.createDataFrame(taken, RECORD).coalesce(1))
