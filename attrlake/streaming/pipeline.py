"""Streaming layers: topic -> bronze -> silver -> gold.

Each layer is its own ``StreamingQuery`` with its own checkpoint, built
from the same ``DataFrame -> DataFrame`` functions as the batch form:

* bronze  (S1 K1 P1-P5 P10): route + decode, append with the file sink,
  partitioned by ``reason`` and ``event_date`` -- exactly once through the
  sink's commit log; one query reads and decodes the topic once, bronze and
  quarantine are reads of the sink's ``reason`` partitions;
* silver  (S3 ST4a K2): ``foreachBatch``: dedupe inside the batch, then an
  anti-join against the silver partitions the batch touches -- no state,
  no late-data loss, harmless when a batch is replayed;
* dims    (W1 K3 K4 ST8): ``foreachBatch`` keyed upsert that folds the
  batch's latest attributes into the touched buckets of the dimension;
* facts   (ST9 K5, the default): ``foreachBatch`` recomputes the touched days
  of a fact from silver -- exact under late rows, replays, checkpoint resets
  and backfills, distinct counts included;
* facts, window mode (ST5-ST8 K5): event-time daily window + watermark, update
  mode, ``foreachBatch`` upsert that *replaces* the changed keys; rows later
  than the watermark are dropped.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from attrlake.functions.time import event_date_from_micros, event_time
from attrlake.operators import bronze as B
from attrlake.operators import dims as D
from attrlake.operators import facts as A
from attrlake.operators import silver as S
from attrlake.operators.quality import QualityState
from attrlake.schemas import bronze_schema, silver_schema
from attrlake.store import LakeTable
from attrlake.streaming.deltas import DeltaTable

# Schema of a topic read (Kafka source columns; the file form of the topic
# has the same columns).
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
BRONZE_TABLE_SCHEMA = T.StructType(bronze_schema().fields + [
    T.StructField("event_date", T.DateType()),
    T.StructField("source_partition", T.IntegerType()),
    T.StructField("source_offset", T.LongType()),
    T.StructField("reason", T.StringType()),
])
DIM_BUCKETS = 16


@dataclass
class StreamSettings:
    """Where a query keeps its progress, how often it runs, how wide it is.

    ``shuffle_partitions`` is the state width of a stateful query: it is
    fixed in the checkpoint at the first start, so it is set per query,
    never session-wide (a query takes a copy of the session conf when it
    starts, see ``_started``).
    """

    checkpoint: str
    trigger: dict = field(default_factory=lambda: {"processingTime": "1 minute"})
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    shuffle_partitions: int | None = None
    watermark: str = "2 days"
    silver_mode: str = "batch"  # silver: "batch" (anti-join, no state) or "state" (watermark, file sink, sink log)
    fact_mode: str = "refresh"  # gold facts: "refresh" (touched days, exact) or "window" (state + watermark)
    offset_patience: int | None = None  # bronze: batches a hole in the offsets may stay open; None: no guard
    codec: str = "json"                # bronze: "json" or "avro"
    reader_schema: str | None = None   # bronze: Avro schema text (codec "avro")

    def available_now(self) -> StreamSettings:
        return replace(self, trigger={"availableNow": True})


@contextmanager
def _started(spark: SparkSession, settings: StreamSettings):
    """Apply per-query conf while a query starts, then restore the session."""
    key = "spark.sql.shuffle.partitions"
    if settings.shuffle_partitions is None:
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, str(settings.shuffle_partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows a stateful query has dropped so far (from its progress
    reports); silent data loss made visible."""
    total = 0
    for progress in query.recentProgress:
        for op in progress.stateOperators or []:
            total += op.numRowsDroppedByWatermark or 0
    return total


# -- sources ----------------------------------------------------------------------

def kafka_topic(spark: SparkSession, servers: str, topic: str,
                max_offsets_per_trigger: int | None = None,
                min_partitions: int | None = None) -> DataFrame:
    """The change topic from the earliest offset; lost offsets stop the
    query.  ``max_offsets_per_trigger`` bounds a micro-batch (the first one
    would otherwise take the whole topic); ``min_partitions`` splits the
    offset ranges of few, large topic partitions over more tasks.  Needs the
    Kafka source package on the class path."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest")
              .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().withColumn("key", F.col("key").cast("string"))


def file_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The topic in its file form: parquet files of topic-shaped rows."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def _writer(df: DataFrame, name: str, settings: StreamSettings):
    # The name carries a hash of the checkpoint root: stable across restarts
    # of one job, distinct between runs sharing a session.
    tag = hashlib.sha1(settings.checkpoint.encode()).hexdigest()[:6]
    return (df.writeStream.queryName(f"{name}-{tag}")
            .option("checkpointLocation", f"{settings.checkpoint.rstrip('/')}/{name}")
            .trigger(**settings.trigger))


# -- bronze -----------------------------------------------------------------------

def start_bronze(topic: DataFrame, bronze: LakeTable, settings: StreamSettings) -> list[StreamingQuery]:
    """K1/P10: every message appended under its ``reason`` (file sink, exactly
    once); ``bronze`` reads the good ones.  ``settings`` name the codec and,
    for Avro, the reader schema."""
    routed = B.route_messages(topic, settings.reader_schema, settings.codec)
    return [_append_sink(B.stored_messages(routed), "bronze", bronze, settings)]


def _append_sink(df: DataFrame, name: str, table: LakeTable, settings: StreamSettings) -> StreamingQuery:
    """Append-mode sink into ``table``: the file sink for a folder, the
    catalog table (``toTable``) for Iceberg; both exactly once."""
    if table.partition_by and table.files_per_partition:
        # Streams run without AQE: bound the files per day and batch.
        salt = F.pmod(F.spark_partition_id(), F.lit(table.files_per_partition))
        df = df.repartition(*[F.col(c) for c in table.partition_by], salt)
    w = _writer(df, name, settings).format(table.fmt).outputMode("append")
    if table.partition_by:
        w = w.partitionBy(*table.partition_by)
    return w.toTable(table.location) if table.fmt == "iceberg" else w.start(table.location)


# -- silver -----------------------------------------------------------------------

def silver_columns(silver: LakeTable) -> T.StructType:
    """The stored columns of silver: with ``bucket`` where days are split."""
    extra = [T.StructField("bucket", T.IntegerType())] if "bucket" in silver.partition_by else []
    return T.StructType(silver_schema().fields + extra)


def placed_in(rows: DataFrame, silver: LakeTable) -> DataFrame:
    """Silver rows with the partition columns of the table."""
    return rows.withColumn("bucket", A.device_bucket(silver.buckets)) if "bucket" in silver.partition_by else rows


def append_new_to_silver(batch: DataFrame, silver: LakeTable) -> None:
    """ST4a in one micro-batch: dedupe the batch, drop ids silver already
    holds in the days the batch touches (copies of an id share
    ``event_date``, and ``adid`` where days are split into device buckets),
    append the rest."""
    rows = placed_in(S.conform(S.dedupe_first(batch)), silver).persist()
    try:
        silver.insert_new(rows, ["event_date", "id"])
    finally:
        rows.unpersist()


def with_cast_errors(bronze: DataFrame) -> DataFrame:
    """The same rows; their number and that of the values ``conform`` will
    lose are observed per micro-batch (``losses.LossRecords``)."""
    return bronze.observe("conform", F.count(F.lit(1)).alias("rows"), F.sum(S.cast_errors(bronze)).alias("cast_errors"))


def start_silver(spark: SparkSession, bronze: LakeTable, silver: LakeTable,
                 settings: StreamSettings, bronze_columns: T.StructType | None = None) -> StreamingQuery:
    """``bronze_columns``: the stored bronze types, where they aren't the
    default ones (a registry's doubles, say)."""
    src = with_cast_errors(bronze.read_stream(bronze_columns or BRONZE_TABLE_SCHEMA, settings.max_files_per_trigger))
    return (_writer(src, "silver", settings)
            .foreachBatch(lambda df, _bid: append_new_to_silver(df, silver)).start())


def start_silver_with_state(spark: SparkSession, bronze: LakeTable, silver: LakeTable,
                            settings: StreamSettings, bronze_columns: T.StructType | None = None) -> StreamingQuery:
    """ST4a/S3 for a topic in event-time order: the ids of the last
    ``watermark`` are state, and the file sink appends each first arrival
    exactly once.  Silver isn't read back, and whoever streams from it reads
    the sink's commit log instead of listing the folder.

    Copies share ``created_at``, so a copy finds its id in the state or comes
    after the watermark and is dropped as late: none gets through.  A *first*
    arrival behind the watermark is dropped too (``LossRecords`` counts both
    kinds together); for such input use the form without state.  Of copies in one
    micro-batch any one stays.
    """
    src = with_cast_errors(bronze.read_stream(bronze_columns or BRONZE_TABLE_SCHEMA, settings.max_files_per_trigger))
    rows = (S.conform(src).withColumn("_event_ts", event_time("created_at"))
            .withWatermark("_event_ts", settings.watermark)
            .dropDuplicatesWithinWatermark(["id"]).drop("_event_ts"))
    with _started(spark, settings):
        return _append_sink(placed_in(rows, silver), "silver_state", silver, settings)


# -- gold: dimensions -------------------------------------------------------------

def dim_table(spark: SparkSession, location: str, buckets: int = DIM_BUCKETS) -> LakeTable:
    """A keyed table bucketed by ``pmod(xxhash64(key), buckets)``.  The
    bucket count is a property of the table: change it only by rebuilding."""
    return LakeTable(spark, location, ["bucket"], buckets=buckets)


def bucketed(dim: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    n = buckets or DIM_BUCKETS
    return dim.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int"))


def upsert_dimension(batch: DataFrame, table: LakeTable | DeltaTable, name: str, batch_id: int = 0) -> None:
    """K3/K4: fold the batch's newest attributes per key into the dimension:
    newest ``(last_seen, last_id)`` wins, so an out-of-order batch cannot roll
    a key back.  A delta table takes the batch's rows as they are.  In a
    bucketed one, new keys are appended and hash buckets that hold a key of
    the batch rewritten."""
    key, attributes = D.DIMENSIONS[name]
    if isinstance(table, DeltaTable):
        table.append(D.latest_attributes(batch, key, attributes), batch_id)
        return
    update = bucketed(D.latest_attributes(batch, key, attributes), key, table.buckets).persist()

    def merge(current: DataFrame, new: DataFrame) -> DataFrame:
        merged = D.merge_dimension(current.drop("bucket"), new.drop("bucket"), key, attributes)
        return bucketed(merged, key, table.buckets)

    try:
        table.upsert(update, [key], merge=merge)
    finally:
        update.unpersist()


def start_dimension(spark: SparkSession, silver: LakeTable, table: LakeTable | DeltaTable, name: str,
                    settings: StreamSettings) -> StreamingQuery:
    src = silver.read_stream(silver_columns(silver), settings.max_files_per_trigger)
    return (_writer(src, name, settings)
            .foreachBatch(lambda df, bid: upsert_dimension(df, table, name, bid)).start())


# -- gold: facts ------------------------------------------------------------------

STREAM_FACTS = {
    "fact_installs_daily": ("install", A.INSTALL_KEYS, A.installs_measures),
    "fact_revenue_daily": (["ad_revenue", "subscription"], A.REVENUE_KEYS, A.revenue_measures),
    "fact_ad_revenue_daily": ("ad_revenue", A.AD_REVENUE_KEYS, A.ad_revenue_measures),
    "fact_subscription_daily": ("subscription", A.SUBSCRIPTION_KEYS, A.subscription_measures),
    "fact_device_sketches_daily": (None, A.EVENTS_KEYS, A.device_sketch_measures),  # all kinds
}


def windowed_fact(silver_stream: DataFrame, name: str, watermark: str) -> DataFrame:
    """ST5/ST6: the fact as a daily event-time window with a watermark, so
    the state of a day is dropped once the watermark passes it."""
    kinds, keys, measures = STREAM_FACTS[name]
    rows = silver_stream if kinds is None else B.route_family(silver_stream, kinds)
    rows = (rows.withColumn("event_ts", event_time("created_at"))
            .withWatermark("event_ts", watermark))
    other = [k for k in keys if k != "event_date"]
    agg = rows.groupBy(F.window("event_ts", "1 day"), *other).agg(*measures())
    day = event_date_from_micros(F.unix_micros(F.col("window.start")))
    return agg.select(day.alias("event_date"), *other,
                      *[c for c in agg.columns if c not in ("window", *other)])


def upsert_fact(batch: DataFrame, table: LakeTable, name: str) -> None:
    """K5: replace the changed keys (update mode emits absolute values)."""
    _, keys, _ = STREAM_FACTS[name]
    batch.persist()  # read twice (touched days, then rows); no recompute of state
    try:
        table.upsert(batch, keys)
    finally:
        batch.unpersist()


def start_fact_upsert(spark: SparkSession, silver: LakeTable, table: LakeTable, name: str,
                      settings: StreamSettings, watermark: str = "2 days") -> StreamingQuery:
    src = silver.read_stream(silver_columns(silver), settings.max_files_per_trigger)
    with _started(spark, settings):
        return (_writer(windowed_fact(src, name, watermark), name, settings)
                .outputMode("update")
                .foreachBatch(lambda df, _bid: upsert_fact(df, table, name)).start())


def _of_family(rows: DataFrame, name: str) -> DataFrame:
    """The rows a fact counts (the events and device facts count all)."""
    kinds = STREAM_FACTS[name][0] if name in STREAM_FACTS else None
    return rows if kinds is None else B.route_family(rows, kinds)


def replace_days(silver_rows: DataFrame, table: LakeTable, name: str, days: list) -> None:
    """Replace the fact's ``days`` by what ``silver_rows`` (all of silver's rows
    of those days) say; a day without a row for the fact ends up empty."""
    if not days:
        return
    fact = A.FACTS[name][0](silver_rows).persist()  # an aggregate: its days, then its rows
    try:
        table.replace_partitions(fact, days)
    finally:
        fact.unpersist()


def refresh_touched_days(batch: DataFrame, silver: LakeTable, table: LakeTable, name: str) -> None:
    """ST9: recompute the days this batch touched from silver and replace
    those partitions.  Only the touched day folders of silver are listed, and
    only the fact's columns read (``LakeTable.touched``).  Values are absolute:
    late rows, replayed batches, a fresh checkpoint or a backfill in between
    all end at the same fact."""
    days = silver.touched_values(_of_family(batch, name))
    if days:
        replace_days(silver.touched(batch, days, silver_columns(silver)), table, name, days)


def refresh_touched_buckets(batch: DataFrame, silver: LakeTable, parts: LakeTable, table: LakeTable, name: str) -> None:
    """ST9 below the day: only the (day, device bucket) partitions that the
    batch touches are read from silver; ``parts`` keeps the fact within each,
    and the fact of a touched day is the sum of its parts.

    A day that ``parts`` or the fact doesn't hold yet is read whole, so that its
    parts are complete before any sum is taken; the fact is written last, which
    makes a run that dies in between repeat that.  Absolute values throughout,
    as in ``refresh_touched_days``.
    """
    replace_buckets(silver, parts, table, name, silver.touched_values(_of_family(batch, name)))


def replace_buckets(silver: LakeTable, parts: LakeTable, table: LakeTable, name: str, touched: list) -> None:
    values = {tuple(v) for v in touched}
    days = {(v[0],) for v in values}
    if not days:
        return
    known = set(parts.days()) & set(table.days())
    for day in days:
        if day[0] not in known:
            values |= set(silver.below(day))
    part = A.fact_parts(silver.touched(None, list(values), silver_columns(silver)), name).persist()
    try:
        parts.replace_partitions(part, list(values))
        columns = part.schema
    finally:
        part.unpersist()
    by_day = replace(parts, partition_by=parts.partition_by[:1])
    fact = A.fold_parts(by_day.touched(None, list(days), columns), name).persist()
    try:
        table.replace_partitions(fact, list(days))
    finally:
        fact.unpersist()


def start_fact_refresh(spark: SparkSession, silver: LakeTable, table: LakeTable, name: str,
                       settings: StreamSettings, parts: LakeTable | None = None) -> StreamingQuery:
    """With ``parts`` (silver's days split into device buckets) below the day."""
    src = silver.read_stream(silver_columns(silver), settings.max_files_per_trigger)

    def refresh(df: DataFrame, _bid: int) -> None:
        if parts is None:
            refresh_touched_days(df, silver, table, name)
        else:
            refresh_touched_buckets(df, silver, parts, table, name)

    return _writer(src, f"{name}_refresh", settings).foreachBatch(refresh).start()


# -- silver and gold in one micro-batch ------------------------------------------------

def silver_and_gold(batch: DataFrame, silver: LakeTable, dims: dict[str, LakeTable | DeltaTable],
                    facts: dict[str, LakeTable], batch_id: int = 0) -> None:
    """Silver append plus every dimension and fact, from one micro-batch of
    bronze.

    Reads bronze through its sink log and never uses silver as a streaming
    source, so no folder is listed per trigger.  Gold follows from what silver
    holds after the append: the touched days for the facts, the stored rows of
    the batch's ids for the dimensions.  A replay after a partial run, or a
    fresh checkpoint, therefore ends at the same tables.
    """
    rows = S.conform(S.dedupe_first(batch)).persist()
    try:
        days = silver.touched_values(rows)
        if not days:
            return
        silver.insert_new(rows, ["event_date", "id"], days)
        stored = silver.touched(rows, days, silver_columns(silver))
        mine = rows.select(F.col("event_date").alias("_d"), F.col("id").alias("_i"))
        on = [stored["event_date"].eqNullSafe(mine["_d"]), stored["id"].eqNullSafe(mine["_i"])]
        held = stored.join(mine, on, "left_semi").persist()
        for name, table in dims.items():
            upsert_dimension(held, table, name, batch_id)
        held.unpersist()
        for name, table in facts.items():
            replace_days(stored, table, name, days)
    finally:
        rows.unpersist()


def start_silver_and_gold(spark: SparkSession, bronze: LakeTable, silver: LakeTable,
                          dims: dict[str, LakeTable | DeltaTable], facts: dict[str, LakeTable],
                          settings: StreamSettings) -> StreamingQuery:
    src = bronze.read_stream(BRONZE_TABLE_SCHEMA, settings.max_files_per_trigger)
    return (_writer(src, "silver_and_gold", settings)
            .foreachBatch(lambda df, bid: silver_and_gold(df, silver, dims, facts, bid)).start())


# -- silver: quality, incrementally (Q1-Q11) ---------------------------------------

def start_quality(spark: SparkSession, silver: LakeTable, state: QualityState, settings: StreamSettings) -> StreamingQuery:
    """Each micro-batch of silver adds its part to the quality report."""
    src = silver.read_stream(silver_columns(silver), settings.max_files_per_trigger)
    return (_writer(src, "quality", settings)
            .foreachBatch(lambda df, bid: state.take(df, bid)).start())


# -- silver: current state per id (ST4b, streaming) --------------------------------

def upsert_current_state(batch: DataFrame, table: LakeTable | DeltaTable, key: str = "id", order: str = "lsn",
                         batch_id: int = 0) -> None:
    """Fold a batch of unwrapped changes into the current-state table.

    Latest change per key wins by log position; delete markers stay in the
    table (read through ``current_rows``) so that an older change arriving
    after a delete is ignored.  A delta table takes the batch's changes as one
    more delta.  Bucketed by key: a batch rewrites only the buckets holding
    keys it changes; new keys are appended.
    """
    if isinstance(table, DeltaTable):
        table.append(batch, batch_id)
        return
    update = bucketed(S.latest_changes(batch, key, order), key, table.buckets).persist()

    def merge(current: DataFrame, new: DataFrame) -> DataFrame:
        both = current.select(new.columns).unionByName(new).drop("bucket")
        return bucketed(S.latest_changes(both, key, order), key, table.buckets)

    try:
        table.upsert(update, [key], merge=merge)
    finally:
        update.unpersist()


def current_rows(table: LakeTable | DeltaTable, op_col: str = "op") -> DataFrame:
    """The current-state table without delete markers."""
    return table.read().where(F.col(op_col) != "d").drop("bucket")


def start_current_state(spark: SparkSession, topic: DataFrame, row: T.StructType, table: LakeTable | DeltaTable,
                        settings: StreamSettings) -> StreamingQuery:
    changes = B.unwrap_changes(topic, row)
    return (_writer(changes, "silver_current", settings)
            .foreachBatch(lambda df, bid: upsert_current_state(df, table, batch_id=bid)).start())
