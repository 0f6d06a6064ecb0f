"""Registered queries: name -> ``fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables under ``sf_dir`` (through the lazy
fixtures in ``attrlake.sources.fixtures``) and runs one operator of the
pipeline over the whole input.  Streaming queries run to completion
(``availableNow``) into a fresh folder under the shared checkpoint root and
return the table they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrlake import schemas as M
from attrlake.functions.time import ntz_to_micros
from attrlake.operators import bronze as B
from attrlake.operators import dims as D
from attrlake.operators import facts as A
from attrlake.operators import offsets as O
from attrlake.operators import quality as Q
from attrlake.operators import reports as R
from attrlake.operators import silver as S
from attrlake.session import run_dir
from attrlake.sources import fixtures as X
from attrlake.store import LakeTable
from attrlake.streaming import deltas as K
from attrlake.streaming import losses as L
from attrlake.streaming import pipeline as P
from attrlake.streaming.runner import Lake, run_jobs

Query = Callable[[SparkSession, str], DataFrame]

# Row shape of the change-log fixture.
CHANGE_ROW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
# Partition range used by the P9 query (the feature under test).
RANGE_FROM, RANGE_TO = "2024-01-10", "2024-01-19"
REDELIVER_EVERY = 7


# -- layers of the fixture pipeline --------------------------------------------

def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows as the pipeline writes them: event + ``event_date``."""
    return B.with_event_date(X.attribution_events(spark, sf_dir))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed rows (the fixture has unique ids, so no dedupe is needed)."""
    return S.conform(bronze_rows(spark, sf_dir))


def delivered_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows decoded from the topic fixture with redeliveries and
    damaged messages (the damaged ones are routed away)."""
    msgs = X.kafka_messages(spark, sf_dir, redeliver_every=REDELIVER_EVERY, corrupt=True)
    return B.good_records(B.route_messages(msgs))


def unwrapped_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.unwrap_changes(X.change_envelopes(spark, sf_dir), CHANGE_ROW)


# -- bronze ---------------------------------------------------------------------

def bronze_event_date(spark, sf_dir):
    """Partition day of every bronze row."""
    return bronze_rows(spark, sf_dir).select("id", "created_at", "event_date")


def bronze_family_filter(spark, sf_dir):
    """The ad-revenue family of bronze."""
    return B.route_family(bronze_rows(spark, sf_dir), "ad_revenue").select(
        "id", "activity_kind", "event_date", "reporting_revenue", "ad_impressions_count"
    )


def bronze_partition_range(spark, sf_dir):
    """Bronze written partitioned by day, read back for a day range (PartitionFilters)."""
    table = LakeTable(spark, run_dir(spark, "bronze"), ["event_date"])
    table.append(bronze_rows(spark, sf_dir))
    return (
        table.read()
        .where(F.col("event_date").between(F.lit(RANGE_FROM).cast("date"), F.lit(RANGE_TO).cast("date")))
        .select("id", "event_date", "activity_kind")
    )


def frame_decode_roundtrip(spark, sf_dir):
    """Frame every event, strip the header, decode, flatten; equals the source."""
    return B.decode_messages(X.kafka_messages(spark, sf_dir))


def frame_schema_id(spark, sf_dir):
    """Magic byte and schema id of every message."""
    return B.frame_header(X.kafka_messages(spark, sf_dir)).select("key", "magic_byte", "schema_id")


def cdc_unwrap(spark, sf_dir):
    """P5: unwrap every change envelope of the change log."""
    return unwrapped_changes(spark, sf_dir)


def quarantine_split(spark, sf_dir):
    """P10: route every message (with redeliveries and damage) to bronze or quarantine."""
    msgs = X.kafka_messages(spark, sf_dir, redeliver_every=REDELIVER_EVERY, corrupt=True)
    return B.route_messages(msgs).select("key", "offset", "reason")


# -- silver ---------------------------------------------------------------------

def silver_conform(spark, sf_dir):
    """Decode with the registry's types, conform to silver types, count cast errors."""
    decoded = B.decode_messages(X.kafka_messages(spark, sf_dir), M.registry_schema())
    return S.conform(decoded, with_errors=True)


def silver_dedupe(spark, sf_dir):
    """ST4a (batch): dedupe redelivered messages, conform."""
    msgs = X.kafka_messages(spark, sf_dir, redeliver_every=REDELIVER_EVERY)
    return S.conform(S.dedupe_first(B.decode_messages(msgs)))


def silver_conform_errors(spark, sf_dir):
    """Amounts of every 50th id do not fit the silver type; they become NULL and are counted."""
    decoded = B.decode_messages(X.kafka_messages(spark, sf_dir), M.registry_schema())
    amount = F.col("reporting_revenue")
    far = decoded.withColumn("reporting_revenue", F.when(F.col("id") % 50 == 0, amount + F.lit(1e15)).otherwise(amount))
    return S.conform(far, with_errors=True).select("id", "reporting_revenue", "cast_errors")


def silver_dedupe_differing(spark, sf_dir):
    """ST4a: redelivered copies that differ from the first; the first arrival wins."""
    msgs = X.kafka_messages(spark, sf_dir, redeliver_every=REDELIVER_EVERY, differing=True)
    return S.conform(S.dedupe_first(B.good_records(B.route_messages(msgs))).drop(*S.ARRIVAL))


def silver_current(spark, sf_dir):
    """ST4b (batch): last state per id of the change log, deletes applied."""
    return S.current_state(unwrapped_changes(spark, sf_dir))


# -- gold -----------------------------------------------------------------------

def _fact(name: str) -> Query:
    fn = A.FACTS[name][0]
    return lambda spark, sf_dir: fn(silver_rows(spark, sf_dir))


def dim_app(spark, sf_dir):
    """W1/K3 source: latest app attributes per app_token."""
    return D.dim_app(silver_rows(spark, sf_dir))


def dim_campaign(spark, sf_dir):
    """W1/K4 source: latest campaign attributes per tracker."""
    return D.dim_campaign(silver_rows(spark, sf_dir))


def report_star_app(spark, sf_dir):
    """Revenue per day and app joined to dim_app."""
    silver = silver_rows(spark, sf_dir)
    return R.report_star_app(A.fact_revenue_daily(silver), D.dim_app(silver))


def report_star_campaign(spark, sf_dir):
    """Installs per day and tracker joined to dim_campaign."""
    silver = silver_rows(spark, sf_dir)
    return R.report_star_campaign(A.fact_installs_daily(silver), D.dim_campaign(silver))


def report_campaign_performance(spark, sf_dir):
    """Installs, revenue, cost and revenue per install per day and tracker."""
    silver = silver_rows(spark, sf_dir)
    return R.report_campaign_performance(
        A.fact_installs_daily(silver), A.fact_revenue_daily(silver),
        A.fact_subscription_daily(silver), D.dim_campaign(silver),
    )


def report_ecpm(spark, sf_dir):
    """eCPM per day and ad network from additive sums."""
    return R.report_ecpm(A.fact_ad_revenue_daily(silver_rows(spark, sf_dir)))


def latest_events(spark, sf_dir):
    """The 20 newest silver rows."""
    return R.latest_events(silver_rows(spark, sf_dir)).select(
        "id", "activity_kind", "created_at", "app_token", "tracker", "event_date"
    )


def table_row_count(spark, sf_dir):
    """Row count of bronze."""
    return R.table_row_count(bronze_rows(spark, sf_dir))


def _stored_silver(spark, sf_dir, label: str) -> LakeTable:
    table = LakeTable(spark, run_dir(spark, label), ["event_date"])
    table.append(silver_rows(spark, sf_dir))
    return table


def latest_events_walk(spark, sf_dir):
    """T1 from the newest days only: stored silver, read back day folder by day folder."""
    return R.latest_of_table(_stored_silver(spark, sf_dir, "newest")).select(
        "id", "activity_kind", "created_at", "app_token", "tracker", "event_date"
    )


def table_row_count_footers(spark, sf_dir):
    """A6 from Parquet footers: stored silver counted without reading its pages."""
    return R.table_row_count_from_footers(_stored_silver(spark, sf_dir, "footers"))


def _devices_beside(approx: DataFrame, silver: DataFrame, by: list[str]) -> DataFrame:
    """The estimate held against the exact count: both are facts of the same rows."""
    exact = silver.groupBy(*by).agg(F.countDistinct("adid").alias("devices"))
    on = [approx[c].eqNullSafe(exact[c]) for c in by]
    near = F.abs(F.col("devices_approx") - F.col("devices")) <= F.col("devices") * 0.03
    return approx.join(exact, on).select(*[approx[c] for c in by], "events", "devices", near.alias("within_3_percent"))


def report_devices_approx(spark, sf_dir):
    """A5: devices per app and kind over all days from the sketch fact alone, held against the exact count."""
    silver = silver_rows(spark, sf_dir)
    by = ["app_token", "activity_kind"]
    return _devices_beside(R.report_devices_approx(A.fact_device_sketches_daily(silver), by), silver, by)


def quality_report_one_scan(spark, sf_dir):
    """Q1-Q11 from one scan of stored silver: counters observed while the key states are written."""
    table = _stored_silver(spark, sf_dir, "quality-silver")
    state = Q.QualityState(spark, run_dir(spark, "quality-state"))
    state.take(table.read(), 0)
    return state.report()


def quality_report(spark, sf_dir):
    """Q1-Q11 over silver."""
    return Q.quality_report(silver_rows(spark, sf_dir))


def quality_report_faults(spark, sf_dir):
    """Q1-Q11 over silver rows with faults: every rule holds for some rows and fails for others."""
    return Q.quality_report(X.faulty_silver(silver_rows(spark, sf_dir)))


def sql_views(spark, sf_dir):
    """B1: the reporting views in SQL over stored gold, read again after half of silver was written later."""
    from attrlake.batch import rebuild_dimensions, rebuild_facts
    from attrlake.plans.catalog import register_views

    _root, lake, _ckpt = _stream_run(spark, "sql-views")
    session = spark.newSession()  # the views' names are its own
    shown = Lake(session, lake.root)
    for part in _halves(spark, sf_dir):
        lake.silver.append(part)
        rebuild_facts(lake)
        rebuild_dimensions(lake)
        if not session.catalog.tableExists("report_campaign_performance"):
            register_views(session, shown)
            session.sql("select count(*) from report_campaign_performance").collect()
    return session.sql("""select p.event_date, p.tracker, p.installs, p.revenue, p.cost, c.installs as star_installs,
        (select count(*) from silver_events) as silver_rows
      from report_campaign_performance p left join report_star_campaign c using (event_date, tracker)""")


def layer_reconcile(spark, sf_dir):
    """Rows and ids per day in source, bronze and silver."""
    source = bronze_rows(spark, sf_dir)
    bronze = delivered_bronze(spark, sf_dir)
    # Only ids and days are counted: dedupe just those (and the arrival order),
    # not whole rows.
    silver = S.dedupe_first(bronze.select("id", "event_date", *S.ARRIVAL))
    return Q.layer_reconcile(source, bronze, silver)


def layer_reconcile_ids(spark, sf_dir):
    """Q12 by id: the change log's current state (deletes applied) against the silver that the damaged topic gives:
    lost and alien ids."""
    current = S.current_state(unwrapped_changes(spark, sf_dir))
    source = current.select("id", F.col("ts").cast("date").alias("event_date"))
    silver = S.dedupe_first(delivered_bronze(spark, sf_dir).select("id", "event_date", *S.ARRIVAL))
    return Q.reconcile_ids(source, silver)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "bronze_event_date": bronze_event_date,
        "bronze_family_filter": bronze_family_filter,
        "bronze_partition_range": bronze_partition_range,
        "frame_decode_roundtrip": frame_decode_roundtrip,
        "frame_schema_id": frame_schema_id,
        "cdc_unwrap": cdc_unwrap,
        "quarantine_split": quarantine_split,
        "silver_conform": silver_conform,
        "silver_dedupe": silver_dedupe,
        "silver_dedupe_differing": silver_dedupe_differing,
        "silver_conform_errors": silver_conform_errors,
        "silver_current": silver_current,
        "dim_app": dim_app,
        "dim_campaign": dim_campaign,
    }
    for name in A.FACTS:
        q[name] = _fact(name)
    q.update({
        "report_star_app": report_star_app,
        "report_star_campaign": report_star_campaign,
        "report_campaign_performance": report_campaign_performance,
        "report_ecpm": report_ecpm,
        "latest_events": latest_events,
        "table_row_count": table_row_count,
        "quality_report": quality_report,
        "quality_report_faults": quality_report_faults,
        "sql_views": sql_views,
        "layer_reconcile": layer_reconcile,
        "layer_reconcile_ids": layer_reconcile_ids,
        "latest_events_walk": latest_events_walk,
        "table_row_count_footers": table_row_count_footers,
        "report_devices_approx": report_devices_approx,
        "quality_report_one_scan": quality_report_one_scan,
    })
    return q


# -- streaming (run to completion with availableNow) ------------------------------

SLICES = 4
# Topic files per micro-batch (each slice of the topic is a few files).
TOPIC_FILES = 2
# Files per micro-batch when streaming from silver (one file per day and
# slice): several batches per run, each a later range of days.
SILVER_FILES = 8
# Bounds for larger tables, whose slices are more files (conf/jobs.yaml's values).
MOST_TOPIC_FILES, MOST_BRONZE_FILES = 64, 256
DAY_BUCKETS = 4


def _stream_run(spark: SparkSession, label: str):
    root = run_dir(spark, label)
    return root, Lake(spark, f"{root}/lake"), f"{root}/checkpoints"


def _files(least: int, pieces: int, most: int) -> int:
    """Files per micro-batch: ``least`` while a slice is one piece, in
    proportion above, so that a batch stays wide and its number of rows
    bounded (``most``, as in conf/jobs.yaml)."""
    return max(least, min(least * pieces, most))


def _topic_files(spark, sf_dir, root, corrupt: bool) -> tuple[str, int]:
    """The topic as files, written oldest offsets first (``SLICES`` appends); its pieces per slice."""
    path, n = f"{root}/topic", X.pieces(spark, sf_dir, SLICES)
    msgs = X.kafka_messages(spark, sf_dir, redeliver_every=REDELIVER_EVERY, corrupt=corrupt, spread=n)
    X.write_in_slices(msgs, path, F.col("offset"), SLICES)
    return path, n


def _silver_files(spark, sf_dir, lake: Lake) -> None:
    """Silver rows as an append-only table, written in event-time order."""
    rows = silver_rows(spark, sf_dir)
    X.write_in_slices(rows, lake.silver.location, ntz_to_micros(F.col("created_at")), SLICES,
                      partition_by=["event_date"])


def _settings(checkpoints: str, files: int | None) -> P.StreamSettings:
    return P.StreamSettings(checkpoints, {"availableNow": True}, files)


def _await(queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"{q.name}: {q.exception()}")


def _numbered_topic(spark, sf_dir, root: str, lossy: bool) -> tuple[str, int]:
    path, n = f"{root}/topic", X.pieces(spark, sf_dir, SLICES)
    X.write_in_slices(X.numbered_messages(spark, sf_dir, lossy, n), path, F.col("offset"), SLICES)
    return path, n


def bronze_offset_gaps(spark, sf_dir):
    """A topic that lost messages, streamed to bronze: the offsets that the stored messages lack."""
    root, lake, ckpt = _stream_run(spark, "offset-gaps")
    path, n = _numbered_topic(spark, sf_dir, root, True)
    files = _files(TOPIC_FILES, n, MOST_TOPIC_FILES)
    _await(P.start_bronze(P.file_topic(spark, path, files), lake.bronze, _settings(ckpt, files)))
    return O.offset_gaps(lake.messages.read())


def _bronze_run(spark, sf_dir, label: str) -> Lake:
    root, lake, ckpt = _stream_run(spark, label)
    path, n = _topic_files(spark, sf_dir, root, corrupt=True)
    files = _files(TOPIC_FILES, n, MOST_TOPIC_FILES)
    _await(P.start_bronze(P.file_topic(spark, path, files), lake.bronze, _settings(ckpt, files)))
    return lake


def stream_bronze_append(spark, sf_dir):
    """Topic files -> bronze stream (file sink) with quarantine; equals the batch form."""
    return _bronze_run(spark, sf_dir, "stream-bronze").bronze.read().select(*M.COLUMN_NAMES, "event_date")


def stream_quarantine(spark, sf_dir):
    """P10: the messages that the same query set aside, and why."""
    return _bronze_run(spark, sf_dir, "stream-quarantine").quarantine.read().select("key", "offset", "reason")


def stream_message_counts(spark, sf_dir):
    """P10: stored messages by outcome (good, tombstone, kinds of damage): none is lost unseen."""
    messages = _bronze_run(spark, sf_dir, "stream-counts").messages.read()
    return messages.groupBy("reason").agg(F.count("*").alias("messages"))


def stream_silver(spark, sf_dir):
    """S3/ST4a/K2: bronze stream -> silver (dedupe + anti-join per batch)."""
    root, lake, ckpt = _stream_run(spark, "stream-silver")
    path, n = _topic_files(spark, sf_dir, root, corrupt=False)
    files = _files(TOPIC_FILES, n, MOST_TOPIC_FILES)
    _await(P.start_bronze(P.file_topic(spark, path, files), lake.bronze, _settings(ckpt, files)))
    _await([P.start_silver(spark, lake.bronze, lake.silver, _settings(ckpt, _files(16, n, MOST_BRONZE_FILES)))])
    return lake.silver.read().select(*M.COLUMN_NAMES, "event_date")


def _silver_with_state(spark, sf_dir, label: str) -> tuple[Lake, str]:
    """Topic files with redeliveries -> bronze -> silver through the stateful job.

    A bronze batch of many files mixes days, so a silver batch that is a part
    of it could put the rest behind the watermark.  Of a larger topic silver
    therefore takes all that bronze holds in one batch (ids in RocksDB).
    """
    root, lake, ckpt = _stream_run(spark, label)
    path, n = _topic_files(spark, sf_dir, root, corrupt=False)
    files = _files(TOPIC_FILES, n, MOST_TOPIC_FILES)
    run_jobs(spark, lake, ckpt, names=["bronze.topic_to_bronze", "silver.bronze_to_silver"],
             topic=P.file_topic(spark, path, files), available_now=True,
             config={"silver.bronze_to_silver": {"mode": "state", "max_files_per_trigger": 16 if n == 1 else None,
                                                 "shuffle_partitions": 8}})
    return lake, ckpt


def stream_silver_watermark(spark, sf_dir):
    """S3/ST4a: silver by ``dropDuplicatesWithinWatermark`` into the file sink."""
    lake, _ckpt = _silver_with_state(spark, sf_dir, "stream-silver-state")
    return lake.silver.read().select(*M.COLUMN_NAMES, "event_date")


def stream_fact_events_logged(spark, sf_dir):
    """S3/ST9: the touched-day fact over silver read through its sink log."""
    lake, ckpt = _silver_with_state(spark, sf_dir, "stream-fact-logged")
    return _refreshed(spark, lake, "fact_events_daily", ckpt)


def _stream_dim(name: str) -> Query:
    def run(spark, sf_dir):
        _root, lake, ckpt = _stream_run(spark, f"stream-{name}")
        _silver_files(spark, sf_dir, lake)
        _await([P.start_dimension(spark, lake.silver, lake.dim(name), name, _settings(ckpt, SILVER_FILES))])
        return lake.dim(name).read().drop("bucket")
    return run


def _stream_fact_upsert(name: str) -> Query:
    def run(spark, sf_dir):
        _root, lake, ckpt = _stream_run(spark, f"stream-{name}")
        _silver_files(spark, sf_dir, lake)
        _await([P.start_fact_upsert(spark, lake.silver, lake.fact(name), name, _settings(ckpt, SILVER_FILES))])
        return lake.fact(name).read()
    return run


stream_fact_revenue_upsert = _stream_fact_upsert("fact_revenue_daily")


def _refreshed(spark, lake: Lake, name: str, ckpt: str, files: int = SILVER_FILES):
    """Run the default fact job over what silver holds; the stored fact."""
    _await([P.start_fact_refresh(spark, lake.silver, lake.fact(name), name, _settings(ckpt, files), lake.parts(name))])
    return lake.fact(name).read()


def _halves(spark, sf_dir):
    """Silver rows in two parts that share days (by a hash of the id)."""
    rows = silver_rows(spark, sf_dir)
    late = F.pmod(F.xxhash64("id"), F.lit(2)) == 1
    return rows.where(~late), rows.where(late)


def _stream_fact_incremental(name: str) -> Query:
    def run(spark, sf_dir):
        """The fact job run, then run again on the same checkpoint after silver grew in the same days."""
        _root, lake, ckpt = _stream_run(spark, f"stream-{name}-inc")
        for part in _halves(spark, sf_dir):
            lake.silver.append(part)
            fact = _refreshed(spark, lake, name, ckpt)
        return fact
    return run


def stream_fact_events_fresh_checkpoint(spark, sf_dir):
    """K5: the fact job run twice on one lake, with another checkpoint and batch size: nothing counts twice."""
    _root, lake, ckpt = _stream_run(spark, "stream-fact-events-fresh")
    _silver_files(spark, sf_dir, lake)
    _refreshed(spark, lake, "fact_events_daily", f"{ckpt}/first")
    return _refreshed(spark, lake, "fact_events_daily", f"{ckpt}/second", 2 * SILVER_FILES)


def stream_gold_after_backfill(spark, sf_dir):
    """K5/ST9: half of silver streamed, all days rebuilt, the other half streamed into the same days."""
    from attrlake.batch import rebuild_facts

    _root, lake, ckpt = _stream_run(spark, "stream-gold-backfill")
    early, late = _halves(spark, sf_dir)
    lake.silver.append(early)
    _refreshed(spark, lake, "fact_events_daily", ckpt)
    rebuild_facts(lake)
    lake.silver.append(late)
    return _refreshed(spark, lake, "fact_events_daily", ckpt)


def stream_fact_day_emptied(spark, sf_dir):
    """ST9: installs of the first install day leave silver and that day is rebuilt; it leaves the fact."""
    from attrlake.batch import rebuild_facts

    _root, lake, ckpt = _stream_run(spark, "stream-fact-emptied")
    _silver_files(spark, sf_dir, lake)
    first = _refreshed(spark, lake, "fact_installs_daily", ckpt).agg(F.min("event_date")).first()[0]
    day = lake.silver.read().where(F.col("event_date") == F.lit(first))
    kept = day.where("activity_kind is distinct from 'install'")
    path = run_dir(spark, "emptied-day")
    kept.write.parquet(path)
    lake.silver.replace_partitions(spark.read.schema(kept.schema).parquet(path), [(first,)])
    rebuild_facts(lake, [str(first)])
    return lake.fact("fact_installs_daily").read()


def stream_fact_revenue_late(spark, sf_dir):
    """ST6: the newest rows come first and all others late; with default settings none is lost."""
    _root, lake, ckpt = _stream_run(spark, "stream-fact-late")
    X.write_in_slices(silver_rows(spark, sf_dir), lake.silver.location, -ntz_to_micros(F.col("created_at")), SLICES,
                      partition_by=["event_date"])
    run_jobs(spark, lake, ckpt, names=["gold.fact_revenue_daily"], available_now=True,
             config={"gold.fact_revenue_daily": {"max_files_per_trigger": SILVER_FILES}})
    return lake.fact("fact_revenue_daily").read()


def stream_fact_device_sketches_upsert(spark, sf_dir):
    """A5 as a windowed stream of device sketches, each held against the exact count of its key."""
    _root, lake, ckpt = _stream_run(spark, "stream-sketches")
    _silver_files(spark, sf_dir, lake)
    name = "fact_device_sketches_daily"
    _await([P.start_fact_upsert(spark, lake.silver, lake.fact(name), name, _settings(ckpt, SILVER_FILES))])
    fact = lake.fact(name).read()
    return _devices_beside(R.report_devices_approx(fact, A.EVENTS_KEYS), silver_rows(spark, sf_dir), A.EVENTS_KEYS)


def stream_quality_report(spark, sf_dir):
    """Q1-Q11 incrementally: each micro-batch of silver adds its key states and counters; the report folds them."""
    root, lake, ckpt = _stream_run(spark, "stream-quality")
    _silver_files(spark, sf_dir, lake)
    state = Q.QualityState(spark, f"{root}/quality")
    _await([P.start_quality(spark, lake.silver, state, _settings(ckpt, 4 * SILVER_FILES))])
    return state.report()


def _newest_first(spark, sf_dir, label: str, name: str):
    """Silver arrives newest slice first, each slice one micro-batch: the split and the windowed fact after each."""
    _root, lake, ckpt = _stream_run(spark, label)
    split = L.Split(spark, f"{lake.root}/gold/{name}_split")

    def after_slice() -> None:
        _await([L.start_late_split(spark, lake.silver, split, name, _settings(ckpt, None))])
        _await([L.start_fact_of_timely(spark, split, lake.fact(name), name, _settings(ckpt, None))])

    X.write_in_slices(silver_rows(spark, sf_dir), lake.silver.location, -ntz_to_micros(F.col("created_at")), SLICES,
                      partition_by=["event_date"], after=after_slice)
    return lake, split


def stream_late_rows(spark, sf_dir):
    """ST6: every row that the windowed revenue fact would drop behind its watermark, kept in a table."""
    _lake, split = _newest_first(spark, sf_dir, "stream-late", "fact_revenue_daily")
    return split.late.read().select("id", "event_date", "activity_kind", "reason")


def stream_fact_revenue_timely(spark, sf_dir):
    """ST5/ST6: the windowed fact over the rows in time; with the late rows it makes the whole."""
    lake, _split = _newest_first(spark, sf_dir, "stream-timely", "fact_revenue_daily")
    return lake.fact("fact_revenue_daily").read()


def stream_fact_events_refresh(spark, sf_dir):
    """ST9: touched-day recompute of fact_events_daily from silver."""
    _root, lake, ckpt = _stream_run(spark, "stream-fact-events")
    _silver_files(spark, sf_dir, lake)
    return _refreshed(spark, lake, "fact_events_daily", ckpt)


def _stream_fact_buckets(name: str) -> Query:
    def run(spark, sf_dir):
        """ST9 below the day: the fact from its device-bucket parts, silver growing in the same days between two runs."""
        root, lake, ckpt = _stream_run(spark, f"stream-{name}-buckets")
        lake = replace(lake, day_buckets=DAY_BUCKETS)
        for part in _halves(spark, sf_dir):
            lake.silver.append(P.placed_in(part, lake.silver))
            fact = _refreshed(spark, lake, name, ckpt, 100_000)
        return fact
    return run


def stream_silver_current(spark, sf_dir):
    """ST4b (stream): change-envelope topic -> current state per id."""
    root, lake, ckpt = _stream_run(spark, "stream-current")
    path = f"{root}/changes"
    n = X.pieces(spark, sf_dir, SLICES)
    X.write_in_slices(X.change_envelopes(spark, sf_dir, n), path, F.col("offset"), SLICES)
    files = _files(4, n, MOST_TOPIC_FILES)
    table = P.dim_table(spark, f"{root}/lake/silver/current")
    _await([P.start_current_state(spark, P.file_topic(spark, path, files), CHANGE_ROW, table, _settings(ckpt, files))])
    return P.current_rows(table)


def stream_silver_current_delta(spark, sf_dir):
    """ST4b/ST8 (appended deltas): change topic -> current state per id; a batch adds files and rewrites none,
    every third one compacts."""
    root, lake, ckpt = _stream_run(spark, "stream-current-delta")
    path = f"{root}/changes"
    n = X.pieces(spark, sf_dir, SLICES)
    X.write_in_slices(X.change_envelopes(spark, sf_dir, n), path, F.col("offset"), SLICES)
    files = _files(4, n, MOST_TOPIC_FILES)
    table = K.current_state_table(spark, lake.current.location, compact_every=3)
    _await([P.start_current_state(spark, P.file_topic(spark, path, files), CHANGE_ROW, table, _settings(ckpt, files))])
    return P.current_rows(table)


def _stream_dim_delta(name: str) -> Query:
    def run(spark, sf_dir):
        """K3/K4 (appended deltas): the dimension job on a delta table, compacted every fourth batch."""
        root, lake, ckpt = _stream_run(spark, f"stream-{name}-delta")
        _silver_files(spark, sf_dir, lake)
        lake = Lake(spark, lake.root, keyed="deltas", compact_every=4)
        _await([P.start_dimension(spark, lake.silver, lake.dim(name), name, _settings(ckpt, SILVER_FILES))])
        return lake.dim(name).read()
    return run


def stream_bronze_to_gold(spark, sf_dir):
    """Combined job: bronze -> silver + dims + facts in one micro-batch."""
    root, lake, ckpt = _stream_run(spark, "stream-bronze-gold")
    path, n = _topic_files(spark, sf_dir, root, corrupt=False)
    files = _files(TOPIC_FILES, n, MOST_TOPIC_FILES)
    topic = P.file_topic(spark, path, files)
    run_jobs(spark, lake, ckpt, names=["bronze.topic_to_bronze", "silver.bronze_to_silver_and_gold"],
             topic=topic, available_now=True,
             config={"bronze.topic_to_bronze": {"max_files_per_trigger": files},
                     "silver.bronze_to_silver_and_gold": {"max_files_per_trigger": _files(48, n, MOST_BRONZE_FILES)}})
    return lake.fact("fact_events_daily").read()


def stream_all_layers(spark, sf_dir):
    """ST10: every default job, layer by layer; the stored layers reconciled."""
    root, lake, ckpt = _stream_run(spark, "stream-all")
    path, n = _topic_files(spark, sf_dir, root, corrupt=True)
    files = _files(TOPIC_FILES, n, MOST_TOPIC_FILES)
    topic = P.file_topic(spark, path, files)
    config = {"bronze.topic_to_bronze": {"max_files_per_trigger": files},
              "silver.bronze_to_silver": {"max_files_per_trigger": _files(16, n, MOST_BRONZE_FILES)}}
    run_jobs(spark, lake, ckpt, topic=topic, available_now=True, config=config)
    bronze = lake.bronze.read()
    return Q.layer_reconcile(bronze_rows(spark, sf_dir), bronze, lake.silver.read())


STREAM_QUERIES: dict[str, Query] = {
    "stream_bronze_append": stream_bronze_append,
    "bronze_offset_gaps": bronze_offset_gaps,
    "stream_quarantine": stream_quarantine,
    "stream_message_counts": stream_message_counts,
    "stream_silver": stream_silver,
    "stream_fact_events_buckets": _stream_fact_buckets("fact_events_daily"),
    "stream_fact_revenue_buckets": _stream_fact_buckets("fact_revenue_daily"),
    "stream_silver_watermark": stream_silver_watermark,
    "stream_fact_events_logged": stream_fact_events_logged,
    "stream_silver_current": stream_silver_current,
    "stream_silver_current_delta": stream_silver_current_delta,
    "stream_dim_app_delta": _stream_dim_delta("dim_app"),
    "stream_dim_campaign_delta": _stream_dim_delta("dim_campaign"),
    "stream_dim_app_upsert": _stream_dim("dim_app"),
    "stream_dim_campaign_upsert": _stream_dim("dim_campaign"),
    "stream_fact_revenue_upsert": stream_fact_revenue_upsert,
    "stream_fact_installs_upsert": _stream_fact_upsert("fact_installs_daily"),
    "stream_fact_ad_revenue_upsert": _stream_fact_upsert("fact_ad_revenue_daily"),
    "stream_fact_subscription_upsert": _stream_fact_upsert("fact_subscription_daily"),
    "stream_fact_revenue_incremental": _stream_fact_incremental("fact_revenue_daily"),
    "stream_fact_events_refresh": stream_fact_events_refresh,
    "stream_fact_events_incremental": _stream_fact_incremental("fact_events_daily"),
    "stream_fact_events_fresh_checkpoint": stream_fact_events_fresh_checkpoint,
    "stream_gold_after_backfill": stream_gold_after_backfill,
    "stream_fact_day_emptied": stream_fact_day_emptied,
    "stream_fact_revenue_late": stream_fact_revenue_late,
    "stream_fact_device_sketches_upsert": stream_fact_device_sketches_upsert,
    "stream_quality_report": stream_quality_report,
    "stream_late_rows": stream_late_rows,
    "stream_fact_revenue_timely": stream_fact_revenue_timely,
    "stream_bronze_to_gold": stream_bronze_to_gold,
    "stream_all_layers": stream_all_layers,
}


def all_queries() -> dict[str, Query]:
    return {**queries(), **STREAM_QUERIES}
