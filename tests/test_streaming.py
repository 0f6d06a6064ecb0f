"""Streaming semantics: restart, replayed batches, late data, upserts."""

from pyspark.sql import functions as F

from attrlake.functions.time import ntz_to_micros
from attrlake.operators import facts as A
from attrlake.plans import queries as Qy
from attrlake.session import run_dir
from attrlake.sources import fixtures as X
from attrlake.store import LakeTable
from attrlake.streaming import pipeline as P
from attrlake.streaming.runner import Lake

from conftest import SF_SMALL


def _wait(qs):
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None


def _settings(ckpt, files=1):
    return P.StreamSettings(ckpt, {"availableNow": True}, files)


def test_bronze_restart_adds_no_rows(spark):
    root = run_dir(spark, "t-restart")
    lake = Lake(spark, f"{root}/lake")
    msgs = X.kafka_messages(spark, SF_SMALL, redeliver_every=7)
    X.write_in_slices(msgs, f"{root}/topic", F.col("offset"), 3)
    for _ in range(2):  # second run: same checkpoint, nothing new
        _wait(P.start_bronze(P.file_topic(spark, f"{root}/topic", 1), lake.bronze, _settings(f"{root}/ck")))
        assert lake.bronze.read().count() == msgs.count()


def test_silver_replayed_batch_is_harmless(spark):
    root = run_dir(spark, "t-replay")
    silver = LakeTable(spark, f"{root}/silver", ["event_date"])
    batch = Qy.bronze_rows(spark, SF_SMALL)
    P.append_new_to_silver(batch, silver)
    P.append_new_to_silver(batch.unionByName(batch), silver)  # replay, with copies
    assert silver.read().count() == batch.count()
    assert silver.read().select("id").distinct().count() == batch.count()


def test_fact_upsert_replaces_and_is_idempotent(spark):
    root = run_dir(spark, "t-upsert")
    table = LakeTable(spark, f"{root}/fact", ["event_date"])
    silver = Qy.silver_rows(spark, SF_SMALL)
    fact = A.fact_ad_revenue_daily(silver)  # ad_mediation_platform is NULL in every key
    P.upsert_fact(fact, table, "fact_ad_revenue_daily")
    P.upsert_fact(fact, table, "fact_ad_revenue_daily")
    got = table.read()
    assert got.count() == fact.count()
    assert got.agg(F.sum("events")).first()[0] == fact.agg(F.sum("events")).first()[0]


def test_dimension_out_of_order_batches_do_not_roll_back(spark):
    root = run_dir(spark, "t-dim")
    table = P.dim_table(spark, f"{root}/dim")
    silver = Qy.silver_rows(spark, SF_SMALL)
    cut = silver.agg(F.percentile_approx(ntz_to_micros(F.col("created_at")), 0.5)).first()[0]
    newer = silver.where(ntz_to_micros(F.col("created_at")) > cut)
    older = silver.where(ntz_to_micros(F.col("created_at")) <= cut)
    P.upsert_dimension(newer, table, "dim_app")
    P.upsert_dimension(older, table, "dim_app")  # arrives late
    got = {r.app_token: (r.last_id, r.first_seen) for r in table.read().collect()}
    want = {r.app_token: (r.last_id, r.first_seen) for r in Qy.dim_app(spark, SF_SMALL).collect()}
    assert got == want


def test_short_watermark_drops_late_rows_on_shuffled_input(spark):
    root = run_dir(spark, "t-late")
    lake = Lake(spark, f"{root}/lake")
    rows = Qy.silver_rows(spark, SF_SMALL)
    # newest slice first: everything after it is late for a 1-hour watermark
    X.write_in_slices(rows, lake.silver.location, -ntz_to_micros(F.col("created_at")), 3)
    name = "fact_revenue_daily"
    settings = P.StreamSettings(f"{root}/ck", {"availableNow": True}, 1, shuffle_partitions=3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = P.start_fact_upsert(spark, lake.silver, lake.fact(name), name, settings, watermark="1 hour")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # per query, not session-wide
    _wait([q])
    streamed = lake.fact(name).read().agg(F.sum("events")).first()[0]
    batch = A.fact_revenue_daily(rows).agg(F.sum("events")).first()[0]
    assert 0 < streamed < batch
    assert P.rows_dropped_by_watermark(q) > 0


def _same_fact(lake, silver, name="fact_events_daily"):
    want, got = A.FACTS[name][0](silver), lake.fact(name).read()
    return got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0


def test_refreshed_fact_is_exact_under_replay_and_late_rows(spark):
    lake = Lake(spark, run_dir(spark, "t-events-refresh"))
    silver = Qy.silver_rows(spark, SF_SMALL)
    cut = silver.agg(F.percentile_approx(ntz_to_micros(F.col("created_at")), 0.5)).first()[0]
    newer = silver.where(ntz_to_micros(F.col("created_at")) > cut)
    older = silver.where(ntz_to_micros(F.col("created_at")) <= cut)
    fact = lake.fact("fact_events_daily")
    lake.silver.append(newer)
    for _ in range(2):  # the second run replays the batch
        P.refresh_touched_days(newer, lake.silver, fact, "fact_events_daily")
    lake.silver.append(older)
    P.refresh_touched_days(older, lake.silver, fact, "fact_events_daily")  # late rows for older days
    assert _same_fact(lake, silver)


def test_refresh_after_a_separate_silver_job_and_with_rows_without_a_day(spark):
    """Silver written by its own job, then the combined job on the same lake;
    rows without ``created_at`` have a null day."""
    from attrlake.streaming.runner import gold_targets

    lake = Lake(spark, run_dir(spark, "t-mixed-jobs"))
    dims, facts = gold_targets(lake)
    bronze = Qy.bronze_rows(spark, SF_SMALL)
    no_day = (F.col("id") % 5 == 0)
    for c in ("created_at", "event_date"):
        bronze = bronze.withColumn(c, F.when(~no_day, F.col(c)))
    P.append_new_to_silver(bronze.where(F.col("id") % 2 == 0), lake.silver)
    P.silver_and_gold(bronze, lake.silver, dims, facts)
    silver = lake.silver.read()
    assert silver.count() == bronze.count()
    for name in A.FACTS:
        assert _same_fact(lake, silver, name), name


def test_current_state_ignores_changes_older_than_a_delete(spark):
    root = run_dir(spark, "t-current")
    table = P.dim_table(spark, f"{root}/current")
    schema = "op string, id bigint, value double, lsn bigint"
    mk = lambda rows: spark.createDataFrame(rows, schema)
    P.upsert_current_state(mk([("c", 1, 1.0, 10), ("c", 2, 5.0, 20)]), table)
    P.upsert_current_state(mk([("d", 1, None, 12)]), table)
    P.upsert_current_state(mk([("u", 1, 2.0, 11), ("u", 2, 6.0, 21)]), table)  # 11 is older than the delete
    P.upsert_current_state(mk([("u", 2, 6.0, 21)]), table)  # replay
    got = sorted((r.id, r.value, r.lsn) for r in P.current_rows(table).collect())
    assert got == [(2, 6.0, 21)]


def test_silver_and_gold_in_one_batch_is_exact_after_a_partial_run(spark):
    from attrlake.operators import dims as D
    from attrlake.operators import silver as S
    from attrlake.streaming.runner import gold_targets

    root = run_dir(spark, "t-combined")
    lake = Lake(spark, f"{root}/lake")
    dims, facts = gold_targets(lake)
    bronze = Qy.bronze_rows(spark, SF_SMALL)
    micros = F.col("created_at")
    cut = bronze.agg(F.percentile_approx(micros, 0.5)).first()[0]
    first, second = bronze.where(micros <= cut), bronze.where(micros > cut)
    # the first batch crashed after its silver append, before any gold table was written
    lake.silver.insert_new(S.conform(first), ["event_date", "id"])
    P.silver_and_gold(first, lake.silver, dims, facts)            # the replay
    P.silver_and_gold(second.unionByName(first.where(F.col("id") % 7 == 0)), lake.silver, dims, facts)
    P.silver_and_gold(second, lake.silver, dims, facts)           # replayed again
    silver = Qy.silver_rows(spark, SF_SMALL)
    assert lake.silver.read().count() == silver.count()
    for name, (fn, _keys) in A.FACTS.items():
        want, got = fn(silver), lake.fact(name).read()
        assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0, name
    want = D.dim_campaign(silver)
    assert lake.dim("dim_campaign").read().select(*want.columns).exceptAll(want).count() == 0


def test_files_per_partition_bounds_stream_output_files(spark):
    root = run_dir(spark, "t-files")
    msgs = X.kafka_messages(spark, SF_SMALL, redeliver_every=7).repartition(6)
    msgs.write.parquet(f"{root}/topic")  # 6 files
    counts = {}
    for n in (None, 2):
        lake = Lake(spark, f"{root}/lake-{n}", files_per_partition=n)
        _wait(P.start_bronze(P.file_topic(spark, f"{root}/topic"), lake.bronze, _settings(f"{root}/ck-{n}", None)))
        files = lake.bronze.read().inputFiles()
        days = lake.bronze.read().select("event_date").distinct().count()
        counts[n] = (len(files), days)
        assert lake.bronze.read().count() == msgs.count()
    (map_side, days), (salted, _) = counts[None], counts[2]
    assert salted <= 2 * days < map_side
