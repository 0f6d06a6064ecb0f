"""Losses that stop a stream or are kept: offsets, late rows, cast errors, failed queries."""

import random

import pytest
from pyspark.sql import functions as F

from attrlake.functions.time import ntz_to_micros
from attrlake.operators import bronze as B
from attrlake.operators import offsets as O
from attrlake.operators import quality as Q
from attrlake.operators import silver as S
from attrlake.plans import queries as Qy
from attrlake.schemas import bronze_schema, registry_schema
from attrlake.session import run_dir
from attrlake.sources import fixtures as X
from attrlake.store import LakeTable
from attrlake.streaming import losses as L
from attrlake.streaming import pipeline as P
from attrlake.streaming import runner as R
from attrlake.streaming.runner import Lake, run_jobs

from conftest import SF_SMALL


def _wait(qs):
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None


def _settings(ckpt, **more):
    return P.StreamSettings(ckpt, {"availableNow": True}, **more)


def _runs(numbers):
    out = []
    for n in sorted(set(numbers)):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(r) for r in out]


def test_islands_and_gaps_are_brute_force(spark):
    draw = random.Random(4)
    held = {0: list(range(70_000)), 1: [n for n in range(100_000) if draw.random() > 0.01],
            2: [5, 5, 6, 40_000, 32_768, 32_769], 3: [n for n in range(66_000) if not 32_760 <= n <= 32_780] * 2}
    rows = spark.createDataFrame([(p, n) for p, ns in held.items() for n in ns] + [(None, 1), (1, None)],
                                 "source_partition int, source_offset bigint").repartition(5)
    want = {p: _runs(ns) for p, ns in held.items()}
    assert {tuple(r) for r in O.islands(rows).collect()} == {(p, a, b) for p, rs in want.items() for a, b in rs}
    gaps = {(p, x[1] + 1, y[0] - 1, y[0] - x[1] - 1) for p, rs in want.items() for x, y in zip(rs, rs[1:])}
    assert {tuple(r) for r in O.offset_gaps(rows).collect()} == gaps


def _guarded(spark, lossy, label):
    root = run_dir(spark, label)
    X.write_in_slices(X.numbered_messages(spark, SF_SMALL, lossy), f"{root}/topic", F.col("offset"), 3)
    run_jobs(spark, Lake(spark, f"{root}/lake"), f"{root}/ck", names=["bronze.topic_to_bronze"],
             topic=P.file_topic(spark, f"{root}/topic", 2), available_now=True,
             config={"bronze.topic_to_bronze": {"offset_patience": 50}})
    return root


def test_a_gapless_topic_passes_and_a_lossy_one_stops(spark):
    _guarded(spark, False, "t-gapless")
    with pytest.raises(L.LostOffsets, match="offsets lost: partition"):
        _guarded(spark, True, "t-lossy")


def test_a_removed_file_stops_the_query(spark):
    root = run_dir(spark, "t-removed")
    msgs = X.numbered_messages(spark, SF_SMALL)
    for k in range(3):  # one file a slice: each partition in order
        msgs.where((F.col("offset") >= 90 * k) & (F.col("offset") < 90 * (k + 1))).coalesce(1).write.mode("append").parquet(f"{root}/{k}")
    topic = f"{root}/topic"
    for k in (0, 2):  # the middle one is gone
        spark.read.parquet(f"{root}/{k}").coalesce(1).write.mode("append").parquet(topic)
    guard = L.start_offset_guard(P.file_topic(spark, topic, 1), f"{root}/runs", _settings(f"{root}/ck"))
    with pytest.raises(Exception, match="offsets lost"):
        guard.awaitTermination()


def test_a_hole_may_fill_within_the_patience_and_a_replay_changes_nothing(spark):
    state = run_dir(spark, "t-patience")
    frame = lambda ns: spark.createDataFrame([(0, n) for n in ns], "partition int, offset bigint")
    L.guard_offsets(frame([0, 1, 5, 6]), 0, state, patience=1)
    with pytest.raises(L.LostOffsets):
        L.check_offsets(spark, state)
    L.guard_offsets(frame([2, 3, 4, 10]), 1, state, patience=1)
    L.guard_offsets(frame([2, 3, 4, 10]), 1, state, patience=1)  # replayed
    L.guard_offsets(frame([7, 8, 9]), 2, state, patience=1)
    L.check_offsets(spark, state)
    with pytest.raises(L.LostOffsets, match="12 to 19"):
        L.guard_offsets(frame([11, 20]), 3, state, patience=0)


def _slices(spark, lake, after):
    X.write_in_slices(Qy.silver_rows(spark, SF_SMALL), lake.silver.location, -ntz_to_micros(F.col("created_at")), 4,
                      partition_by=["event_date"], after=after)


def test_the_split_keeps_what_the_window_drops(spark):
    """The windowed fact straight over silver loses the late rows; the one behind the split loses none of its own."""
    name = "fact_revenue_daily"
    lake = Lake(spark, run_dir(spark, "t-late"))
    split, straight, behind = L.Split(spark, f"{lake.root}/split"), LakeTable(spark, f"{lake.root}/a", ["event_date"]), lake.fact(name)
    dropped = {"straight": 0, "behind": 0}

    def after():
        _wait([L.start_late_split(spark, lake.silver, split, name, _settings(f"{lake.root}/ck1"))])
        for key, q in (("straight", P.start_fact_upsert(spark, lake.silver, straight, name, _settings(f"{lake.root}/ck2"))),
                       ("behind", L.start_fact_of_timely(spark, split, behind, name, _settings(f"{lake.root}/ck3")))):
            _wait([q])
            dropped[key] += P.rows_dropped_by_watermark(q)

    _slices(spark, lake, after)
    assert dropped["straight"] > 0 and dropped["behind"] == 0
    same = lambda t: sorted(map(tuple, t.read().select(sorted(t.read().columns)).collect()), key=str)
    assert same(straight) == same(behind)
    rows = Qy.silver_rows(spark, SF_SMALL).where("activity_kind in ('ad_revenue', 'subscription')")
    late, timely = split.late.read(), split.timely.read()
    assert late.count() > 0 and late.count() + timely.count() == rows.count()
    assert late.select("id").unionByName(timely.select("id")).distinct().count() == rows.count()


def test_a_replayed_split_and_rows_without_event_time(spark):
    split = L.Split(spark, run_dir(spark, "t-split"))
    rows = Qy.silver_rows(spark, SF_SMALL)
    day = F.col("event_date")
    new, old = rows.where(day >= "2024-01-20"), rows.where(day < "2024-01-10").withColumn(
        "created_at", F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("created_at")))
    split.take(new, 0, 2 * L.DAY_US)
    for _ in range(2):
        split.take(old, 1, 2 * L.DAY_US)
    assert split.timely.read().count() == new.count() and split.late.read().count() == old.count()
    assert {r.reason for r in split.late.read().select("reason").distinct().collect()} == {"late", "no_event_time"}


def test_cast_errors_and_late_drops_are_rows_of_a_table(spark):
    root = run_dir(spark, "t-records")
    lake = Lake(spark, f"{root}/lake")
    decoded = B.decode_messages(X.kafka_messages(spark, SF_SMALL), registry_schema())
    far = decoded.withColumn("reporting_revenue", F.when(F.col("id") % 50 == 0, F.lit(1e15)).otherwise(F.col("reporting_revenue")))
    stored = far.withColumns({"source_partition": F.lit(0), "source_offset": F.col("id"), "reason": F.lit(B.GOOD)})
    lake.messages.append(stored)
    records = L.LossRecords(LakeTable(spark, f"{root}/losses"))
    spark.streams.addListener(records)
    try:
        queries = [P.start_silver(spark, lake.bronze, lake.silver, _settings(f"{root}/ck"), stored.schema)]
        _wait(queries)
        R._reported(spark, records, queries)
        q = None

        def after():
            nonlocal q
            q = P.start_fact_upsert(spark, Lake(spark, f"{root}/two").silver, LakeTable(spark, f"{root}/f", ["event_date"]),
                                    "fact_revenue_daily", _settings(f"{root}/ck2"))
            _wait([q])

        _slices(spark, Lake(spark, f"{root}/two"), after)
        R._reported(spark, records, [q])
    finally:
        spark.streams.removeListener(records)
    table = records.table.read()
    wrong = S.conform(far, with_errors=True).agg(F.sum("cast_errors")).first()[0]
    assert wrong > 0
    assert table.where("query like 'silver%'").agg(F.sum("cast_errors"), F.sum("checked_rows")).first() == (wrong, far.count())
    assert table.where("query like 'fact_revenue%'").agg(F.sum("late_dropped")).first()[0] > 0


@pytest.mark.parametrize("on_failure", ["stop", "continue"])
def test_a_failed_query_is_named_and_stops_or_spares_the_others(spark, on_failure):
    root = run_dir(spark, f"t-supervise-{on_failure}")
    spark.range(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("id bigint").parquet(f"{root}/in")

    def fail(df, _):
        raise ValueError("no luck")

    bad = stream.writeStream.queryName("bad").option("checkpointLocation", f"{root}/a").foreachBatch(fail).start()
    good = (stream.writeStream.queryName("good").option("checkpointLocation", f"{root}/b")
            .trigger(processingTime="1 second").foreachBatch(lambda df, _: df.count()).start())
    seen = []
    if on_failure == "continue":
        import threading
        timer = threading.Timer(8, lambda: (seen.append(good.isActive), good.stop()))
        timer.start()
    with pytest.raises(RuntimeError, match="'bad'.*|no luck"):
        R.supervise(spark, [bad, good], on_failure, every_seconds=1)
    assert not good.isActive and good.exception() is None
    assert seen == ([True] if on_failure == "continue" else [])


def test_ids_are_reconciled_one_by_one_only_where_digests_differ(spark):
    schema = "id bigint, event_date date"
    import datetime as dt
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    source = [(k, day) for k in range(500)] + [(k, None) for k in range(500, 520)] + [(600, day)]
    target = [(k, day) for k in range(1, 500)] + [(k, None) for k in range(500, 520)] + [(777, day), (600, other), (3, day)]
    frames = [spark.createDataFrame(rows, schema) for rows in (source, target)]
    got = {(r.id, r.event_date, r.kind) for r in Q.reconcile_ids(*frames).collect()}
    assert got == {(0, day, "lost"), (777, day, "alien"), (600, day, "lost"), (600, other, "alien"), (3, day, "repeated")}
    assert Q.reconcile_ids(frames[0], frames[0]).collect() == []
    assert [r.kind for r in Q.reconcile_ids(frames[0], frames[0].where("false")).select("kind").distinct().collect()] == ["lost"]


def test_a_failed_query_starts_again_alone_and_is_given_up_at_last(spark):
    """``flaky`` fails twice and then works; ``hopeless`` never does."""
    root = run_dir(spark, "t-restart-query")
    spark.range(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("id bigint").parquet(f"{root}/in")
    tries, counted, pools = {"flaky": 0, "hopeless": 0}, [], set()

    def batch(name, fails):
        def run(df, _):
            tries[name] += 1
            pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
            if tries[name] <= fails:
                raise ValueError("no luck")
            counted.append(df.count())
        return run

    def starter(name, fails):
        def start():
            return (stream.writeStream.queryName(name).option("checkpointLocation", f"{root}/{name}")
                    .trigger(availableNow=True).foreachBatch(batch(name, fails)).start())
        return lambda: R._in_pool(spark, f"pool-{name}", lambda: [start()])[0]

    starters = {"flaky": starter("flaky", 2), "hopeless": starter("hopeless", 99)}
    again = R.Restarts(starters, limit=3, delay=0.1)
    with pytest.raises(RuntimeError, match="'hopeless'") as failed:
        R.supervise(spark, [s() for s in starters.values()], "restart", every_seconds=1, restarts=again)
    assert "flaky" not in str(failed.value)
    assert tries == {"flaky": 3, "hopeless": 4} and counted == [3]
    assert pools == {"pool-flaky", "pool-hopeless"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_restarts_are_counted_within_a_window():
    again = R.Restarts({"q": lambda: None}, limit=2, delay=0, window=0.2)
    assert again.planned("q") and again.planned("q") and not again.planned("q") and not again.planned("other")
    R.time.sleep(0.25)
    assert again.planned("q")
