"""Facts refreshed below the day, and silver with state read through its sink log."""

import io
from contextlib import redirect_stdout
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from attrlake.batch import rebuild_facts
from attrlake.operators import facts as A
from attrlake.plans import queries as Qy
from attrlake.session import run_dir
from attrlake.sources import fixtures as X
from attrlake.streaming import pipeline as P
from attrlake.streaming.runner import Lake, run_jobs

from conftest import SF_SMALL


def _rows(df):
    cols = sorted(df.columns)
    return sorted(map(repr, df.select(*cols).collect()))


def test_parts_of_every_fact_add_up(spark):
    silver = Qy.silver_rows(spark, SF_SMALL)
    no_device = silver.limit(20).withColumns({"adid": F.lit(None).cast("string"), "id": F.col("id") + 10_000_000})
    silver = silver.unionByName(no_device).withColumn("bucket", A.device_bucket(7)).persist()
    assert silver.select("bucket").distinct().count() == 7
    for name, (fn, _keys) in A.FACTS.items():
        want = fn(silver)
        got = A.fold_parts(A.fact_parts(silver, name), name)
        assert dict(got.dtypes) == dict(want.dtypes)
        assert _rows(got) == _rows(want), name
    silver.unpersist()


def test_one_late_row_reads_its_bucket_only(spark):
    lake = Lake(spark, run_dir(spark, "t-buckets"), day_buckets=100)
    name, fact = "fact_events_daily", A.fact_events_daily
    rows = Qy.silver_rows(spark, SF_SMALL)
    busy = rows.groupBy("event_date").count().orderBy(F.desc("count")).first()[0]
    # One day that fills every bucket.
    day = rows.where(F.col("event_date") == F.lit(busy)).crossJoin(spark.range(40).withColumnRenamed("id", "k"))
    day = day.withColumns({"id": F.col("id") + F.col("k") * 1_000_000, "adid": F.concat_ws("-", "adid", F.col("k"))}).drop("k")
    lake.silver.append(P.placed_in(day, lake.silver))
    first = P.placed_in(day, lake.silver)
    P.refresh_touched_buckets(first, lake.silver, lake.parts(name), lake.fact(name), name)
    late = P.placed_in(day.limit(1).withColumn("id", F.col("id") + 500_000_000), lake.silver).persist()
    lake.silver.append(late)

    values = lake.silver.touched_values(late)
    read = lake.silver.touched(None, values, P.silver_columns(lake.silver))
    assert len(lake.silver.below((busy,))) > 95
    assert read.select("bucket").distinct().count() == 1
    assert read.count() < 0.05 * lake.silver.read().count()
    before = {p: set(lake.parts(name).touched(None, [p]).inputFiles()) for p in lake.parts(name).below((busy,))}
    for _ in range(2):  # the second run replays the batch
        P.refresh_touched_buckets(late, lake.silver, lake.parts(name), lake.fact(name), name)
        after = {p: set(lake.parts(name).touched(None, [p]).inputFiles()) for p in lake.parts(name).below((busy,))}
        assert [p for p in before if before[p] != after[p]] == [tuple(values[0])]
        assert _rows(lake.fact(name).read()) == _rows(fact(lake.silver.read()))


def test_a_day_without_complete_parts_is_read_whole(spark):
    """Parts that were never written, a fact that is not there, a rebuild in
    between: the fact stays that of all of silver."""
    lake = Lake(spark, run_dir(spark, "t-buckets-fresh"), day_buckets=5)
    rows = P.placed_in(Qy.silver_rows(spark, SF_SMALL), lake.silver).persist()
    lake.silver.append(rows)
    one = rows.where("activity_kind = 'install'").limit(1).persist()
    day = one.first()["event_date"]
    name = "fact_installs_daily"
    P.refresh_touched_buckets(one, lake.silver, lake.parts(name), lake.fact(name), name)
    of_day = lake.silver.read().where(F.col("event_date") == F.lit(day))
    assert _rows(lake.fact(name).read()) == _rows(A.fact_installs_daily(of_day))

    rebuild_facts(lake)
    gone = rows.where(F.col("event_date") != F.lit(day)).limit(1).persist()
    P.refresh_touched_buckets(gone, lake.silver, lake.parts(name), lake.fact(name), name)
    assert _rows(lake.fact(name).read()) == _rows(A.fact_installs_daily(lake.silver.read()))

    # A day that loses its installs leaves the fact and its parts.
    kept = rows.where((F.col("event_date") == F.lit(day)) & F.expr("activity_kind is distinct from 'install'"))
    lake.silver.replace_partitions(kept, lake.silver.below((day,)))
    rebuild_facts(lake, [str(day)])
    assert lake.fact(name).read().where(F.col("event_date") == F.lit(day)).count() == 0
    assert _rows(A.fold_parts(lake.parts(name).read(), name)) == _rows(lake.fact(name).read())


def test_silver_job_and_facts_over_buckets(spark):
    root = run_dir(spark, "t-bucket-jobs")
    lake = Lake(spark, f"{root}/lake", day_buckets=3)
    X.write_in_slices(X.kafka_messages(spark, SF_SMALL, redeliver_every=7), f"{root}/topic", F.col("offset"), 2)
    topic = P.file_topic(spark, f"{root}/topic")
    jobs = ["bronze.topic_to_bronze", "silver.bronze_to_silver", "gold.dim_app", "gold.fact_events_daily"]
    run_jobs(spark, lake, f"{root}/ck", names=jobs, topic=topic, available_now=True)
    want = Qy.silver_rows(spark, SF_SMALL)
    assert lake.silver.read().count() == want.count()
    assert _rows(lake.fact("fact_events_daily").read()) == _rows(A.fact_events_daily(want))
    with pytest.raises(ValueError, match="day_buckets"):
        run_jobs(spark, lake, f"{root}/ck2", names=["silver.bronze_to_silver_and_gold"], available_now=True)


def test_silver_with_state_is_read_through_its_log(spark):
    root = run_dir(spark, "t-silver-state")
    lake = Lake(spark, f"{root}/lake")
    msgs = X.kafka_messages(spark, SF_SMALL, redeliver_every=7)
    X.write_in_slices(msgs, f"{root}/topic", F.col("offset"), 2)
    topic = P.file_topic(spark, f"{root}/topic")
    config = {"silver.bronze_to_silver": {"mode": "state", "shuffle_partitions": 4}}

    def run():
        return run_jobs(spark, lake, f"{root}/ck", names=["bronze.topic_to_bronze", "silver.bronze_to_silver"], topic=topic,
                        available_now=True, config=config)

    shown = io.StringIO()
    with redirect_stdout(shown):
        run()[-1].explain()
    assert "StreamingDeduplicateWithinWatermark" in shown.getvalue()
    want = Qy.silver_rows(spark, SF_SMALL)
    assert lake.silver.logged() and _rows(lake.silver.read().select(want.columns)) == _rows(want)

    msgs.where("offset % 14 < 2").write.mode("append").parquet(f"{root}/topic")  # delivered again
    run()
    assert lake.silver.read().count() == want.count()

    # A part file of a task that died lies in a day's folder, not in the log.
    day = want.first()["event_date"]
    want.where(F.col("event_date") == F.lit(day)).drop("event_date").write.mode("append").parquet(
        f"{lake.silver.location}/event_date={day}")
    of_day = want.where(F.col("event_date") == F.lit(day))
    assert lake.silver.read().count() == want.count()
    assert lake.silver.touched(of_day).count() == of_day.count()
    P.refresh_touched_days(of_day, lake.silver, lake.fact("fact_events_daily"), "fact_events_daily")
    assert _rows(lake.fact("fact_events_daily").read()) == _rows(A.fact_events_daily(of_day))
    with pytest.raises(ValueError, match="file sink"):
        lake.silver.append(of_day)
    assert replace(lake.silver, location=f"{root}/nothing").logged() is False


def test_unknown_silver_mode_is_refused(spark):
    with pytest.raises(ValueError, match="no mode"):
        run_jobs(spark, Lake(spark, run_dir(spark, "t-mode")), run_dir(spark, "t-mode-ck"), names=["silver.bronze_to_silver"],
                 available_now=True, config={"silver.bronze_to_silver": {"mode": "window"}})
