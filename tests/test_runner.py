"""The job runner end to end: topic files -> every layer -> SQL views."""

from pyspark.sql import functions as F

from attrlake.operators import facts as A
from attrlake.plans import queries as Qy
from attrlake.plans.catalog import register_views
from attrlake.session import run_dir
from attrlake.sources import fixtures as X
from attrlake.streaming import runner

from conftest import ROOT, SF_SMALL


def test_cli_runs_every_layer_and_views_answer(spark):
    root = run_dir(spark, "t-cli")
    msgs = X.kafka_messages(spark, SF_SMALL, redeliver_every=7, corrupt=True)
    X.write_in_slices(msgs, f"{root}/topic", F.col("offset"), 2)
    runner.main(["--lake", f"{root}/lake", "--checkpoints", f"{root}/ck", "--topic-path", f"{root}/topic",
                 "--config", f"{ROOT}/conf/jobs.yaml", "--available-now"])
    lake = runner.Lake(spark, f"{root}/lake")
    names = register_views(spark, lake)
    assert {"bronze_events", "silver_events", "dim_app", "fact_events_daily", "report_ecpm"} <= set(names)
    # silver holds every good id once; gold equals the batch fact over silver
    silver = lake.silver.read()
    assert silver.count() == silver.select("id").distinct().count()
    for name, (fn, keys) in A.FACTS.items():  # window and refresh jobs alike
        want, got = fn(silver), spark.table(name)
        assert got.count() == want.count(), name
        assert got.select(*want.columns).exceptAll(want).count() == 0, name
    assert lake.quarantine.read().where("value is null").count() == 0  # raw bytes kept for replay
    quarantined = lake.quarantine.read().groupBy("reason").count().collect()
    assert {r.reason for r in quarantined} >= {"short_value", "bad_magic", "undecodable", "null_id"}
    assert Qy.bronze_rows(spark, SF_SMALL).count() > silver.count()


def test_current_state_job_from_an_envelope_topic(spark):
    from attrlake.plans.queries import CHANGE_ROW
    from attrlake.operators.silver import current_state
    from attrlake.streaming import pipeline as P

    root = run_dir(spark, "t-current-job")
    X.write_in_slices(X.change_envelopes(spark, SF_SMALL), f"{root}/changes", F.col("offset"), 2)
    lake = runner.Lake(spark, f"{root}/lake")
    # the job decodes with the event schema; the change-log fixture has its own row shape
    q = P.start_current_state(spark, P.file_topic(spark, f"{root}/changes", 2), CHANGE_ROW, lake.current,
                              P.StreamSettings(f"{root}/ck", {"availableNow": True}, 2))
    q.awaitTermination()
    want = current_state(Qy.unwrapped_changes(spark, SF_SMALL))
    got = P.current_rows(lake.current).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert "silver.changes_to_current" in runner.JOBS and "silver.changes_to_current" not in runner.DEFAULT_JOBS


def test_jobs_writing_the_same_tables_are_refused():
    import pytest

    with pytest.raises(ValueError, match="write the same tables"):
        runner.run_jobs(None, None, "/unused", names=["silver.bronze_to_silver", "silver.bronze_to_silver_and_gold"])
    with pytest.raises(ValueError, match="no mode 'window'"):  # a distinct count has no windowed form
        runner.JOBS["gold.fact_events_daily"](None, runner.Lake(None, "/unused"), runner.P.StreamSettings("/unused", fact_mode="window"), None)


def test_config_names_only_real_jobs_and_known_keys():
    cfg = runner.load_config(f"{ROOT}/conf/jobs.yaml")
    known = runner.CONFIG_KEYS
    assert set(cfg) <= set(runner.JOBS)
    for job, settings in cfg.items():
        assert set(settings) <= known, (job, set(settings) - known)


def test_unknown_settings_and_an_avro_job_without_a_registry_are_refused():
    import pytest

    lake, name = runner.Lake(None, "/unused"), "bronze.topic_to_bronze"
    with pytest.raises(ValueError, match="unknown settings"):
        runner.run_jobs(None, lake, "/unused", names=[name], config={name: {"trigger": "1 minute"}})
    with pytest.raises(ValueError, match="schema_registry_url"):
        runner.run_jobs(None, lake, "/unused", names=[name], config={name: {"codec": "avro"}})
