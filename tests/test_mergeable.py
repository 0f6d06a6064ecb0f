"""Parts that merge: device sketches, quality states, newest days first, footer counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from attrlake.operators import facts as A
from attrlake.operators import quality as Q
from attrlake.operators import reports as R
from attrlake.plans import queries as Qy
from attrlake.session import run_dir
from attrlake.store import LakeTable

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    table = LakeTable(spark, run_dir(spark, "t-mergeable"), ["event_date"])
    table.append(Qy.silver_rows(spark, SF_SMALL))
    return table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_newest_rows_are_read_from_the_newest_days(spark, stored):
    want = [tuple(r) for r in R.latest_events(stored.read()).collect()]
    walk = R.latest_of_table(stored)
    assert [tuple(r) for r in walk.select(stored.read().columns).collect()] == want
    days = sorted(stored.days(), reverse=True)
    held = {f.split("event_date=")[1][:10] for f in walk.inputFiles()}
    assert len(days) > 20 and held <= {d.isoformat() for d in days[:2]}


def test_files_read_do_not_grow_with_history(spark):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(days=k // 30, minutes=k % 30), (dt.date(2024, 1, 1) + dt.timedelta(days=k // 30)))
            for k in range(30 * 40)]
    schema = "id bigint, created_at timestamp_ntz, event_date date"
    read = []
    for days in (5, 40):
        table = LakeTable(spark, run_dir(spark, "t-history"), ["event_date"])
        part = rows[-30 * days:]
        table.append(spark.createDataFrame(part + [(-1, None, None)], schema).coalesce(1))
        walk = R.latest_of_table(table)
        assert [r.id for r in walk.collect()] == [r[0] for r in sorted(part, key=lambda r: (r[1], r[0]), reverse=True)[:20]]
        read.append(len(walk.inputFiles()))
    assert read[0] == read[1] == 1


def test_fewer_rows_than_asked_ties_and_no_day(spark):
    schema = "id bigint, created_at timestamp_ntz, event_date date"
    t = dt.datetime(2024, 1, 5, 12)
    rows = [(1, t, t.date()), (2, t, t.date()), (3, dt.datetime(2024, 1, 1), dt.date(2024, 1, 1)), (4, None, None)]
    table = LakeTable(spark, run_dir(spark, "t-few"), ["event_date"])
    table.append(spark.createDataFrame(rows, schema))
    assert [r.id for r in R.latest_of_table(table).collect()] == [2, 1, 3, 4]
    assert [r.id for r in R.latest_of_table(table, 1).collect()] == [2]


def test_the_footer_count_reads_no_data(spark, stored):
    counted = R.table_row_count_from_footers(stored)
    assert counted.first()[0] == stored.read().count()
    text = plan(counted)
    assert "PushedAggregation: [COUNT(*)]" in text and "ReadSchema: struct<count(*):bigint>" in text
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sketches_merge_over_days_within_three_percent(spark):
    rows = spark.range(200_000).select(
        (F.lit("2024-01-01").cast("date") + (F.col("id") % 10).cast("int")).alias("event_date"), F.lit("a").alias("app_token"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("tracker"), F.lit("k").alias("activity_kind"), F.lit(None).cast("string").alias("event_name"),
        F.concat(F.lit("d"), (F.col("id") * 7919) % 60_000).alias("adid"))
    fact = A.fact_device_sketches_daily(rows)
    path = run_dir(spark, "t-sketch")
    fact.write.parquet(path)
    stored = spark.read.parquet(path)
    for by, days in ((["app_token"], 10), (["tracker"], 10), (["app_token"], 4)):
        cut = F.col("event_date") < F.lit("2024-01-01").cast("date") + days
        got = {r[0]: r for r in R.report_devices_approx(stored.where(cut), by).collect()}
        for r in rows.where(cut).groupBy(*by).agg(F.countDistinct("adid").alias("n"), F.count("*").alias("e")).collect():
            assert abs(got[r[0]].devices_approx - r.n) <= 0.03 * r.n and got[r[0]].events == r.e
    nobody = A.fact_device_sketches_daily(rows.withColumn("adid", F.lit(None).cast("string")))
    assert R.report_devices_approx(nobody, ["app_token"]).first().devices_approx == 0


def test_quality_from_parts_is_the_whole_and_scans_once(spark, stored):
    silver = stored.read()
    awkward = silver.unionByName(silver.limit(5)).unionByName(
        silver.limit(6).withColumns({"id": F.lit(None).cast("bigint"), "adid": F.lit(None).cast("string"),
                                     "store_id": F.lit("store_1"), "app_name": F.lit(None).cast("string")}))
    path = run_dir(spark, "t-awkward")
    awkward.write.parquet(path)
    awkward = spark.read.parquet(path)
    want = {r.rule: tuple(r) for r in Q.quality_report(awkward).collect()}
    state = Q.QualityState(spark, run_dir(spark, "t-quality"))
    for k in (0, 1, 2, 1):  # the middle part is replayed
        state.take(awkward.where(F.pmod(F.xxhash64("created_at"), F.lit(3)) == k), k)
    assert {r.rule: tuple(r) for r in state.report().collect()} == want
    assert want["Q1_id_not_null_unique"][2] == 11 and want["Q4_one_app_name_per_store"][2] > 0
    assert plan(Q.key_states(awkward)).count("FileScan") == 1


def test_quality_of_no_rows(spark, stored):
    state = Q.QualityState(spark, run_dir(spark, "t-quality-none"))
    state.take(stored.read().limit(0), 0)
    assert {tuple(r) for r in state.report().select("checked", "violations").distinct().collect()} == {(0, 0)}
    assert state.report().count() == Q.quality_report(stored.read()).count()


def test_a_null_among_attributes_is_not_the_next_value(spark):
    one, two = Q.KEY_RULES["Q11_one_attribute_set_per_adid"][1][:2]
    row = {c: None for c in Q.M.JOURNEY_ATTRIBUTES} | {"id": 1, "store_id": None, "app_name": None, "adid": "x"}
    schema = ", ".join(f"{c} {'bigint' if c == 'id' else 'string'}" for c in row)
    rows = [tuple((row | {one: "v"}).values()), tuple((row | {"id": 2, two: "v"}).values())]
    got = {r.rule: r.violations for r in Q.key_report(Q.key_states(spark.createDataFrame(rows, schema))).collect()}
    assert got["Q11_one_attribute_set_per_adid"] == 1


def test_every_quality_rule_holds_for_some_rows_and_fails_for_others(spark):
    for r in Qy.quality_report_faults(spark, SF_SMALL).collect():
        assert 0 < r.violations < r.checked, r


def test_views_show_what_is_written_after_they_were_made(spark):
    from attrlake.plans.catalog import register_views
    from attrlake.streaming.runner import Lake
    session = spark.newSession()
    lake = Lake(session, run_dir(spark, "t-views"))
    rows = Qy.silver_rows(spark, SF_SMALL)
    lake.silver.append(rows.where("id % 2 = 0"))
    lake.silver.spark = session
    assert "silver_events" in register_views(session, lake)
    before = session.sql("select count(*) from silver_events").first()[0]
    lake.silver.append(rows.where("id % 2 = 1"))
    assert session.sql("select count(*) from silver_events").first()[0] == 2 * before
