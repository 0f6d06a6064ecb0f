"""Physical plans on stored lake tables: pruning, pushdown, join choice."""

import pytest
from pyspark.sql import functions as F

from attrlake.operators import facts as A
from attrlake.operators import reports as R
from attrlake.plans import queries as Qy
from attrlake.plans.catalog import register_views
from attrlake.session import run_dir
from attrlake.batch import rebuild_dimensions, rebuild_facts
from attrlake.streaming.runner import Lake

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    lk = Lake(spark, run_dir(spark, "t-plans"))
    lk.silver.append(Qy.silver_rows(spark, SF_SMALL))
    rebuild_facts(lk)
    rebuild_dimensions(lk)
    return lk


def test_fact_scan_prunes_days_pushes_family_and_columns(lake):
    silver = lake.silver.read().where(F.col("event_date").between("2024-01-05", "2024-01-09"))
    plan = _plan(A.fact_revenue_daily(silver))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [In(activity_kind" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "adid" not in read_schema and "reporting_revenue" in read_schema


def test_top_k_is_not_a_full_sort(lake):
    assert "TakeOrderedAndProject" in _plan(R.latest_events(lake.silver.read()))


def test_distinct_devices_spread_over_adid(lake):
    plan = _plan(A.fact_events_daily(lake.silver.read()))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "adid" in plan.split("Exchange hashpartitioning")[2].split("\n")[0]


def test_upsert_lists_and_reads_only_touched_partitions(spark, lake):
    fact = lake.fact("fact_revenue_daily")
    batch = fact.read().where(F.col("event_date") == F.lit("2024-01-03").cast("date"))
    current = fact.touched(batch)
    files = current.inputFiles()
    assert files and all("/event_date=2024-01-03/" in f for f in files)
    assert current.count() == batch.count()


def test_reporting_views_and_small_dims_broadcast_after_measuring(spark, lake):
    names = register_views(spark, lake)
    assert {"silver_events", "dim_campaign", "report_campaign_performance", "quality_report"} <= set(names)
    assert spark.table("quality_report").where("rule = 'Q1_id_not_null_unique'").first().violations == 0
    df = spark.table("report_campaign_performance")
    assert df.count() > 0
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final
